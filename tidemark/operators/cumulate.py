"""Cumulative windows: windows that start at local midnight and end at every step of the day.

A row belongs to every window of its day that ends after it. The rows are first summed per step, which combines on the
map side and leaves at most ``86400 / step`` rows per day and key, however many rows came in. Running sums over those
steps are the window results. A step without rows repeats the result before it; a day starts at its first step with
rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.clock import DAY_SECONDS, at_second, second_of_day, seconds_of, wall_clock

DAY, STEP, UNTIL = "_day", "_step", "_until"


def steps_per_day(step: str | int) -> int:
    seconds = seconds_of(step)
    if seconds <= 0 or DAY_SECONDS % seconds:
        raise ValueError(f"a day is not a whole number of steps of {step!r}")
    return DAY_SECONDS // seconds


def with_step(df: DataFrame, ts: str, step: str | int, zone: str | None = None) -> DataFrame:
    """Add the local day and the number of the step within it; rows without event time are left out.

    Both are said to be there, so that plans which join on them do not differ from plans which do not, and share one exchange.
    """
    steps_per_day(step)
    wall = wall_clock(F.col(ts), zone)
    placed = df.filter(F.col(ts).isNotNull()).withColumns(
        {DAY: F.to_date(wall), STEP: F.floor(second_of_day(wall) / seconds_of(step)).cast("int")}
    )
    return placed.filter(F.col(DAY).isNotNull() & F.col(STEP).isNotNull())


def step_partials(
    df: DataFrame, ts: str, step: str | int, sums: Mapping[str, Column], keys: Sequence[str] = (), zone: str | None = None
) -> DataFrame:
    """Sums per day, step and key."""
    totals = [F.sum(value).alias(name) for name, value in sums.items()]
    return with_step(df, ts, step, zone).groupBy(DAY, STEP, *keys).agg(*totals)


def running_spans(
    partials: DataFrame,
    step: str | int,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    lists: Sequence[str] = (),
    steps: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Running sums and lists, each with the span of steps ``[_step, _until)`` over which it holds.

    ``steps`` (from, to; by day) leaves only the parts of spans that lie in these steps of the day.
    """
    order = W.partitionBy(DAY, *keys).orderBy(STEP)
    so_far = order.rowsBetween(W.unboundedPreceding, W.currentRow)
    end = F.lit(steps_per_day(step)) if steps is None else steps[1]
    spans = partials.select(
        DAY,
        STEP,
        F.coalesce(F.lead(STEP).over(order), end).alias(UNTIL),
        *keys,
        *(F.sum(name).over(so_far).alias(name) for name in sums),
        *(F.collect_list(name).over(so_far).alias(name) for name in lists),
    )
    if steps is None:
        return spans
    return spans.withColumns({STEP: F.greatest(STEP, steps[0]), UNTIL: F.least(UNTIL, end)}).filter(F.col(STEP) < F.col(UNTIL))


def every_step(spans: DataFrame) -> DataFrame:
    """One row per step of each span."""
    return spans.withColumn(STEP, F.explode(F.sequence(F.col(STEP), F.col(UNTIL) - 1))).drop(UNTIL)


def with_bounds(df: DataFrame, step: str | int) -> DataFrame:
    """Replace day and step by the window's bounds, as wall clocks."""
    others = [c for c in df.columns if c not in (DAY, STEP)]
    end = at_second(F.col(DAY), (F.col(STEP) + 1) * seconds_of(step))
    return df.select(F.col(DAY).cast("timestamp_ntz").alias("window_start"), end.alias("window_end"), *others)


def cumulate_partials(
    partials: DataFrame, step: str | int, sums: Sequence[str], keys: Sequence[str] = (), steps: tuple[Column, Column] | None = None
) -> DataFrame:
    """Window results from step sums that exist already, such as those a stream keeps; for ``steps`` only, if given."""
    return with_bounds(every_step(running_spans(partials, step, sums, keys, steps=steps)), step)


def cumulate(
    df: DataFrame, ts: str, step: str | int, sums: Mapping[str, Column], keys: Sequence[str] = (), zone: str | None = None
) -> DataFrame:
    """``window_start, window_end, *keys, *sums`` for every cumulative window, per key once the key has started."""
    return cumulate_partials(step_partials(df, ts, step, sums, keys, zone), step, list(sums), keys)


def _leaves(n_steps: int) -> int:
    """Steps of a day, rounded up to a power of two."""
    return 1 << (n_steps - 1).bit_length()


def _with_blocks(spans: DataFrame, n_steps: int) -> DataFrame:
    """Cut each span into aligned blocks of 1, 2, 4, … steps, at most two of each size: one row per ``_block``.

    The whole day is block 1; block ``n`` has the halves ``2n`` and ``2n + 1``.
    """
    leaves, pieces = _leaves(n_steps), []
    for level in range(leaves.bit_length()):
        low, high = f"shiftright({STEP} + {(1 << level) - 1}, {level})", f"shiftright({UNTIL}, {level})"
        first = leaves >> level
        pieces.append(f"if({low} < {high} and {low} % 2 = 1, {first} + {low}, null)")
        pieces.append(f"if({low} < {high} and {high} % 2 = 1, {first - 1} + {high}, null)")
    blocks = F.expr(f"array({', '.join(pieces)})")
    return spans.withColumn("_block", F.explode(blocks)).filter(F.col("_block").isNotNull()).drop(STEP, UNTIL)


def _block_steps(block: str, n_steps: int) -> Column:
    """The steps a block covers."""
    leaves = _leaves(n_steps)
    size = f"({leaves} div shiftleft(1, length(bin({block})) - 1))"
    start = f"({block} * {size} - {leaves})"
    return F.expr(f"sequence(cast({start} as int), cast({start} + {size} - 1 as int))")


def best(df: DataFrame, group: Sequence[str], measure: str, key: str, k: int, rank: str = "rank_num") -> DataFrame:
    """The ``k`` greatest rows per group; equal measures go by key. Each task limits its own rows before the shuffle."""
    order = W.partitionBy(*group).orderBy(F.desc(measure), F.asc(key))
    return df.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) <= k)


def cumulate_top(
    partials: DataFrame, step: str | int, key: str, measure: str, k: int, steps: tuple[Column, Column] | None = None
) -> DataFrame:
    """The ``k`` keys with the greatest running sum in every cumulative window: ``_day, _step, key, measure, rank_num``.

    A key's running sum is constant between its sales. Repeating it for every window it holds in would multiply the
    rows by the number of steps. Instead each span is cut into a few aligned blocks, the best ``k`` are taken per
    block, and only those are repeated per step: the best of a step are among the best of the blocks that cover it.
    This is exact, also when sums fall. Running sums keep the type of the partial sums, so that sorting stays cheap.
    """
    n_steps = steps_per_day(step)
    kind = partials.schema[measure].dataType
    spans = running_spans(partials, step, [measure], [key], steps=steps).withColumn(measure, F.col(measure).cast(kind))
    # day and block as one number: the sort that limits each task's rows then compares one column, mostly
    group = F.unix_date(DAY).cast("bigint") * (2 * _leaves(n_steps)) + F.col("_block")
    per_block = best(_with_blocks(spans, n_steps).withColumn("_group", group), ["_group"], measure, key, k)
    each = F.explode(_block_steps("_block", n_steps))
    return best(per_block.select(DAY, each.alias(STEP), key, measure), [DAY, STEP], measure, key, k)
