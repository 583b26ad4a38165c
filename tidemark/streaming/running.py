"""Report rows of the running day: every window is computed and stored once, by the batch whose watermark closes it.

A batch adds its step sums to a table kept by day, reads back the days that are still open, and writes the windows that end
between the watermark of the batch before and its own. Steps that earlier batches have closed are carried as one sum per key, so
the work of a batch does not depend on how many windows the day has had. Nothing but the two tables and the stream's own
checkpoint is kept: a replayed batch reads the same watermarks and sums and overwrites its own rows.

Where clocks are set back a wall-clock step comes twice; it is closed after the second time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.clock import second_of_day, seconds_of, wall_clock
from tidemark.operators.cumulate import DAY, STEP, steps_per_day, with_step
from tidemark.operators.ranking import tumble_sums
from tidemark.streaming.tables import aggregate, append, append_view, batch_mark, compact, read_batches, write_batch

SUMS, WINDOWS = "sums", "windows"
#: The column a table is kept by: the local day of a window's start.
BY = "day"
# clocks change at a quarter hour, by at most this many of them ahead of an instant's own day end
_QUARTERS, _QUARTER_MS = 104, 900_000


def local_reading(mark: int, zone: str | None) -> Column:
    """The earliest wall clock that an instant from ``mark`` (milliseconds) on can show."""
    first = -(-mark // _QUARTER_MS) * _QUARTER_MS
    instants = [mark, *(first + n * _QUARTER_MS for n in range(_QUARTERS))]
    return F.least(*(wall_clock(F.timestamp_millis(F.lit(x)), zone) for x in instants))


def closed_steps(mark: int, step: str, zone: str | None) -> Column:
    """How many steps of each day lie before ``mark``."""
    if mark <= 0:
        return F.lit(0)
    wall = local_reading(mark, zone)
    number = F.floor(second_of_day(wall) / seconds_of(step)).cast("int")
    day = F.to_date(wall)
    return F.when(F.col(DAY) < day, steps_per_day(step)).when(F.col(DAY) == day, number).otherwise(0)


def step_sums(closed: DataFrame, step: str, sums: Sequence[str], keys: Sequence[str], zone: str | None) -> DataFrame:
    """Closed windows of a stream to the day steps they lie in, kept by day."""
    placed = with_step(closed, "window_start", step, zone)
    rows = placed.groupBy(DAY, STEP, *keys).agg(*(F.sum(c).cast(closed.schema[c].dataType).alias(c) for c in sums))
    return rows.select(F.col(DAY).alias(BY), F.col(STEP).alias("step"), *keys, *sums)


def open_days(spark: SparkSession, path: str, mark: int, zone: str | None) -> DataFrame:
    """The stored sums of days that were open at ``mark``; folders of other days are not read."""
    rows = read_batches(spark, path)
    if mark > 0:
        day = spark.range(1).select(F.to_date(local_reading(mark, zone))).first()[0]
        rows = rows.filter(F.col(BY) >= F.lit(day))
    return rows.withColumnsRenamed({BY: DAY, "step": STEP})


def carried(rows: DataFrame, before: Column, now: Column, sums: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Sums per step of the steps ``[before, now)``, and one sum per key for all steps ahead of them."""
    used = rows.filter((before < now) & (F.col(STEP) < now)).withColumn(STEP, F.greatest(STEP, before - 1))
    kinds = {c: rows.schema[c].dataType for c in sums}
    return used.groupBy(DAY, STEP, *keys).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in sums))


def window_sink(
    path: str,
    checkpoint: str,
    step: str,
    sums: Sequence[str],
    keys: Sequence[str],
    report: Callable[[DataFrame, tuple[Column, Column]], DataFrame],
    zone: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over closed windows. ``report`` turns step sums into rows (with ``day``) for the given steps."""

    def store(closed: DataFrame, batch_id: int) -> None:
        spark = closed.sparkSession
        before, now = batch_mark(spark, checkpoint, batch_id - 1), batch_mark(spark, checkpoint, batch_id)
        write_batch(step_sums(closed, step, sums, keys, zone), f"{path}/{SUMS}", batch_id, BY)
        rows = open_days(spark, f"{path}/{SUMS}", before, zone)
        steps = closed_steps(before, step, zone), closed_steps(now, step, zone)
        write_batch(report(carried(rows, *steps, sums, keys), steps), f"{path}/{WINDOWS}", batch_id, BY)

    return store


def tumble_sink(
    path: str, checkpoint: str, window: str, key: str, report: Callable[[DataFrame], DataFrame], zone: str | None = None
) -> Callable[[DataFrame, int], None]:
    """The same for tumbling windows of wall-clock time: ``report`` gets the sums of the windows that a batch closes."""

    def store(closed: DataFrame, batch_id: int) -> None:
        spark = closed.sparkSession
        before, now = batch_mark(spark, checkpoint, batch_id - 1), batch_mark(spark, checkpoint, batch_id)
        sums = tumble_sums(closed, "window_start", window, key, F.col("total"), zone)
        kept = sums.withColumns({"total": F.col("total").cast(closed.schema["total"].dataType), BY: F.to_date("window_start")})
        write_batch(kept, f"{path}/{SUMS}", batch_id, BY)
        rows = open_days(spark, f"{path}/{SUMS}", before - 1000 * seconds_of(window), zone)
        ended = F.col("window_end") <= local_reading(now, zone) if now > 0 else F.lit(False)
        fresh = F.col("window_end") > local_reading(before, zone) if before > 0 else F.lit(True)
        whole = rows.filter(ended & fresh).groupBy("window_start", "window_end", key).agg(F.sum("total").alias("total"))
        write_batch(report(whole).withColumn(BY, F.to_date("window_start")), f"{path}/{WINDOWS}", batch_id, BY)

    return store


def windows_view(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """The stored rows of all windows, or of one day's, whose folder alone is read."""
    rows = append_view(spark, f"{path}/{WINDOWS}")
    return (rows if day is None else rows.filter(F.col(BY) == F.lit(day).cast("date"))).drop(BY)


def shorten(spark: SparkSession, path: str, sums: Sequence[str], keys: Sequence[str]) -> None:
    """Merge the stored batches of both tables; the stream goes on meanwhile. ``keys``: those of the sums, with step or window."""
    compact(spark, f"{path}/{SUMS}", aggregate([BY, *keys], sums))
    compact(spark, f"{path}/{WINDOWS}", append)
