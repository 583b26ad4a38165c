"""Initial load handed over to the change log, while the table goes on changing.

The load is read in chunks of keys. Before and after each chunk the log's position is noted: its fences. What was read lies somewhere
between them, so a row may already show changes that the log will bring, and none that lie behind the high fence.

- As a table: a chunk's rows count as changes at the low fence (``at_low_fence``). Every later change of a key wins, whatever
  order the batches land in; a delete stays as the last change, so a chunk that lands late brings nothing back.
- As a stream that goes out in order: a chunk goes out when the log has passed its high fence (``settled``), without the rows
  whose key changed between the fences. Those rows are in the log with their newest state, so no key is lost and none is set back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.changes import SNAPSHOT
from tidemark.sources.folders import create, listed, read

POSITION, LOW, HIGH = "position", "fence_low", "fence_high"
Bounds = tuple[object, object]


def key_chunks(df: DataFrame, key: str, n: int) -> list[Bounds]:
    """At most ``n`` ranges of a key of about equal numbers of rows: from (inclusive) and to (exclusive), open at both ends."""
    cuts = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)).first()[0] if n > 1 else []
    edges = [None, *sorted(set(cuts or [])), None]
    return list(zip(edges, edges[1:]))


def in_chunk(key: str, bounds: Bounds) -> Column:
    """Rows of one range, as a condition that sources push down. A null key is in the first one."""
    low, high = bounds
    inside = F.lit(True) if high is None else F.col(key) < F.lit(high)
    return (inside | F.col(key).isNull()) if low is None else (F.col(key) >= F.lit(low)) & inside


def fenced_load(
    spark: SparkSession, path: str, read_chunk: Callable[[Bounds], DataFrame], chunks: Sequence[Bounds], position: Callable[[], int]
) -> None:
    """Read each chunk between two positions of the log and store it with them. Chunks that are stored whole are not read again."""
    for number, bounds in enumerate(chunks):
        mark = f"{path}/_fences/{number}"
        if read(spark, mark):
            continue
        low = position()
        read_chunk(bounds).write.mode("overwrite").parquet(f"{path}/chunk={number}")
        create(spark, mark, f"{low} {position()}")


def loaded(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all stored chunks with their fences."""
    numbers = [int(n) for n in listed(spark, f"{path}/_fences") if n.isdigit()]
    fences = [(n, *map(int, read(spark, f"{path}/_fences/{n}").split())) for n in numbers]
    table = spark.createDataFrame(fences, f"chunk int, {LOW} bigint, {HIGH} bigint")
    rows = spark.read.option("basePath", path).parquet(*(f"{path}/chunk={n}" for n in numbers))
    return rows.join(table, "chunk").drop("chunk")


def _envelopes(rows: DataFrame, at: str, db: str, schema: str, table: str) -> DataFrame:
    image = [c for c in rows.columns if c not in (LOW, HIGH)]
    source = F.struct(F.lit(db).alias("db"), F.lit(schema).alias("schema"), F.lit(table).alias("table"))
    after = F.struct(*image)
    return rows.select(
        F.lit(None).cast(rows.select(after.alias("x")).schema["x"].dataType).alias("before"),
        after.alias("after"),
        source.alias("source"),
        F.lit(SNAPSHOT).alias("op"),
        F.col(at).cast("bigint").alias(POSITION),
    )


def at_low_fence(rows: DataFrame, db: str, schema: str, table: str) -> DataFrame:
    """Loaded rows as envelopes that any later change of their key replaces (``latest_state`` by ``position``)."""
    return _envelopes(rows, LOW, db, schema, table)


def settled(rows: DataFrame, log: DataFrame, keys: Sequence[str], db: str, schema: str, table: str) -> DataFrame:
    """Loaded rows that may go out once the log has passed their high fence, as envelopes at that position.

    ``log``: envelopes with ``position`` of at least the changes between the fences. It is narrowed to keys before it is joined.
    """
    image = F.coalesce("after", "before")
    touched = log.filter(image.isNotNull()).select(*(image[k].alias(f"_k{n}") for n, k in enumerate(keys)), F.col(POSITION).alias("_at"))
    same = F.lit(True)
    for n, k in enumerate(keys):
        same = same & rows[k].eqNullSafe(touched[f"_k{n}"])
    between = (F.col("_at") > rows[LOW]) & (F.col("_at") <= rows[HIGH])
    return _envelopes(rows.join(touched, same & between, "left_anti"), HIGH, db, schema, table)
