"""Result tables of streams: Parquet folders with one partition per micro-batch, shortened while the stream goes on.

A replayed batch overwrites its own partition, so writing twice changes nothing. No batch rewrites what earlier ones wrote; the
table's key rule is applied when it is read.

``compact`` merges finished batches into a generation by that rule. A table kept by day is merged day by day: days without new
batches keep the generation they are in. Which generations are live, and up to which batch they reach, is a short list; the
next list is created as a new file, so readers see the old table or the new one. The stream is not told and goes on meanwhile. Folders
that no list names any more stay until ``vacuum``, for readers that began before.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ranking import latest_per_group
from tidemark.sources import folders

BATCH, GENERATION = "batch_id", "generation"
_LISTS, _LAYOUT = "_live", "_layout"


class Live(NamedTuple):
    """One list of a table: its number, the last merged batch, and the generation of each part (one unnamed part, or one per day)."""

    number: int
    through: int
    parts: dict[str, str]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, the place every executor can reach."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_batch(df: DataFrame, path: str, batch_id: int, by: str | None = None) -> None:
    """Store one batch; ``by`` keeps the table in folders of that column, a day mostly."""
    writer = df.write.mode("overwrite")
    if by:
        # a batch may have no row for any day, and so no file to read the columns from
        layout = json.dumps({"by": by, "schema": df.schema.json()})
        if not folders.listed(df.sparkSession, f"{path}/{_LAYOUT}"):
            folders.create(df.sparkSession, f"{path}/{_LAYOUT}/1", layout)
        writer = df.hint("rebalance", by).write.mode("overwrite").partitionBy(by)
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def batch_sink(path: str, transform: Callable[[DataFrame], DataFrame] | None = None, by: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function that stores each batch, transformed as a plain table first."""

    def store(df: DataFrame, batch_id: int) -> None:
        write_batch(transform(df) if transform else df, path, batch_id, by)

    return store


def start(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
) -> StreamingQuery:
    """Start a stream into ``sink``: what is there now, or a batch ``every`` interval, going on from ``checkpoint``.

    History and today: run once without ``every`` to work off the backlog, then with it on the same checkpoint.
    """
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def _layout(spark: SparkSession, path: str) -> tuple[str | None, T.StructType | None]:
    """The column a table is kept by, and its columns."""
    text = folders.read(spark, f"{path}/{_LAYOUT}/1")
    if not text:
        return None, None
    found = json.loads(text)
    return found["by"], T.StructType.fromJson(json.loads(found["schema"]))


def live(spark: SparkSession, path: str) -> Live:
    """The newest whole list; before the first merge, one without parts."""
    for name in reversed(folders.listed(spark, f"{path}/{_LISTS}")):
        try:
            found = json.loads(folders.read(spark, f"{path}/{_LISTS}/{name}") or "")
        except ValueError:  # being written
            continue
        return Live(int(name), found["through"], found["parts"])
    return Live(0, -(1 << 62), {})


def _numbers(spark: SparkSession, path: str) -> list[int]:
    mark = f"{BATCH}="
    return sorted(int(n.removeprefix(mark)) for n in folders.listed(spark, path) if n.startswith(mark))


def _batches(spark: SparkSession, path: str, numbers: Sequence[int], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    if schema:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
    return reader.parquet(*(f"{path}/{BATCH}={n}" for n in numbers))


def _generations(spark: SparkSession, path: str, parts: dict[str, str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", path)
    if schema:
        more = [T.StructField(BATCH, T.LongType()), T.StructField(GENERATION, T.StringType())]
        reader = reader.schema(T.StructType([*schema.fields, *more]))
    return reader.parquet(*(f"{path}/{generation}/{name}".rstrip("/") for name, generation in sorted(parts.items()))).drop(GENERATION)


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table with the batch they came in, or that was merged last into them."""
    _, schema = _layout(spark, path)
    now = live(spark, path)
    if schema is None and not now.parts:
        return spark.read.option("basePath", path).parquet(path)
    numbers = [n for n in _numbers(spark, path) if n > now.through]
    frames = [_generations(spark, path, now.parts, schema)] if now.parts else []
    frames += [_batches(spark, path, numbers, schema)] if numbers else []
    if not frames:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))
    first, *rest = frames
    return first.unionByName(rest[0]) if rest else first


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """The rows of one batch that has not been merged."""
    _, schema = _layout(spark, path)
    return _batches(spark, path, [batch_id], schema).drop(BATCH)


def compact(spark: SparkSession, path: str, rule: Callable[[DataFrame], DataFrame]) -> bool:
    """Merge the finished batches into the live generations by ``rule`` (rows with their batch to rows with their batch).

    False if there was nothing to merge. Of several at the same time one succeeds, the others fail and change nothing.
    """
    by, schema = _layout(spark, path)
    now = live(spark, path)
    ready = [n for n in _numbers(spark, path) if n > now.through and "_SUCCESS" in folders.listed(spark, f"{path}/{BATCH}={n}")]
    if not ready:
        return False
    touched = {name for n in ready for name in folders.listed(spark, f"{path}/{BATCH}={n}") if by and name.startswith(f"{by}=")} if by else {""}
    rows = _batches(spark, path, ready, schema)
    old = {name: generation for name, generation in now.parts.items() if name in touched}
    if old:
        rows = _generations(spark, path, old, schema).unionByName(rows)
    parts = {name: generation for name, generation in now.parts.items() if name not in touched}
    if touched:
        generation = f"{GENERATION}={uuid.uuid4().hex}"
        merged = rule(rows)
        (merged.hint("rebalance", by).write.partitionBy(by) if by else merged.write).parquet(f"{path}/{generation}")
        written = [n for n in folders.listed(spark, f"{path}/{generation}") if by and n.startswith(f"{by}=")] if by else [""]
        parts |= {name: generation for name in written}
    text = json.dumps({"through": ready[-1], "parts": parts})
    if not folders.create(spark, f"{path}/{_LISTS}/{now.number + 1:012d}", text):
        raise RuntimeError(f"{path} was merged by another writer meanwhile")
    return True


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete what none of the last ``keep`` lists needs; gives the names. No reader may be on an older list."""
    lists = folders.listed(spark, f"{path}/{_LISTS}")
    kept = [json.loads(folders.read(spark, f"{path}/{_LISTS}/{n}")) for n in lists[-keep:]]
    if not kept:
        return []
    named = {generation for found in kept for generation in found["parts"].values()}
    through = min(found["through"] for found in kept)
    gone = [n for n in folders.listed(spark, path) if n.startswith(f"{GENERATION}=") and n not in named]
    gone += [f"{BATCH}={n}" for n in _numbers(spark, path) if n <= through]
    gone += [f"{_LISTS}/{n}" for n in lists[:-keep]]
    for name in gone:
        folders.delete(spark, f"{path}/{name}")
    return gone


def batch_mark(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The watermark a batch runs with, in milliseconds: every window that ends by then is handed over. 0 for none."""
    if batch_id < 0:
        return 0
    text = folders.read(spark, f"{checkpoint}/offsets/{batch_id}") or ""
    lines = [json.loads(line) for line in text.splitlines() if line.startswith("{")]
    return max((line["batchWatermarkMs"] for line in lines if "batchWatermarkMs" in line), default=0)


def closed_until(spark: SparkSession, checkpoint: str) -> Column:
    """The instant up to which a stream has handed over its windows: the watermark of its last finished batch.

    Read from the stream's own checkpoint, where each batch's watermark is kept. NULL before the first batch has finished.
    """
    finished = [int(n) for n in folders.listed(spark, f"{checkpoint}/commits") if n.isdigit()]
    mark = batch_mark(spark, checkpoint, max(finished)) if finished else 0
    return F.timestamp_millis(F.lit(mark or None).cast("bigint"))


def unique(keys: Sequence[str]) -> Callable[[DataFrame], DataFrame]:
    """Rule of a unique key: the row of the last batch per key."""
    return lambda rows: latest_per_group(rows, keys, [BATCH])


def aggregate(keys: Sequence[str], sums: Sequence[str], replaces: Sequence[str] = ()) -> Callable[[DataFrame], DataFrame]:
    """Rule of an aggregate key: increments add up, replaced columns take the last batch's value."""

    def rule(rows: DataFrame) -> DataFrame:
        added = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in sums]
        last = [F.max_by(c, BATCH).alias(c) for c in replaces]
        return rows.groupBy(*keys).agg(*added, *last, F.max(BATCH).alias(BATCH)).select(*rows.columns)

    return rule


def append(rows: DataFrame) -> DataFrame:
    """Rule of a table that only grows: every row stays, in fewer files."""
    return rows


def append_view(spark: SparkSession, path: str) -> DataFrame:
    """Every stored row."""
    return read_batches(spark, path).drop(BATCH)


def unique_view(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    return unique(keys)(read_batches(spark, path)).drop(BATCH)


def aggregate_view(
    spark: SparkSession, path: str, keys: Sequence[str], sums: Sequence[str], replaces: Sequence[str] = ()
) -> DataFrame:
    rows = read_batches(spark, path)
    return rows.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in sums), *(F.max_by(c, BATCH).alias(c) for c in replaces)
    )
