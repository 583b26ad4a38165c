"""Change capture: envelopes ``{before, after, source{db, schema, table}, op, ts_ms}`` to clean rows and current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DELETE = "d"
SNAPSHOT = "r"


def envelope_schema(row: T.StructType, *position: T.StructField) -> T.StructType:
    """Schema of an envelope around ``row``; ``position`` adds log-position fields to ``source``."""
    source = T.StructType([*(T.StructField(n, T.StringType()) for n in ("db", "schema", "table")), *position])
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("source", source),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def _flat(df: DataFrame, image: str, keep: tuple[str, ...]) -> DataFrame:
    table = F.concat_ws(".", "source.db", "source.schema", "source.table").alias("table_name")
    return df.filter(F.col(image).isNotNull()).select(f"{image}.*", table, "op", *keep)


def flatten_envelope(df: DataFrame, *keep: str) -> DataFrame:
    """New row images with ``table_name`` and ``op``; delete events have none and yield nothing."""
    return _flat(df, "after", keep)


def deletes(df: DataFrame, *keep: str) -> DataFrame:
    """Old row images of the delete events."""
    return _flat(df.filter(F.col("op") == DELETE), "before", keep)


def snapshot_rows(df: DataFrame, table_name: str) -> DataFrame:
    """An initial load shaped like flattened change rows, to union in front of the change stream."""
    return df.withColumns({"table_name": F.lit(table_name), "op": F.lit(SNAPSHOT)})


def snapshot_envelopes(df: DataFrame, db: str, schema: str, table: str, ts_ms: int = 0) -> DataFrame:
    """An initial load shaped like envelopes: stored as the first batch of a change table, it precedes the stream."""
    source = F.struct(F.lit(db).alias("db"), F.lit(schema).alias("schema"), F.lit(table).alias("table"))
    row = F.struct(*df.columns)
    return df.select(
        F.lit(None).cast(df.schema).alias("before"),
        row.alias("after"),
        source.alias("source"),
        F.lit(SNAPSHOT).alias("op"),
        F.lit(ts_ms).cast("bigint").alias("ts_ms"),
    )


def last_changes(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The last envelope per key by ``order_by``.

    Each task reduces its own changes to one per key before the shuffle, so a key changed very often costs no more
    than the others.
    """
    image = F.coalesce("after", "before")
    last = (
        df.filter(image.isNotNull())
        .groupBy(*(image[k].alias(f"_k{i}") for i, k in enumerate(keys)))
        .agg(F.max_by(F.struct(*df.columns), F.struct(*order_by)).alias("_last"))
    )
    return last.select("_last.*")


def latest_state(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Current row per key from envelopes: the last change by ``order_by`` wins, deleted keys are gone."""
    last = last_changes(df, keys, order_by)
    return last.filter((F.col("op") != DELETE) & F.col("after").isNotNull()).select("after.*", "op")
