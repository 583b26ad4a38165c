"""Merge rules of result tables: unique key, aggregate key, ranked snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import now_text
from tidemark.operators.ranking import latest_per_group


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Unique key: the last row of the batch per key replaces the target's row.

    A small batch is broadcast by size, so the target is read once and not shuffled.
    """
    newest = latest_per_group(batch, keys, order_by)
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest.select(*target.columns))


def merge_aggregate(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    replaces: Sequence[str] = (),
    order_by: Sequence[str] = (),
) -> DataFrame:
    """Aggregate key: ``sums`` add up, ``replaces`` take the value of the row with the greatest ``order_by``.

    ``delta`` holds increments. Running totals would be counted again with every merge.
    """
    both = target.unionByName(delta)
    return both.groupBy(*keys).agg(
        *(F.sum(c).cast(both.schema[c].dataType).alias(c) for c in sums),
        *(F.max_by(c, F.struct(*order_by)).alias(c) for c in replaces),
    )


def stamped(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Rows with the ``update_time`` result tables carry."""
    return df.withColumn("update_time", now_text(now))


def ranked_snapshot(ranked: DataFrame, now: Column | None = None, rank: str = "ranking") -> DataFrame:
    """Rows of one ranking, 1..n, stamped with the time it was taken, ready to append."""
    return stamped(ranked.withColumn(rank, F.col(rank).cast("int")), now)
