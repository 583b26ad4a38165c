"""Rankings: top-k per window, latest row per group, ranked lists as text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.clock import wall_clock
from tidemark.operators.cumulate import best


def tumble_sums(
    df: DataFrame, ts: str, window: str, key: str, measure: Column, zone: str | None = None
) -> DataFrame:
    """``window_start, window_end, key, total`` per tumbling window of wall-clock time."""
    w = F.window(wall_clock(F.col(ts), zone), window)
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(w.alias("w"), key)
        .agg(F.sum(measure).alias("total"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "total")
    )


def rank_list(ranked: DataFrame, group: Sequence[str], key: str, k: int, *aggs: Column, pad: bool = True) -> DataFrame:
    """One row per group with its ranked keys as ``top_list``; ``pad`` keeps a place for each of the ``k`` ranks."""
    places = [F.max(F.when(F.col("rank_num") == n, F.col(key).cast("string")).otherwise(F.lit("") if pad else F.lit(None)))
              for n in range(1, k + 1)]
    return ranked.groupBy(*group).agg(F.concat_ws(",", *places).alias("top_list"), *aggs)


def top_per_window(
    df: DataFrame, ts: str, window: str, key: str, measure: Column, k: int = 5, zone: str | None = None, as_csv: bool = True
) -> DataFrame:
    """The ``k`` keys with the greatest sum per tumbling window, as one CSV per window or as ranked rows."""
    bounds = ["window_start", "window_end"]
    ranked = best(tumble_sums(df, ts, window, key, measure, zone), bounds, "total", key, k)
    return rank_list(ranked, bounds, key, k).withColumnRenamed("top_list", "top_keys") if as_csv else ranked


def top_rows(df: DataFrame, order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows in ``order``, numbered if ``rank`` names a column. Only ``k`` rows meet in one task."""
    top = df.orderBy(*order).limit(k)
    return top if rank is None else top.withColumn(rank, F.row_number().over(W.orderBy(*order)))


def latest_per_group(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """The row with the greatest ``by`` per group."""
    rest = [c for c in df.columns if c not in keys]
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*by)).alias("_row"))
    return newest.select(*keys, "_row.*").select(*df.columns)
