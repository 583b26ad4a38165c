"""Operator 6: exact top-k inner product search by Fagin's threshold algorithm.

Candidates are dealt into shards of about ``SHARD_ROWS`` vectors and queries into blocks of ``BLOCK_ROWS``; each pair of a
block and a shard is one bounded group. Inside it every dimension is a list of the shard sorted by value. For a query the
lists are read in step, downwards where its component is positive and upwards where it is negative, a stretch of ``STRIDE``
places at a time; every vector met for the first time is scored in full. The sum of the query's components times the values
at the current depth bounds all vectors not met yet: the query stops once its kth score is greater. Ties cannot be lost, as
an equal bound does not stop. The best k of all shards are ranked in Spark, limited in each task before the shuffle.

Defined cases: vectors that are null or hold a null or non-finite component take no part, neither do rows without an id.
Rows that repeat id and vector count once; a row with the query's own id is never its candidate. Missing components of a
shorter vector count as 0. Scores are exact integers; one that a 64-bit integer cannot hold raises an error. Ties go to the
smaller id. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import keep, table

SHARD_ROWS, BLOCK_ROWS, STRIDE = 8192, 1024, 64
EXACT = 2.0**53


def quantised(vector: Column) -> Column:
    """floor(256 * x) of each component; null unless all components are finite."""

    def bad(x: Column) -> Column:
        x = x.cast("double")
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    return F.when(vector.isNull() | F.exists(vector, bad), None).otherwise(F.transform(vector, lambda x: F.floor(256 * x.cast("double")).cast("long")))


def matrix(vectors: pd.Series) -> np.ndarray:
    """Rows of integers, with zeros for missing components."""
    wide = max((len(v) for v in vectors), default=0)
    rows = np.zeros((len(vectors), wide), dtype=np.int64)
    for n, v in enumerate(vectors):
        rows[n, : len(v)] = v
    return rows


def threshold_search(query: np.ndarray, own: int, rows: np.ndarray, ids: np.ndarray, order: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions and scores of the ``k`` best rows. ``order[:, d]`` sorts the rows by dimension ``d``."""
    n = len(rows)
    met = ids == own
    best, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=rows.dtype)
    up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
    if not len(up) + len(down):
        place = np.flatnonzero(~met)
        place = place[np.argsort(ids[place], kind="stable")][:k]
        return place, np.zeros(len(place), dtype=rows.dtype)
    for depth in range(0, n, STRIDE):
        last = min(n, depth + STRIDE) - 1
        new = np.zeros(n, dtype=bool)
        new[order[n - 1 - last : n - depth][:, up]] = True
        new[order[depth : last + 1][:, down]] = True
        new &= ~met
        place = np.flatnonzero(new)
        if len(place):
            met |= new
            found = rows[place] @ query
            if len(best) == k:
                place, found = place[found >= scores[-1]], found[found >= scores[-1]]
            best, scores = np.concatenate([best, place]), np.concatenate([scores, found])
            top = np.lexsort((ids[best], -scores))[:k]
            best, scores = best[top], scores[top]
        bound = query[up] @ rows[order[n - 1 - last, up], up] + query[down] @ rows[order[last, down], down]
        if len(best) == k and scores[-1] > bound or met.all():
            break
    return best, scores


def _search(k: int):
    def search(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(queries) and len(shard):
            q, rows = matrix(queries["v"]), matrix(shard["v"])
            wide = max(q.shape[1], rows.shape[1])
            q, rows = (np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m in (q, rows))
            ids = shard["id"].to_numpy()
            order = np.argsort(rows, axis=0, kind="stable")
            largest = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(rows.astype(float)).max(initial=0)) * max(1, wide)
            kind = float if largest < EXACT else object
            q, rows = q.astype(kind), rows.astype(kind)
            for own, query in zip(queries["id"].to_numpy(), q):
                best, scores = threshold_search(query, own, rows, ids, order, k)
                found += [(int(own), int(ids[b]), int(s)) for b, s in zip(best, scores)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Each query's ``k`` best rows: query_id, rank, vec_id, score. ``is_query`` is a condition on the column ``id``."""
    rows = vectors.select(vectors[vec_id].cast("long").alias("id"), quantised(vectors[vector]).alias("v"))
    rows = keep(rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull()).distinct())
    queries = rows.filter(is_query)
    shards, blocks = (max(1, -(-n // size)) for n, size in ((rows.count(), SHARD_ROWS), (queries.count(), BLOCK_ROWS)))
    shard, block = (F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int") for n in (shards, blocks))

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.select("id", "v", block.alias("block")).withColumn("shard", every(shards))
    right = rows.select("id", "v", shard.alias("shard")).withColumn("block", every(blocks))
    groups = blocks * shards
    by_pair = [F.col("block"), F.col("shard")]
    parts = (
        left.repartition(groups, *by_pair).groupBy(*by_pair).cogroup(right.repartition(groups, *by_pair).groupBy(*by_pair))
        .applyInPandas(_search(k), "query_id long, vec_id long, score long")
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return parts.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


SQL = """
WITH v AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""
