"""Connected components by alternating large and small stars, each round a few joins on stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep

#: Rows of a table of edges that a task takes.
TASK_ROWS = 50_000


def tasks_for(rows: int) -> int:
    """Partitions for a table of so many short rows. As many as Spark shuffles to, each leaving its files, would hold mostly nothing."""
    return -(-rows // TASK_ROWS) or 1


def _star(edges: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Tie the larger (or smaller) neighbours of every node to the smallest one."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.filter(F.col("v") < F.col("u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.join(least, "u")
    if large:
        tied = tied.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        tied = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return tied.filter(F.col("u") != F.col("v")).coalesce(tasks).distinct().coalesce(tasks)


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(node, root) of every node with an edge; the root is the smallest node of its component. ``edges``: long u and v; ``rows``: their number, if known.

    Every star is stored: as part of the next one's plan it would stand there four times.
    """
    now = keep(edges.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    tasks = tasks_for(now.count() if rows is None else rows)
    now, mark = now.coalesce(tasks), None
    while True:
        for large in (True, False):
            now = keep(_star(now, large, tasks))
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
