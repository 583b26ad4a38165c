"""Tables dated by a partition column."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.folders import listed


def latest_partition(df: DataFrame, column: str = "ds") -> DataFrame:
    """Rows of the greatest value of any column, by a scan of that column. ``read_latest`` finds a partition without one."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def partition_names(spark: SparkSession, path: str, column: str = "ds") -> dict[str, str]:
    """The values of the first partition column of a folder with the names of their subfolders; the null partition is left out."""
    mark = f"{column}="
    names = [n for n in listed(spark, path) if n.startswith(mark) and n != f"{mark}__HIVE_DEFAULT_PARTITION__"]
    return {unquote(n.removeprefix(mark)): n for n in names}


def read_latest(spark: SparkSession, path: str, column: str = "ds") -> DataFrame:
    """Rows of the newest partition of a Parquet folder. The names of the folders tell which one it is, and only that is listed and read.

    Values compare as whole numbers if all are such, else as text, which is right for days as ``yyyyMMdd`` and in ISO form. A
    folder without partitions of this column gives its rows as they are.
    """
    names = partition_names(spark, path, column)
    if not names:
        return spark.read.parquet(path)
    newest = max(names, key=int) if all(v.isdecimal() for v in names) else max(names)
    return spark.read.option("basePath", path).parquet(f"{path}/{names[newest]}")


def day_partitions(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day from ``first`` to ``last`` inclusive as a ``yyyyMMdd`` number."""
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    span = F.when(F.lit(first).cast("date") <= F.lit(last).cast("date"), days)
    return spark.range(1).select(F.explode(span).alias("day")).select(F.date_format("day", "yyyyMMdd").cast("int").alias("ds"))
