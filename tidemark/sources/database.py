"""Database reads and appends through Spark's JDBC source. All connection settings come from the caller."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def camel(name: str) -> str:
    """``order_total_amount`` -> ``orderTotalAmount``."""
    return re.sub(r"_+([a-z0-9])", lambda m: m[1].upper(), name.lower())


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*map(camel, df.columns))


def read_query(spark: SparkSession, options: dict[str, str], query: str, to_camel: bool = False) -> DataFrame:
    """Rows of a query. ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in ``options`` split
    the read into ranges; Spark wants ``dbtable`` for that, so the query goes in as a derived table."""
    source = {"dbtable": f"({query}) q"} if "partitionColumn" in options else {"query": query}
    df = spark.read.format("jdbc").options(**options, **source).load()
    return camel_columns(df) if to_camel else df


def append(df: DataFrame, options: dict[str, str], table: str) -> None:
    """Insert rows, in batches, from every partition at once."""
    df.write.format("jdbc").options(**options, dbtable=table).mode("append").save()
