"""Is a value in a word list: flag, keep or drop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def membership(df: DataFrame, words: DataFrame, on: str, how: str = "flag", flag: str = "is_member") -> DataFrame:
    """Test column ``on`` against the column of the same name in ``words``.

    Spark sends the list to every task while its size is under the broadcast threshold and joins by shuffle beyond it.
    An empty or missing value is not a member.
    """
    listed = words.select(on).filter(F.col(on).isNotNull() & (F.col(on) != "")).distinct()
    if how == "keep":
        return df.join(listed, on, "left_semi")
    if how == "drop":
        return df.join(listed, on, "left_anti")
    if how != "flag":
        raise ValueError(f"how must be flag, keep or drop, not {how!r}")
    marked = df.join(listed.withColumn("_listed", F.lit(True)), on, "left")
    return marked.select(*df.columns, F.coalesce("_listed", F.lit(False)).alias(flag))


def check_words(df: DataFrame, words: DataFrame, on: str) -> DataFrame:
    """One row per distinct value with its flag: the values are reduced before they are joined."""
    return membership(df.select(on).filter(F.col(on).isNotNull() & (F.col(on) != "")).distinct(), words, on)
