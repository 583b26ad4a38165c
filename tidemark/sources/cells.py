"""Wide-column tables as cells ``(row_key, qualifier, value)``, every value a text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cells_from_rows(df: DataFrame, key: str) -> DataFrame:
    """One cell per field of each row; NULL fields have no cell."""
    fields = [c for c in df.columns if c != key]
    texts = df.select(F.col(key).cast("string").alias("row_key"), *(F.col(c).cast("string").alias(c) for c in fields))
    return texts.unpivot("row_key", fields, "qualifier", "value").filter(F.col("value").isNotNull())


def _first_keys(cells: DataFrame, limit: int) -> DataFrame:
    return cells.select("row_key").distinct().orderBy("row_key").limit(limit)


def rows_from_cells(cells: DataFrame, columns: list[str], limit: int | None = None) -> DataFrame:
    """Cells back to rows of ``columns``; ``limit`` keeps the first rows in key order."""
    if limit is not None:
        cells = cells.join(_first_keys(cells, limit), "row_key", "left_semi")
    picks = (F.max(F.when(F.col("qualifier") == c, F.col("value"))).alias(c) for c in columns)
    return cells.groupBy("row_key").agg(*picks)


def documents_from_cells(cells: DataFrame, limit: int | None = None) -> DataFrame:
    """Cells to one map per row, for tables whose qualifiers are not known beforehand. A row is one value here: use
    ``rows_from_cells`` with the wanted columns where rows may be wider than a task can hold."""
    if limit is not None:
        cells = cells.join(_first_keys(cells, limit), "row_key", "left_semi")
    entries = F.array_sort(F.collect_list(F.struct("qualifier", "value")))
    return cells.groupBy("row_key").agg(F.map_from_entries(entries).alias("document"))


def get_row(cells: DataFrame, row_key: str) -> DataFrame:
    return cells.filter(F.col("row_key") == row_key)


def row_count(cells: DataFrame) -> DataFrame:
    return cells.agg(F.count_distinct("row_key").alias("row_count"))


def delete_keys(df: DataFrame, keys: DataFrame, on: str | list[str] = "row_key") -> DataFrame:
    """Rows whose key is not in the list of keys."""
    return df.join(keys, on, "left_anti")
