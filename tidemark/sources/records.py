"""JSON records: the same parse for topics, text files and JSON-lines files, on tables and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import strip

_CORRUPT = "_corrupt_record"


def text_schema(names: str | tuple[str, ...], numbers: tuple[str, ...] = ()) -> T.StructType:
    """Schema of field names, a tuple or one spaced text: text, except ``numbers``, which are whole numbers."""
    listed = names.split() if isinstance(names, str) else names
    return T.StructType([T.StructField(name, T.LongType() if name in numbers else T.StringType()) for name in listed])


# The fields of an order line and of a user log.
ORDER_FIELDS = (
    "id", "order_id", "user_id", "user_name", "phone_number", "product_link", "product_id", "color", "size", "item_id", "material", "sale_num",
    "sale_amount", "total_amount", "product_name", "is_online_sales", "shipping_address", "recommendations_product_ids", "ds", "ts", "insert_time",
    "table_name", "op",
)
LOG_FIELDS = ("user_id", "log_type", "ts", "keywords", "region", "opa", "pageinfo", "brand", "device", "plat", "platv", "softv")

ORDER_LINE = text_schema(ORDER_FIELDS, numbers=("ts",))
USER_LOG = text_schema(LOG_FIELDS, numbers=("ts",))


def parsed_once(df: DataFrame, column: str, schema: T.StructType, options: dict[str, str]) -> DataFrame:
    """Add the parsed record as ``_row``.

    A plain column would be parsed again by each filter and projection the optimizer moves it into. The rows of a
    generator are not: a list of one record gives the same row, parsed once.
    """
    return df.withColumn("_row", F.explode(F.array(F.from_json(column, schema, options))))


def _parsed(df: DataFrame, schema: T.StructType, column: str) -> tuple[DataFrame, Column]:
    with_mark = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    out = parsed_once(df, column, with_mark, {"columnNameOfCorruptRecord": _CORRUPT})
    # a wrong field type also sets the mark, but only costs that field; a row is bad when the text is not a JSON object
    not_object = ~F.startswith(strip(F.col(column)), F.lit("{"))
    unreadable = F.col(f"_row.{_CORRUPT}").isNotNull() & F.try_parse_json(column).isNull()
    return out, F.col(column).isNull() | not_object | unreadable


def parse_json(df: DataFrame, schema: T.StructType, column: str = "value", on_bad: str = "drop") -> DataFrame:
    """Parse a JSON text column to ``schema``, keeping the other columns.

    Missing fields and fields of a wrong type are NULL. Rows that are not a JSON object are dropped, fail the job
    (``on_bad="fail"``), or are kept with every field NULL and ``is_bad`` set (``on_bad="keep"``).
    """
    others = [c for c in df.columns if c != column]
    if on_bad == "fail":
        return parsed_once(df, column, schema, {"mode": "FAILFAST"}).select(*others, "_row.*")
    if on_bad not in ("drop", "keep"):
        raise ValueError(f"on_bad must be drop, fail or keep, not {on_bad!r}")
    parsed, bad = _parsed(df, schema, column)
    fields = [F.col(f"_row.{name}") for name in schema.names]
    if on_bad == "drop":
        return parsed.filter(~bad).select(*others, *fields)
    return parsed.select(*others, *fields, bad.alias("is_bad"))


def rejects(df: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """The rows ``parse_json`` drops, as they came."""
    parsed, bad = _parsed(df, schema, column)
    return parsed.filter(bad).select(*df.columns)


def variant_records(df: DataFrame, column: str = "value", record: str = "record") -> DataFrame:
    """JSON text read once, to a variant that names no fields yet; rows that are not a JSON object are dropped.

    ``typed`` gives fields their types, only those that a query goes on to use.
    """
    others = [c for c in df.columns if c != column]
    # rows of a generator are not read again by each filter and projection, see ``parsed_once``
    parsed = df.withColumn(record, F.explode(F.array(F.try_parse_json(column))))
    return parsed.filter(F.col(record).isNotNull() & F.startswith(strip(F.col(column)), F.lit("{"))).select(*others, record)


def typed(df: DataFrame, schema: T.StructType, record: str = "record") -> DataFrame:
    """The fields of ``schema`` from variant records, leniently: a missing field, or one that cannot be of its type, is NULL.

    A number in quotes counts as a number here, which ``parse_json`` does not take.
    """
    fields = [F.try_variant_get(record, f"$['{f.name}']", f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    return df.select(*(c for c in df.columns if c != record), *fields)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType, streaming: bool = False) -> DataFrame:
    """JSON-lines files to rows, leniently, as a table or a file stream."""
    lines = (spark.readStream if streaming else spark.read).text(path)
    return parse_json(lines, schema)


def write_text(df: DataFrame, path: str) -> None:
    """Replace a folder of text lines."""
    df.write.mode("overwrite").text(path)


def write_partitioned(df: DataFrame, path: str, *fields: str, mode: str = "append") -> None:
    """Parquet folders split by ``fields``, one shuffle by them first so that a folder gets few files.

    The rows of one partition value are spread over several tasks when they are many: the rebalance splits them.
    """
    df.hint("rebalance", *fields).write.mode(mode).partitionBy(*fields).parquet(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int = 6, mode: str = "overwrite") -> None:
    """Catalog table hash-distributed by ``key``, so joins and groupings on the key need no shuffle."""
    df.write.mode(mode).bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def truncate(spark: SparkSession, path: str) -> None:
    """Empty a Parquet folder, keeping its schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
