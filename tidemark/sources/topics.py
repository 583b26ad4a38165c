"""Topic sources and sinks: option builders around Spark's Kafka connector, which the caller's cluster provides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def source_options(servers: str, topic: str, starting: str | int = "earliest", **extra: str) -> dict[str, str]:
    """Reader options. ``starting`` is ``"earliest"``, ``"latest"`` or epoch milliseconds."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **extra}
    if isinstance(starting, int):
        return options | {"startingTimestamp": str(starting), "startingOffsetsByTimestampStrategy": "latest"}
    return options | {"startingOffsets": starting}


def sink_options(servers: str, topic: str, max_request_bytes: int | None = None, **extra: str) -> dict[str, str]:
    """Writer options: every replica acknowledges, the producer is idempotent and keeps retrying."""
    options = {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.retries": str(2**31 - 1),
        **extra,
    }
    if max_request_bytes:
        options["kafka.max.request.size"] = str(max_request_bytes)
    return options


def read_topic(spark: SparkSession, options: dict[str, str], streaming: bool = True) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return text_values(reader.format("kafka").options(**options).load())


def text_values(df: DataFrame) -> DataFrame:
    """Message values as text; tombstones (NULL values) are left out."""
    return df.filter(F.col("value").isNotNull()).select(F.col("value").cast("string").alias("value"))


def to_topic_value(df: DataFrame, key: Column | None = None) -> DataFrame:
    """One UTF-8 JSON message per row, without a key unless one is given."""
    value = F.to_json(F.struct("*")).cast("binary").alias("value")
    return df.select(value) if key is None else df.select(key.cast("string").cast("binary").alias("key"), value)


def send(df: DataFrame, options: dict[str, str], key: Column | None = None) -> None:
    """Batch send of rows as JSON messages."""
    to_topic_value(df, key).write.format("kafka").options(**options).save()


def send_stream(
    df: DataFrame, options: dict[str, str], checkpoint: str, key: Column | None = None, every: str | None = None, sink: str = "kafka"
) -> StreamingQuery:
    """Rows of a stream as JSON messages, going on from ``checkpoint``. Every row goes out at least once; with a key, in order by key.

    ``sink`` may name another of Spark's stream formats with the same frame, such as ``parquet`` with a ``path`` option.
    """
    writer = to_topic_value(df, key).writeStream.format(sink).options(**options).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
