"""Event time from record fields, with a bound on disorder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELAY = "5 seconds"


def with_watermark(df: DataFrame, ts: str = "ts", delay: str = DELAY) -> DataFrame:
    """Accept rows up to ``delay`` behind the latest event time. Wall-clock columns become instants first."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def with_event_time(df: DataFrame, *fields: Column, unit: str = "ms", delay: str = DELAY, name: str = "event_time") -> DataFrame:
    """Event time from the first of ``fields`` that is present, in milliseconds or seconds; none gives the epoch.

    Fields may be numbers or text; text that is no number counts as missing.
    """
    if unit not in ("ms", "s"):
        raise ValueError(f"unit must be ms or s, not {unit!r}")
    millis = F.coalesce(*(f.cast("string").try_cast("bigint") for f in fields), F.lit(0)) * (1 if unit == "ms" else 1000)
    return df.withColumn(name, F.timestamp_millis(millis)).withWatermark(name, delay)


def json_event_time(df: DataFrame, field: str, column: str = "value", delay: str = DELAY) -> DataFrame:
    """Event time from a millisecond field of raw JSON text; unreadable records get the epoch."""
    return with_event_time(df, F.get_json_object(column, f"$.{field}"), delay=delay)


def batch_event_time(df: DataFrame, records: str, field: str = "window_start_time", delay: str = DELAY) -> DataFrame:
    """Event time of a row that holds a list of records: the field of the first one, in milliseconds."""
    return with_event_time(df, F.get(F.col(records), F.lit(0))[field], delay=delay)
