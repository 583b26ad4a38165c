"""Event time, local days and day parts.

A *wall clock* is a TIMESTAMP_NTZ: the local reading of an instant. Operators that cut days work on wall clocks, so a
day always starts at local midnight, whatever the session zone is.
"""

from __future__ import annotations

import datetime as dt
import re
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLOCK = "yyyy-MM-dd HH:mm:ss"
DAY_SECONDS = 86_400

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3_600, "day": DAY_SECONDS}


def seconds_of(span: str | int) -> int:
    """``"10 minutes"`` -> 600. Integers are seconds already."""
    if isinstance(span, int):
        return span
    match = re.fullmatch(r"\s*(\d+)\s*(second|minute|hour|day)s?\s*", span.lower())
    if not match:
        raise ValueError(f"not a span of seconds, minutes, hours or days: {span!r}")
    return int(match[1]) * _UNIT_SECONDS[match[2]]


def epoch_to_ts(col: Column, threshold: int = 100_000_000_000) -> Column:
    """Epoch number to TIMESTAMP; values below ``threshold`` are seconds, the others milliseconds."""
    number = col.cast("bigint")
    return F.timestamp_millis(F.when(number < threshold, number * 1000).otherwise(number))


def wall_clock(col: Column, zone: str | None = None) -> Column:
    """Local reading of an instant in ``zone``, or in the session zone. An NTZ column without a zone is unchanged."""
    local = col.cast(T.TimestampNTZType())
    return local if zone is None else F.convert_timezone(None, F.lit(zone), local)


def day_text(col: Column, zone: str | None = None) -> Column:
    return wall_clock(col, zone).cast("date").cast("string")


def clock_text(col: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of an instant (session zone) or a wall clock (as it is)."""
    return F.left(col.cast("string"), F.lit(19))


def now_text(now: Column | None = None) -> Column:
    """Time of the batch as text, or of an injected ``now``."""
    return clock_text(F.current_timestamp() if now is None else now)


def parse_clock(col: Column, pattern: str = CLOCK) -> Column:
    """Text to wall clock; unreadable text gives NULL."""
    return F.try_to_timestamp(col, F.lit(pattern)).cast(T.TimestampNTZType())


def second_of_day(wall: Column) -> Column:
    return F.hour(wall) * 3600 + F.minute(wall) * 60 + F.second(wall)


def at_second(day: Column, second: Column) -> Column:
    """Wall clock ``second`` seconds after the start of ``day``; 86400 is the next midnight."""
    return F.timestamp_add("SECOND", second, day.cast(T.TimestampNTZType()))


# The labels of the four day parts.
DAY_PARTS = ("6:00-12:00", "12:00-18:00", "18:00-22:00", "22:00-6:00")


def day_part_index(wall: Column) -> Column:
    hour = F.hour(wall)
    return (
        F.when(hour.between(6, 11), 0).when(hour.between(12, 17), 1).when(hour.between(18, 21), 2).when(hour.isNotNull(), 3)
    )


def day_part(wall: Column) -> Column:
    return F.get(F.array(*map(F.lit, DAY_PARTS)), day_part_index(wall))


def in_days(df: DataFrame, ts: str, first: str, last: str | None = None, zone: str | None = None) -> DataFrame:
    """Rows whose local day lies in ``first..last`` (inclusive), as a range on the raw column.

    The bounds fold to literals of the column's own type, so the range reaches the Parquet scan, which
    ``to_date(ts) = day`` would not.
    """
    start = dt.date.fromisoformat(first)
    stop = dt.date.fromisoformat(last or first) + dt.timedelta(days=1)

    def bound(day: dt.date) -> Column:
        midnight = F.lit(day.isoformat()).cast(T.TimestampNTZType())
        if zone is not None:
            midnight = F.convert_timezone(F.lit(zone), F.current_timezone(), midnight)
        return midnight.cast(df.schema[ts].dataType)

    return df.filter((F.col(ts) >= bound(start)) & (F.col(ts) < bound(stop)))


def local_midnight_ms(zone: str, now: dt.datetime | None = None) -> int:
    """Epoch milliseconds of today's local midnight: the start position of the intraday job."""
    here = (now or dt.datetime.now(dt.timezone.utc)).astimezone(ZoneInfo(zone))
    return int(here.replace(hour=0, minute=0, second=0, microsecond=0).timestamp() * 1000)


def since_midnight(df: DataFrame, ts: str, now: Column | None = None) -> DataFrame:
    """Rows at or after the session-local midnight of ``now`` (default: the batch's current time)."""
    today = F.date_trunc("day", F.current_timestamp() if now is None else now)
    return df.filter(F.col(ts) >= today.cast(df.schema[ts].dataType))
