"""User profile: active days and day parts, what the user has done, first and last day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clock import DAY_PARTS, day_part_index, wall_clock
from tidemark.plans.logs import UNKNOWN

# Log types that set a flag.
FLAGS = {"has_purchase": "purchase", "has_search": "search", "has_view": "view"}


def _known(logs: DataFrame, ts: str) -> DataFrame:
    return logs.filter(
        F.col("user_id").isNotNull() & (F.col("user_id") != UNKNOWN) & F.col("log_type").isNotNull() & F.col(ts).isNotNull()
    )


def profile_months(logs: DataFrame, ts: str = "ts", zone: str | None = None) -> DataFrame:
    """One row of fixed width per user and month: the days as bits, the day parts as bits, what was done.

    All of it is merged by bit and truth aggregates, in tasks before the shuffle and in a stream's state alike.
    """
    wall = wall_clock(F.col(ts), zone)
    known = _known(logs, ts).withColumn("user_id", F.col("user_id").cast("string"))
    return known.groupBy("user_id", F.trunc(wall.cast("date"), "month").alias("month")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.day(wall) - 1)).alias("days"),
        F.bit_or(F.call_function("shiftleft", F.lit(1), day_part_index(wall))).alias("parts"),
        *(F.bool_or(F.col("log_type") == kind).alias(flag) for flag, kind in FLAGS.items()),
    )


def profile_from_months(months: DataFrame, *further) -> DataFrame:
    """Profiles from months; a user collects one short row per month. ``further`` aggregates come last."""
    each = F.filter(F.sequence(F.lit(0), F.lit(30)), lambda n: F.call_function("getbit", F.col("days"), n) == 1)
    dates = F.transform(each, lambda n: F.date_format(F.date_add("month", n), "yyyy-MM-dd"))
    users = months.withColumn("_dates", dates).groupBy("user_id").agg(
        F.sort_array(F.flatten(F.collect_list("_dates"))).alias("_days"),
        F.bit_or("parts").alias("_bits"),
        *(F.bool_or(flag).alias(flag) for flag in FLAGS),
        *further,
    )
    named = F.array(*(F.when(F.col("_bits").bitwiseAND(1 << i) != 0, F.lit(p)) for i, p in enumerate(DAY_PARTS)))
    more = users.columns[3 + len(FLAGS) :]
    return users.withColumn("_parts", F.sort_array(F.array_compact(named))).select(
        "user_id",
        F.array_join("_days", ",").alias("login_dates"),
        F.size("_days").alias("login_days_count"),
        F.array_join("_parts", ",").alias("login_periods"),
        *(F.col(flag).cast("string").alias(flag) for flag in FLAGS),
        F.array_min("_days").alias("first_login_date"),
        F.array_max("_days").alias("last_login_date"),
        *more,
    )


def user_profile(logs: DataFrame, ts: str = "ts", zone: str | None = None) -> DataFrame:
    """One row per user over any kind of event: days and day parts (sorted, comma-joined), flags, first and last day."""
    return profile_from_months(profile_months(logs, ts, zone))
