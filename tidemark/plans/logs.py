"""User logs: page views, search words, login regions, paths, devices.

The long classification rules (provinces, platforms, brands) run on distinct value combinations with their counts, not
on every log row. A stream counts directly instead, since it allows one aggregation in update mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.clock import epoch_to_ts, wall_clock
from tidemark.functions.device import OTHER, PLATFORMS, UNKNOWN_MODEL, brand_of, platform_of
from tidemark.functions.region import COUNTRY, in_china, province
from tidemark.functions.text import field, strip, words
from tidemark.operators.paths import path_patterns
from tidemark.operators.ranking import top_rows
from tidemark.sources.records import USER_LOG, parse_json

LOG_THRESHOLD = 1_000_000_000_000
UNKNOWN = "unknown"

# Section names of the path report and how many rows each shows.
SECTIONS = {"行为类型": ("log_type", 10), "操作类型": ("opa", 8), "页面访问": ("pageinfo", 8)}


def log_rows(values: DataFrame, column: str = "value") -> DataFrame:
    """Raw JSON log records to rows with event time; unreadable records are dropped."""
    rows = parse_json(values, USER_LOG, column)
    return rows.withColumn("ts", epoch_to_ts(F.col("ts"), LOG_THRESHOLD))


def _counted(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Column]:
    """Distinct combinations with a weight, and the aggregate that adds the weights up."""
    if df.isStreaming:
        return df.select(*columns), F.count(F.lit(1))
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_times")), F.sum("_times")


def page_pv(logs: DataFrame, ts: str = "ts", zone: str | None = None) -> DataFrame:
    """``stat_date, page_type, pv_count`` per local day."""
    known = logs.filter(F.col("log_type").isNotNull() & F.col(ts).isNotNull())
    counts = known.groupBy(F.to_date(wall_clock(F.col(ts), zone)).alias("_day"), F.col("log_type").alias("page_type")).agg(
        F.count(F.lit(1)).alias("pv_count")
    )
    return counts.select(F.col("_day").cast("string").alias("stat_date"), "page_type", "pv_count")


def search_words(col: Column) -> Column:
    """Words of a search: comma-separated text, or a JSON list of words."""
    listed = F.from_json(F.when(F.startswith(col, F.lit("[")), col), "array<string>")
    named = F.filter(F.transform(listed, strip), lambda w: w != "")
    return F.coalesce(named, words(col))


def found_words(logs: DataFrame, column: str = "keywords") -> DataFrame:
    """One row per word of each search."""
    return logs.select(F.explode(search_words(F.col(column))).alias("keyword"))


def keyword_counts(logs: DataFrame, column: str = "keywords") -> DataFrame:
    return found_words(logs, column).groupBy("keyword").agg(F.count(F.lit(1)).alias("search_count"))


def rank_keywords(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most searched words with rank and the number of distinct words."""
    top = top_rows(counts, [F.desc("search_count"), F.asc("keyword")], k, "ranking")
    total = counts.agg(F.count(F.lit(1))).scalar()
    return top.withColumn("total_keywords", total)


def keyword_top10(logs: DataFrame, column: str = "keywords", k: int = 10) -> DataFrame:
    return rank_keywords(keyword_counts(logs, column), k)


def region_login(logs: DataFrame, login_type: str = "login") -> DataFrame:
    """``country, province, login_count`` of logins from China whose province is named."""
    distinct, total = _counted(logs.filter(F.col("log_type") == login_type), ["region"])
    place = field(F.col("region"))
    # tied to the count, or the optimizer would move the rules down to the log rows
    counted = F.lit(True) if logs.isStreaming else F.col("_times") > 0
    return (
        distinct.withColumn("province", F.when(counted & in_china(place), province(place)))
        .filter(F.col("province") != "")
        .groupBy(F.lit(COUNTRY).alias("country"), "province")
        .agg(total.alias("login_count"))
    )


def path_counts(logs: DataFrame) -> DataFrame:
    """``stat_type, stat_key, stat_value``: how often each behaviour, operation and page occurs."""
    columns = [column for column, _ in SECTIONS.values()]
    distinct, total = _counted(logs, columns)
    distinct = distinct.withColumns({c: field(F.col(c)) for c in columns}).filter(F.col("log_type") != "")
    kinds = {section: F.col(column) for section, (column, _) in SECTIONS.items()}
    pairs = F.array(*(F.struct(F.lit(s).alias("stat_type"), c.alias("stat_key")) for s, c in kinds.items()))
    weight = [c for c in distinct.columns if c == "_times"]
    return (
        distinct.select(F.explode(pairs).alias("s"), *weight)
        .select("s.*", *weight)
        .filter(F.col("stat_key") != "")
        .groupBy("stat_type", "stat_key")
        .agg(total.alias("stat_value"))
    )


def path_distribution(counts: DataFrame) -> DataFrame:
    """The most frequent entries of each section, ranked."""
    order = W.partitionBy("stat_type").orderBy(F.desc("stat_value"), F.asc("stat_key"))
    most = max(limit for _, limit in SECTIONS.values())
    ranked = counts.withColumn("ranking", F.row_number().over(order)).filter(F.col("ranking") <= most)
    keep = F.lit(False)
    for section, (_, limit) in SECTIONS.items():
        keep = keep | ((F.col("stat_type") == section) & (F.col("ranking") <= limit))
    return ranked.filter(keep)


def named(logs: DataFrame) -> DataFrame:
    """Rows of a known user with a known kind of event."""
    cleaned = logs.withColumns(
        {"user_id": field(F.col("user_id"), UNKNOWN), "log_type": field(F.col("log_type"))}
    )
    return cleaned.filter((F.col("user_id") != UNKNOWN) & (F.col("log_type") != ""))


def active_users(logs: DataFrame) -> DataFrame:
    return named(logs).agg(F.count_distinct("user_id").alias("active_users"))


def common_paths(logs: DataFrame, tie: list[str], ts: str = "ts", k: int = 5) -> DataFrame:
    """The behaviour paths walked by most users; see ``operators.paths``."""
    rows = named(logs).select("user_id", "log_type", ts, *tie)
    return path_patterns(rows, "user_id", "log_type", ts, tie, k)


def device_stats(logs: DataFrame) -> DataFrame:
    """``stat_type, platform_type, stat_key, stat_value``: platforms, brands, models, platform and app versions."""
    columns = ["brand", "device", "plat", "platv", "softv"]
    distinct, total = _counted(logs, columns)
    cleaned = distinct.withColumns({c: field(F.col(c)) for c in columns})
    typed = cleaned.filter((F.col("brand") != "") | (F.col("plat") != "")).withColumn("platform_type", platform_of(F.col("plat"), F.col("brand")))
    keys = {
        "platform_type": F.col("platform_type"),
        "brand": F.when(F.col("brand") != OTHER, F.col("brand")),
        "device_model": F.when(brand_of(F.col("device"), F.col("platform_type")) != OTHER, F.col("device")),
        "platform_version": F.col("platv"),
        "software_version": F.col("softv"),
    }
    pairs = F.array(*(F.struct(F.lit(t).alias("stat_type"), c.alias("stat_key")) for t, c in keys.items()))
    weight = [c for c in distinct.columns if c == "_times"]
    return (
        typed.select("platform_type", F.explode(pairs).alias("s"), *weight)
        .select("platform_type", "s.*", *weight)
        .filter(F.col("stat_key") != "")
        .groupBy("stat_type", "platform_type", "stat_key")
        .agg(total.alias("stat_value"))
    )


def platform_share(stats: DataFrame) -> DataFrame:
    """Each platform's count and share of the total, percent to one place; platforms without rows show 0."""
    platforms = stats.filter(F.col("stat_type") == "platform_type")

    def count_of(platform: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stat_key") == platform, F.col("stat_value"))), F.lit(0)).alias(platform)

    counts = platforms.agg(*map(count_of, PLATFORMS), F.coalesce(F.sum("stat_value"), F.lit(0)).alias("total"))
    rows = F.array(*(F.struct(F.lit(p).alias("platform_type"), F.col(p).alias("cnt"), "total") for p in PLATFORMS))
    share = F.format_string("%.1f%%", F.col("cnt") * F.lit(100.0) / F.col("total"))
    return counts.select(F.inline(rows)).filter(F.col("total") > 0).select("platform_type", "cnt", share.alias("share"))


def device_detail(stats: DataFrame) -> DataFrame:
    """Every brand and model with its count, most frequent first."""
    brands = stats.filter(F.col("stat_type") == "brand").select(
        "platform_type", F.col("stat_key").alias("brand"), F.lit(UNKNOWN_MODEL).alias("model"), F.col("stat_value").alias("cnt")
    )
    models = stats.filter(F.col("stat_type") == "device_model").select(
        "platform_type",
        brand_of(F.col("stat_key"), F.col("platform_type")).alias("brand"),
        F.col("stat_key").alias("model"),
        F.col("stat_value").alias("cnt"),
    )
    return brands.unionByName(models).orderBy(F.desc("cnt"), "platform_type", "brand", "model")


def stats_by_type(stats: DataFrame, stat_type: str) -> DataFrame:
    """One kind of statistic, by platform, greatest first."""
    return stats.filter(F.col("stat_type") == stat_type).orderBy("platform_type", F.desc("stat_value"), "stat_key")


def top_stats(stats: DataFrame, stat_type: str, platform: str | None = None, k: int | None = 10) -> DataFrame:
    """``stat_key, stat_value`` of one kind, greatest first; the first ``k``, or all."""
    rows = stats.filter(F.col("stat_type") == stat_type)
    if platform is not None:
        rows = rows.filter(F.col("platform_type") == platform)
    ordered = rows.select("stat_key", "stat_value").orderBy(F.desc("stat_value"), "stat_key")
    return ordered if k is None else ordered.limit(k)
