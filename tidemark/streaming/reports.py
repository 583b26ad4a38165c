"""Report streams.

Windowed reports keep sums per short window as state and hand each window over once, when the watermark has passed its
end. The rows of rankings and cumulative windows are computed from those sums as tables, by the batch that closes them, and
stored once (``streaming.running``); no task ever holds a whole window. Counts without windows need no state at all: each micro-batch stores its own increments, and the table adds
them up.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Mapping, Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.clock import day_text, seconds_of
from tidemark.functions.text import clean_id, present
from tidemark.operators.cumulate import best
from tidemark.operators.lookup import as_of
from tidemark.operators.merging import ranked_snapshot, stamped
from tidemark.operators.paths import PIECE, common, path_pieces, user_digests, written_out
from tidemark.operators.ranking import rank_list, top_rows
from tidemark.plans import logs as log_plans
from tidemark.plans.profile import profile_from_months, profile_months
from tidemark.plans.sales import amount_of, cumulative_from_steps, gmv_topn_from_steps, report_money
from tidemark.sources.changes import flatten_envelope, last_changes, latest_state
from tidemark.sources.topics import send_stream
from tidemark.streaming.eventtime import DELAY, with_watermark
from tidemark.streaming.running import BY, tumble_sink, window_sink, windows_view
from tidemark.streaming.tables import (
    BATCH,
    aggregate_view,
    append,
    append_view,
    batch_sink,
    compact,
    read_batch,
    read_batches,
    start,
    unique_view,
    write_batch,
)

# every zone in use lies a multiple of a quarter hour from UTC, and clocks change by half or whole hours
_QUARTER = 900


def closed_windows(
    stream: DataFrame, span: str, sums: Mapping[str, Column], keys: Sequence[str] = (), ts: str = "ts", delay: str = DELAY
) -> DataFrame:
    """``window_start, window_end, *keys, *sums`` of tumbling windows; in append mode each appears once, when closed."""
    totals = [F.sum(value).alias(name) for name, value in sums.items()]
    grouped = with_watermark(stream, ts, delay).groupBy(F.window(ts, span).alias("w"), *keys).agg(*totals)
    return grouped.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, *sums
    )


def _slice(stream: DataFrame, step: str, zone: str | None) -> str:
    """Window length that divides the step and starts at local midnight too, though windows count from UTC."""
    zone = zone or stream.sparkSession.conf.get("spark.sql.session.timeZone")
    try:
        offset = dt.datetime.now(ZoneInfo(zone)).utcoffset().seconds
    except (KeyError, ValueError):
        offset = _QUARTER
    return f"{math.gcd(seconds_of(step), 2 * _QUARTER, offset)} seconds"


def stream_cumulative_sales(
    orders: DataFrame,
    path: str,
    checkpoint: str,
    step: str = "10 seconds",
    ts: str = "ts",
    zone: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """``cumulative_sales`` as a table of rows, each window written when the watermark passes its end, with sales in its step or not."""

    def report(sums: DataFrame, steps: tuple[Column, Column]) -> DataFrame:
        rows = cumulative_from_steps(sums, step, steps)
        return rows.withColumn(BY, F.to_date("window_start"))

    rows = orders.filter(present(F.col("total_amount")))
    money = "total_cumulative_amount"
    closed = closed_windows(rows, _slice(orders, step, zone), {money: amount_of()}, ts=ts)
    return start(closed, window_sink(path, checkpoint, step, [money], [], report, zone), checkpoint, every=every)


def cumulative_sales_view(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    return windows_view(spark, path, day)


def stream_gmv(
    orders: DataFrame,
    path: str,
    checkpoint: str,
    step: str = "10 minutes",
    k: int = 5,
    ts: str = "ts",
    zone: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """``gmv_topn`` as a table of report rows, each written when the watermark passes the window's end."""

    def report(sums: DataFrame, steps: tuple[Column, Column]) -> DataFrame:
        return gmv_topn_from_steps(report_money(sums), step, k, steps).withColumn(BY, F.col("ds"))

    rows = orders.withColumn("clean_product_id", clean_id(F.col("product_id")))
    money = {"product_gmv": F.col("total_amount").cast("decimal(18,2)")}
    closed = closed_windows(rows, _slice(orders, step, zone), money, ["clean_product_id"], ts)
    sink = window_sink(path, checkpoint, step, ["product_gmv"], ["clean_product_id"], report, zone)
    return start(closed, sink, checkpoint, every=every)


def gmv_view(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    return windows_view(spark, path, day)


def stream_tumble_top5(
    orders: DataFrame,
    path: str,
    checkpoint: str,
    window: str = "5 minutes",
    k: int = 5,
    ts: str = "ts",
    key: str = "id",
    zone: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """``tumble_top5`` as a table of rows, each written when the watermark passes the window's end."""
    bounds = ["window_start", "window_end"]

    def report(sums: DataFrame) -> DataFrame:
        return rank_list(best(sums, bounds, "total", key, k), bounds, key, k).withColumnRenamed("top_list", f"top{k}_ids")

    rows = orders.filter(present(F.col("sale_num")) & present(F.col(key)))
    closed = closed_windows(rows, _slice(orders, window, zone), {"total": F.col("sale_num").try_cast("int")}, [key], ts)
    return start(closed, tumble_sink(path, checkpoint, window, key, report, zone), checkpoint, every=every)


def tumble_top5_view(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    return windows_view(spark, path, day)


def stream_page_pv(
    logs: DataFrame, path: str, checkpoint: str, zone: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Running page views per day and type; the table's unique key keeps the last count."""
    return start(log_plans.page_pv(logs, zone=zone), batch_sink(path, stamped), checkpoint, "update", every)


def page_pv_view(spark: SparkSession, path: str) -> DataFrame:
    return unique_view(spark, path, ["stat_date", "page_type"])


def stream_user_profile(
    logs: DataFrame, path: str, checkpoint: str, zone: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Running profiles. State and table hold one row of fixed width per user and month, whatever the user does in it."""
    return start(profile_months(logs, zone=zone), batch_sink(path, stamped), checkpoint, "update", every)


def user_profile_view(spark: SparkSession, path: str) -> DataFrame:
    return profile_from_months(unique_view(spark, path, ["user_id", "month"]), F.max("update_time").alias("update_time"))


def stream_active_users(
    logs: DataFrame, path: str, checkpoint: str, daily: bool = False, ts: str = "ts", zone: str | None = None, every: str | None = None
) -> StreamingQuery:
    """Running number of distinct users, in all or per local day.

    Spark's state store is the ledger of users seen: it is spread by hash of the key, and a batch reads and writes the keys it
    touches. A user passes once, so the table grows by one small number per batch (and day).
    """
    users = log_plans.named(logs)
    if daily:
        known = users.filter(F.col(ts).isNotNull()).select(day_text(F.col(ts), zone).alias("stat_date"), "user_id")
        sink = batch_sink(path, lambda batch: batch.groupBy("stat_date").agg(F.count(F.lit(1)).alias("active_users")))
    else:
        known = users.select("user_id")
        sink = batch_sink(path, lambda batch: batch.agg(F.count(F.lit(1)).alias("active_users")))
    return start(known.dropDuplicates(), sink, checkpoint, every=every)


def active_users_view(spark: SparkSession, path: str) -> DataFrame:
    rows = append_view(spark, path)
    return rows.groupBy(*(c for c in rows.columns if c != "active_users")).agg(F.coalesce(F.sum("active_users"), F.lit(0)).alias("active_users"))


SLICE = "slice"


def stream_paths(
    logs: DataFrame, path: str, checkpoint: str, tie: Sequence[str], slice_: str = "1 hour", delay: str = DELAY, ts: str = "ts", every: str | None = None
) -> StreamingQuery:
    """Keep the digest of every user's path, for ``paths_view``.

    Rows wait, in folders by slice of time, until events are ``delay`` past the end of their slice. The batch that closes a slice
    walks its rows and stores one digest per user in it; a digest goes on where the user's last one ended. Rows of slices that
    are closed already are late and left out.
    """
    spark, span, late = logs.sparkSession, seconds_of(slice_), seconds_of(delay)
    at = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / span)
    rows = log_plans.named(logs).filter(F.col(ts).isNotNull()).select("user_id", "log_type", F.col(ts).alias("ts"), *tie, at.alias(SLICE))

    def store(batch: DataFrame, batch_id: int) -> None:
        before = closed_slices(spark, path, batch_id - 1)
        write_batch(batch.filter(F.col(SLICE) >= before), f"{path}/rows", batch_id, SLICE)
        stored = read_batches(spark, f"{path}/rows").filter(F.col(SLICE) >= before)
        newest = stored.agg(F.max(F.unix_seconds(F.col("ts").cast("timestamp")))).first()[0]
        now = before if newest is None else max(before, (newest - late) // span)
        ready = stored.filter(F.col(SLICE) < now)
        write_batch(path_pieces(ready, "user_id", "log_type", "ts", list(tie)), f"{path}/pieces", batch_id)
        write_batch(spark.range(1).select(F.lit(now).cast("bigint").alias("closed")), f"{path}/closed", batch_id)

    return start(rows, store, checkpoint, every=every)


def closed_slices(spark: SparkSession, path: str, batch_id: int | None = None) -> int:
    """The number of the first slice that is open after a batch, or after the last one."""
    if batch_id is not None:
        return read_batch(spark, f"{path}/closed", batch_id).first()["closed"] if batch_id >= 0 else -(1 << 40)
    return append_view(spark, f"{path}/closed").agg(F.max("closed")).first()[0]


def paths_view(spark: SparkSession, path: str, tie: Sequence[str], k: int = 5) -> DataFrame:
    """The paths walked by most users, up to the last closed slice: ``path, steps, users, first_user``."""
    digests = user_digests(read_batches(spark, f"{path}/pieces"), "user_id", BATCH, PIECE)
    rows = read_batches(spark, f"{path}/rows").filter(F.col(SLICE) < closed_slices(spark, path))
    return written_out(common(digests, "user_id", k), rows, "user_id", "log_type", "ts", list(tie))


def shorten_paths(spark: SparkSession, path: str) -> None:
    """Merge the stored batches: one digest per user, rows in fewer files."""

    def one_digest(pieces: DataFrame) -> DataFrame:
        last = pieces.groupBy("user_id").agg(F.max(BATCH).alias(BATCH), F.max(PIECE).alias(PIECE))
        return user_digests(pieces, "user_id", BATCH, PIECE).join(last, "user_id").select(*pieces.columns)

    compact(spark, f"{path}/pieces", one_digest)
    compact(spark, f"{path}/rows", append)


# increments a micro-batch stores, with the key and the count of the table
_INCREMENTS = {
    "keywords": (log_plans.keyword_counts, ["keyword"], "search_count"),
    "regions": (log_plans.region_login, ["country", "province"], "login_count"),
    "paths": (log_plans.path_counts, ["stat_type", "stat_key"], "stat_value"),
    "devices": (log_plans.device_stats, ["stat_type", "platform_type", "stat_key"], "stat_value"),
}


def stream_counts(kind: str, logs: DataFrame, path: str, checkpoint: str, every: str | None = None, **options) -> StreamingQuery:
    """Store each batch's increments of ``keywords``, ``regions``, ``paths`` or ``devices``."""
    plan = _INCREMENTS[kind][0]
    return start(logs, batch_sink(path, lambda batch: stamped(plan(batch, **options))), checkpoint, every=every)


def counts_view(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """The totals so far: input of ``rank_keywords``, ``path_distribution``, ``platform_share`` and ``device_detail``."""
    _, keys, count = _INCREMENTS[kind]
    return aggregate_view(spark, path, keys, [count], ["update_time"])


def stream_keyword_top10(logs: DataFrame, path: str, checkpoint: str, k: int = 10, every: str | None = None) -> StreamingQuery:
    """Append the ranking of search words after every batch.

    Counts are Spark's state, and a batch is handed the words it has touched, with their totals; those are stored. Counts only
    grow, so the best ``k`` now are among the touched words and the best ``k`` before. A word is new if the batch that saw it last
    is the one that saw it first.
    """
    spark = logs.sparkSession
    found = log_plans.found_words(logs).withColumn("_at", F.current_timestamp())
    words = found.groupBy("keyword").agg(F.count(F.lit(1)).alias("search_count"), (F.min("_at") == F.max("_at")).alias("is_new"))

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, f"{path}/words", batch_id)
        touched = read_batch(spark, f"{path}/words", batch_id)
        known, before = touched.select("keyword", "search_count"), F.lit(0)
        if batch_id > 0:
            last = read_batch(spark, f"{path}/rankings", batch_id - 1).select("keyword", "search_count", "total_keywords")
            known = known.unionByName(last.drop("total_keywords").join(touched, "keyword", "left_anti"))
            before = F.coalesce(last.agg(F.max("total_keywords")).scalar(), F.lit(0))
        total = before + touched.agg(F.count_if("is_new")).scalar()
        ranked = top_rows(known, [F.desc("search_count"), F.asc("keyword")], k, "ranking").withColumn("total_keywords", total)
        write_batch(ranked_snapshot(ranked), f"{path}/rankings", batch_id)

    return start(words, store, checkpoint, "update", every)


def keyword_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Every ranking so far, with the batch it followed."""
    return read_batches(spark, f"{path}/rankings")


def stream_as_of(
    facts: DataFrame,
    changes_path: str,
    path: str,
    checkpoint: str,
    key: str,
    ts: str,
    at: str,
    columns: Sequence[str],
    deleted: Column | None = None,
    every: str | None = None,
    order: Sequence[str] = (),
) -> StreamingQuery:
    """Facts with the values of a dimension that were valid at their time, stored per batch.

    The dimension's changes are a table that another stream appends to (``batch_sink``); each batch reads what has landed, so it
    must be ahead of the facts by event time. No state is kept.
    """
    spark = facts.sparkSession

    def looked_up(batch: DataFrame) -> DataFrame:
        return as_of(batch, append_view(spark, changes_path), key, ts, at, columns, deleted=deleted, order=order)

    return start(facts, batch_sink(path, looked_up), checkpoint, every=every)


def stream_changes(
    envelopes: DataFrame, path: str, checkpoint: str, keys: list[str], order_by: list[str], every: str | None = None
) -> StreamingQuery:
    """Land the last change per key of each batch; ``changes_view`` settles the order of batches."""
    return start(envelopes, batch_sink(path, lambda batch: last_changes(batch, keys, order_by)), checkpoint, every=every)


def stream_clean_rows(
    envelopes: DataFrame, options: dict[str, str], checkpoint: str, key: str | None = None, every: str | None = None, sink: str = "kafka"
) -> StreamingQuery:
    """Clean rows of a change stream, with table and kind of change, as messages of a topic."""
    rows = flatten_envelope(envelopes)
    return send_stream(rows, options, checkpoint, F.col(key) if key else None, every, sink)


def changes_view(spark: SparkSession, path: str, keys: list[str], order_by: list[str]) -> DataFrame:
    return latest_state(append_view(spark, path), keys, order_by)
