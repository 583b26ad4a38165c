"""One driver query per operator, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark_driver import inputs as i
from tidemark.functions import clock, device, keys, numeric, region, text
from tidemark.operators import lookup, membership, merging, ranking
from tidemark.plans import launches, logs, profile, report, sales
from tidemark.sources import cells, changes, handover, partitions, rates, records, topics
from tidemark.sources.database import camel_columns
from tidemark.streaming import eventtime, reports, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DAY = "2024-01-15"
RAW = records.text_schema("id total_amount ts", numbers=("ts",))


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: clock.clock_text(F.col(c)) for c in columns})


def _windows(df: DataFrame) -> DataFrame:
    return _texts(df, "window_start", "window_end")


# --- sales -----------------------------------------------------------------------------------------------------------


@query
def cumulative_sales(spark, sf):
    return _windows(sales.cumulative_sales(i.order_lines(spark, sf), "10 seconds"))


@query
def cumulative_sales_day(spark, sf):
    return _windows(sales.cumulative_sales(i.order_lines(spark, sf), "10 minutes", DAY))


@query
def cumulative_sales_zone(spark, sf):
    orders = i.order_lines(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    return _windows(sales.cumulative_sales(orders, "1 hour", zone="Asia/Shanghai"))


@query
def cumulative_sales_process(spark, sf):
    return _windows(sales.cumulative_process(i.order_lines(spark, sf), "10 minutes"))


@query
def sale_lines(spark, sf):
    return _texts(sales.sale_lines(i.order_lines(spark, sf), "10 minutes"), "window_start", "first_window_end", "ts")


@query
def tumble_top5(spark, sf):
    return _windows(sales.tumble_top5(i.order_lines(spark, sf), "5 minutes"))


@query
def tumble_top5_products(spark, sf):
    return _windows(sales.tumble_top5(i.order_lines(spark, sf), "4 hours", key="product_id"))


@query
def cumulative_gmv_topn(spark, sf):
    return sales.gmv_topn(i.order_lines(spark, sf), "10 minutes")


@query
def gmv_since_midnight(spark, sf):
    now = F.lit("2024-01-20 12:00:00").cast("timestamp")
    return sales.gmv_topn(clock.since_midnight(i.order_lines(spark, sf), "ts", now), "1 hour")


@query
def gmv_daily_report(spark, sf):
    daily = report.daily_report(sales.gmv_topn(i.order_lines(spark, sf), with_total=False), i.product_names(spark, sf))
    return _windows(daily)


# --- user logs -------------------------------------------------------------------------------------------------------


@query
def names_as_of(spark, sf):
    lines = i.order_lines(spark, sf).select("id", "product_id", "ts")
    named = lookup.as_of(lines, i.renamed_products(spark, sf), "product_id", "ts", "at", ["product_desc"], deleted=F.col("op") == "d", order=["n"])
    return named.select("id", "product_id", "product_desc")


@query
def stream_names_as_of(spark, sf):
    lines = i.lines_from(_event_stream(spark, sf)).select("id", "product_id", "ts")
    folder = tables.shared_folder(spark, "renamed")
    tables.write_batch(i.renamed_products(spark, sf), folder, 0)
    ended = F.col("op") == "d"
    path = _run(spark, "named", lambda t, c: reports.stream_as_of(lines, folder, t, c, "product_id", "ts", "at", ["product_desc"], ended, order=["n"]))
    return tables.append_view(spark, path).select("id", "product_id", "product_desc")


@query
def page_pv(spark, sf):
    return logs.page_pv(i.user_logs(spark, sf))


@query
def keyword_counts(spark, sf):
    return logs.keyword_counts(i.search_logs(spark, sf))


@query
def keyword_top10(spark, sf):
    return logs.keyword_top10(i.search_logs(spark, sf))


@query
def region_login(spark, sf):
    return logs.region_login(i.user_logs(spark, sf), "signup")


@query
def region_province(spark, sf):
    place = F.col("region")
    counts = i.user_logs(spark, sf).groupBy("region").agg(F.count(F.lit(1)).alias("cnt"))
    return counts.select("region", region.in_china(place).alias("in_china"), region.province(place).alias("province"), "cnt")


@query
def path_distribution(spark, sf):
    return logs.path_distribution(logs.path_counts(i.user_logs(spark, sf)))


@query
def active_users(spark, sf):
    return logs.active_users(i.user_logs(spark, sf))


@query
def path_patterns(spark, sf):
    return logs.common_paths(i.user_logs(spark, sf), ["event_id"])


@query
def path_patterns_orders(spark, sf):
    lines = i.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("user_id"),
        F.col("l_returnflag").alias("log_type"),
        F.col("l_shipdate").alias("ts"),
        "l_linenumber",
        "l_returnflag",
    )
    return logs.common_paths(lines, ["l_linenumber", "l_returnflag"], k=20)


@query
def device_stats(spark, sf):
    return logs.device_stats(i.user_logs(spark, sf))


@query
def platform_share(spark, sf):
    return logs.platform_share(logs.device_stats(i.user_logs(spark, sf)))


@query
def device_detail(spark, sf):
    return logs.device_detail(logs.device_stats(i.user_logs(spark, sf)))


@query
def stats_by_type(spark, sf):
    return logs.stats_by_type(logs.device_stats(i.user_logs(spark, sf)), "brand")


@query
def top_brands(spark, sf):
    return logs.top_stats(logs.device_stats(i.user_logs(spark, sf)), "brand", "iOS", 10)


@query
def top_models(spark, sf):
    return logs.top_stats(logs.device_stats(i.user_logs(spark, sf)), "device_model", "Android", 10)


@query
def platform_brand(spark, sf):
    rows = i.user_logs(spark, sf).select("plat", "brand", "device")
    platform = device.platform_of(F.col("plat"), F.col("brand"))
    return (
        rows.withColumn("platform", platform)
        .withColumn("maker", device.brand_of(F.col("device"), F.col("platform")))
        .groupBy("plat", "brand", "device", "platform", "maker")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


@query
def user_profile(spark, sf):
    return profile.user_profile(i.user_logs(spark, sf))


@query
def day_part_counts(spark, sf):
    part = clock.day_part(clock.wall_clock(F.col("ts")))
    return i.user_logs(spark, sf).groupBy(part.alias("day_part")).agg(F.count(F.lit(1)).alias("cnt"))


# --- new products ----------------------------------------------------------------------------------------------------


@query
def latest_partition(spark, sf):
    dated = i.user_logs(spark, sf).select("event_id", "user_id", "log_type", clock.day_text(F.col("ts")).alias("ds"))
    return partitions.latest_partition(dated)


@query
def recent_launches(spark, sf):
    rows = launches.recent_launches(i.product_info(spark, sf), i.online_history(spark, sf), i.order_info(spark, sf))
    return _texts(rows, "online_time")


@query
def all_launches(spark, sf):
    rows = launches.recent_launches(i.product_info(spark, sf), i.online_history(spark, sf), i.order_info(spark, sf), k=None)
    return _texts(rows, "online_time")


def _monitor(spark, sf, faithful):
    return launches.launch_monitor(
        i.product_info(spark, sf),
        i.online_history(spark, sf),
        i.new_tags(spark, sf),
        i.order_info(spark, sf),
        i.user_behavior(spark, sf),
        view_type="view",
        faithful=faithful,
    )


@query
def launch_monitor(spark, sf):
    return _monitor(spark, sf, False)


@query
def launch_monitor_plain_join(spark, sf):
    return _monitor(spark, sf, True)


@query
def launch_calendar(spark, sf):
    return launches.launch_calendar(i.product_info(spark, sf), i.online_history(spark, sf), i.order_info(spark, sf))


# --- ingest ----------------------------------------------------------------------------------------------------------

_ORDER_ROW = records.text_schema("o_orderkey o_custkey o_orderstatus o_totalprice", numbers=("o_orderkey", "o_custkey"))


def _envelopes(spark, sf):
    return records.parse_json(i.change_envelopes(spark, sf), changes.envelope_schema(_ORDER_ROW))


@query
def cdc_flatten(spark, sf):
    return changes.flatten_envelope(_envelopes(spark, sf))


@query
def cdc_deletes(spark, sf):
    return changes.deletes(_envelopes(spark, sf))


@query
def cdc_latest_state(spark, sf):
    return changes.latest_state(_envelopes(spark, sf), ["o_orderkey"], ["ts_ms"])


def _handed_over(spark, sf):
    """Orders loaded in chunks while they change, and the log of their changes.

    A change's position is ten times its key and its kind. Of the rows read, every other one shows its change already.
    """
    log = _envelopes(spark, sf).withColumn("position", F.coalesce("after", "before")["o_orderkey"] * 10 + F.col("ts_ms"))
    log, first = log.filter("op <> 'r'"), log.filter("op = 'r'").select("after.*")
    late = F.col("o_orderkey") % 2 == 0
    updated = F.when(late & (F.col("o_orderkey") % 5 == 0), (F.col("o_totalprice").cast("decimal(12,2)") + 1).cast("string"))
    seen = first.filter(~(late & (F.col("o_orderkey") % 7 == 0))).withColumn("o_totalprice", F.coalesce(updated, "o_totalprice"))
    chunks = handover.key_chunks(first, "o_orderkey", 8)
    marks = iter([m for low, high in chunks for m in ((low or 0) * 10, (high or 1 << 40) * 10)])
    path = tables.shared_folder(spark, "load")
    handover.fenced_load(spark, path, lambda b: seen.filter(handover.in_chunk("o_orderkey", b)), chunks, lambda: next(marks))
    return handover.loaded(spark, path), log.select("before", "after", "source", "op", "position")


@query
def cdc_handed_over(spark, sf):
    rows, log = _handed_over(spark, sf)
    both = handover.at_low_fence(rows, "shop", "oms", "orders").unionByName(log)
    return changes.latest_state(both, ["o_orderkey"], ["position"])


@query
def cdc_handed_over_in_order(spark, sf):
    rows, log = _handed_over(spark, sf)
    settled = handover.settled(rows, log, ["o_orderkey"], "shop", "oms", "orders")
    return changes.flatten_envelope(settled.unionByName(log))


@query
def read_latest(spark, sf):
    dated = i.user_logs(spark, sf).select("event_id", "user_id", "log_type", clock.day_text(F.col("ts")).alias("ds"))
    path = tables.shared_folder(spark, "dated")
    records.write_partitioned(dated, path, "ds")
    return partitions.read_latest(spark, path).withColumn("ds", F.col("ds").cast("string"))


@query
def cdc_snapshot(spark, sf):
    rows = i.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return changes.snapshot_rows(rows, "shop.oms.orders")


@query
def json_lenient(spark, sf):
    return records.parse_json(i.raw_records(spark, sf), RAW)


@query
def json_typed(spark, sf):
    read = records.variant_records(i.raw_records(spark, sf))
    return records.typed(read, RAW)


@query
def json_keep(spark, sf):
    return records.parse_json(i.raw_records(spark, sf), RAW, on_bad="keep").select("event_id", "id", "is_bad")


@query
def json_strict(spark, sf):
    return records.parse_json(i.change_envelopes(spark, sf), changes.envelope_schema(_ORDER_ROW), on_bad="fail").select(
        F.coalesce("after.o_orderkey", "before.o_orderkey").alias("o_orderkey"), "op"
    )


@query
def json_rejects(spark, sf):
    return records.rejects(i.raw_records(spark, sf), RAW)


@query
def epoch_normalise(spark, sf):
    parsed = records.parse_json(i.raw_records(spark, sf), RAW)
    return parsed.select("event_id", clock.clock_text(clock.epoch_to_ts(F.col("ts"))).alias("event_time"))


@query
def rate_feed(spark, sf):
    day = F.date_format("o_orderdate", "yyyy年MM月dd日")
    quote = F.col("o_totalprice").cast("decimal(12,2)").cast("string")

    def rate(name, code, value):
        fields = [F.lit(name).alias("ccyNbr"), F.concat(F.lit("x "), code).alias("ccyNbrEng")]
        quotes = [value.alias(n) for n in rates.QUOTES[:5]]
        return F.struct(*fields, *quotes, F.lit("09:30:00").alias("ratTim"), day.alias("ratDat"))

    key = F.col("o_orderkey").cast("string")
    body = F.array(rate("美元", F.concat(F.lit("U"), key), quote), rate("欧元", F.concat(F.lit("E"), key), key))
    return rates.rate_feed(i.table(spark, sf, "orders").select(F.to_json(F.struct(body.alias("body"))).alias("value")))


# --- columns and small tables ----------------------------------------------------------------------------------------


@query
def hash_bucket(spark, sf):
    name = F.col("c_name")
    hot = {"customer#000000001": "9001", "CUSTOMER#000000002": "9002"}
    return i.table(spark, sf, "customer").select(
        "c_custkey", keys.hash_bucket(name, 128).alias("bucket"), keys.hash_bucket(name, 128, hot).alias("bucket_hot")
    )


@query
def row_key(spark, sf):
    name, nation = F.col("c_name"), F.col("c_nationkey")
    return i.table(spark, sf, "customer").select(
        "c_custkey",
        keys.row_key((nation, False), (name, True), separator="_").alias("item_key"),
        keys.row_key((nation, False), (name, False), md5=True).alias("md5_key"),
    )


@query
def day_partitions(spark, sf):
    days = partitions.day_partitions(spark, "1995-01-01", "2001-12-31")
    per_day = i.table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("ds")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return days.join(per_day, "ds", "left").select("ds", F.coalesce("n", F.lit(0)).alias("orders"))


def _document_words(spark, sf):
    parts = F.split(F.lower("text"), r"\s+")
    return i.table(spark, sf, "documents").select("doc_id", F.explode(parts).alias("word")).filter(F.col("word") != "")


def _listed_words(spark, sf):
    return i.table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word"))


@query
def membership_flag(spark, sf):
    flagged = membership.membership(_document_words(spark, sf), _listed_words(spark, sf), "word")
    return flagged.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"), F.count(F.when(F.col("is_member"), 1)).alias("members")
    )


@query
def membership_keep(spark, sf):
    kept = membership.membership(_document_words(spark, sf), _listed_words(spark, sf), "word", "keep")
    return kept.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))


@query
def membership_drop(spark, sf):
    left = membership.membership(_document_words(spark, sf), _listed_words(spark, sf), "word", "drop")
    return left.groupBy("doc_id").agg(F.count(F.lit(1)).alias("cnt"))


@query
def membership_check(spark, sf):
    return membership.check_words(_document_words(spark, sf), _listed_words(spark, sf), "word")


@query
def text_valid(spark, sf):
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    rows = i.table(spark, sf, "documents").select("doc_id", words.alias("words")).filter(F.size("words") > 0)
    valid = F.size(F.filter("words", lambda w: text.valid_text(w))).cast("long")
    return rows.select("doc_id", valid.alias("valid"), F.size("words").cast("long").alias("words"))


def _customer_rows(spark, sf):
    return i.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"), "c_mktsegment"
    )


@query
def cells_put(spark, sf):
    return cells.cells_from_rows(_customer_rows(spark, sf), "c_custkey")


@query
def cells_roundtrip(spark, sf):
    wide = cells.cells_from_rows(_customer_rows(spark, sf), "c_custkey")
    return cells.rows_from_cells(wide, ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])


@query
def cells_scan_limit(spark, sf):
    wide = cells.cells_from_rows(_customer_rows(spark, sf), "c_custkey")
    return cells.rows_from_cells(wide, ["c_name", "c_mktsegment"], limit=20)


@query
def cells_documents(spark, sf):
    wide = cells.cells_from_rows(_customer_rows(spark, sf), "c_custkey")
    return cells.documents_from_cells(wide).select("row_key", F.to_json("document").alias("document"))


@query
def cells_get(spark, sf):
    return cells.get_row(cells.cells_from_rows(_customer_rows(spark, sf), "c_custkey"), "42")


@query
def cells_row_count(spark, sf):
    return cells.row_count(cells.cells_from_rows(_customer_rows(spark, sf), "c_custkey"))


@query
def delete_keys(spark, sf):
    closed = i.table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    left = cells.delete_keys(i.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey"), closed, "l_orderkey")
    return left.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"))


@query
def payload_words(spark, sf):
    digest = F.md5("c_name")
    data = F.concat(F.lit("0x"), F.repeat(F.concat(digest, F.md5(digest)), (F.col("c_custkey") % 4).cast("int")), F.lit("00ff"))
    return i.table(spark, sf, "customer").select("c_custkey", F.posexplode(text.payload_words(data)).alias("pos", "word"))


@query
def amount_normalise(spark, sf):
    width = (F.col("c_custkey") % 30 + 1).cast("int")
    value = F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal").cast("decimal(12,2)").cast("string")).otherwise(
        F.concat(F.lit("0x"), F.substr(F.md5("c_name"), F.lit(1), width))
    )
    return i.table(spark, sf, "customer").select(
        "c_custkey", numeric.amount(value).alias("amount"), numeric.amount(value, 18).alias("units")
    )


@query
def append_list(spark, sf):
    held = F.when(F.col("c_custkey") % 2 == 0, F.to_json(F.array("c_mktsegment", "c_name")))
    return i.table(spark, sf, "customer").select(
        "c_custkey", text.append_list(held, F.col("c_name")).alias("items"), text.append_list(held, F.col("c_name"), False).alias("shown")
    )


@query
def keyword_split(spark, sf):
    rows = i.search_logs(spark, sf).withColumn("keywords", F.concat(F.lit("\t, "), "keywords", F.lit(",，\n")))
    return rows.select("event_id", F.posexplode(text.words(F.col("keywords"))).alias("pos", "word"))


@query
def string_utils(spark, sf):
    name = F.col("p_name")
    blank = F.when(F.col("p_partkey") % 3 == 0, F.lit(" \t\n")).when(F.col("p_partkey") % 3 == 1, name)
    return i.table(spark, sf, "part").select(
        "p_partkey",
        text.upper_first(name).alias("upper_first"),
        text.lower_first(F.col("p_type")).alias("lower_first"),
        text.is_blank(blank).alias("is_blank"),
        text.is_empty(F.replace(name, name, F.lit(""))).alias("is_empty"),
        text.to_csv_text(F.split(name, " ")).alias("csv"),
        text.join_list(F.split(name, " "), "|").alias("joined"),
        text.zeros((F.col("p_size") % 5).cast("int")).alias("zeros"),
        text.clean_id(F.concat(F.lit(" "), name, F.lit("\\n\n "))).alias("clean_id"),
        text.field(F.concat(F.lit("\t"), name, F.lit("\r\n"))).alias("field"),
    )


@query
def camel_columns_rename(spark, sf):
    return camel_columns(i.table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey"))


@query
def parse_clock(spark, sf):
    stamp = F.when(F.col("event_id") % 7 == 0, F.lit("no time")).otherwise(clock.clock_text(F.col("ts")))
    return i.table(spark, sf, "events").select("event_id", clock.day_text(clock.parse_clock(stamp)).alias("day"))


# --- table merges ----------------------------------------------------------------------------------------------------


@query
def upsert_unique(spark, sf):
    rows = i.table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_orderpriority")
    split = F.lit("1998-01-01").cast("timestamp_ntz")
    old = ranking.latest_per_group(rows.filter(F.col("o_orderdate") < split), ["o_custkey"], ["o_orderdate", "o_orderkey"])
    new = rows.filter(F.col("o_orderdate") >= split)
    return _texts(merging.upsert(old, new, ["o_custkey"], ["o_orderdate", "o_orderkey"]), "o_orderdate")


@query
def merge_aggregate(spark, sf):
    rows = i.user_logs(spark, sf)
    split = F.lit(DAY).cast("timestamp_ntz")
    parts = []
    for part in (rows.filter(F.col("ts") < split), rows.filter(F.col("ts") >= split)):
        taken = F.lit(f"batch {len(parts)}")
        parts.append(logs.region_login(part, "signup").withColumn("update_time", taken))
    return merging.merge_aggregate(*parts, ["country", "province"], ["login_count"], ["update_time"], ["update_time"])


@query
def ranked_snapshot(spark, sf):
    return merging.ranked_snapshot(logs.keyword_top10(i.search_logs(spark, sf)), F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))


# --- messages, files and event time ----------------------------------------------------------------------------------


@query
def topic_texts(spark, sf):
    lines = i.raw_records(spark, sf).select("event_id", F.when(F.col("event_id") % 4 > 0, F.col("value")).cast("binary").alias("value"))
    return topics.text_values(lines).groupBy("value").agg(F.count(F.lit(1)).alias("messages"))


@query
def topic_messages(spark, sf):
    rows = i.order_lines(spark, sf).select("id", "product_id", "total_amount")
    sent = topics.to_topic_value(rows, F.col("product_id"))
    return sent.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


@query
def json_lines_roundtrip(spark, sf):
    path = tables.shared_folder(spark, "lines")
    records.write_text(i.raw_records(spark, sf).select("value"), path)
    return records.read_json_lines(spark, path, RAW)


@query
def partitioned_files(spark, sf):
    path = tables.shared_folder(spark, "orders")
    orders = i.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    records.write_partitioned(orders, path, "o_orderstatus")
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_orderstatus")


@query
def bucketed_table(spark, sf):
    name = f"customers_{uuid.uuid4().hex}"
    records.save_bucketed(i.table(spark, sf, "orders").select("o_custkey", "o_totalprice"), name, "o_custkey")
    spent = F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("decimal(38,2)")
    return spark.table(name).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), spent.alias("spent"))


@query
def truncated_folder(spark, sf):
    path = tables.shared_folder(spark, "emptied")
    i.table(spark, sf, "customer").select("c_custkey", "c_name").write.parquet(path)
    records.truncate(spark, path)
    left = spark.read.parquet(path).unionByName(i.table(spark, sf, "customer").select("c_custkey", "c_name").filter("c_custkey % 10 = 0"))
    return left.agg(F.count(F.lit(1)).alias("rows_left"), F.min("c_custkey").alias("least"))


@query
def event_times(spark, sf):
    log = i.table(spark, sf, "events").select("event_id", F.when(F.col("event_id") % 3 > 0, F.col("event_id") * 1000).cast("string").alias("first"), F.col("event_id").alias("second"))
    timed = eventtime.with_event_time(log, F.col("first"), F.when(F.col("second") % 2 == 0, F.col("second")))
    return timed.select("event_id", F.unix_millis("event_time").alias("millis"))


@query
def json_event_times(spark, sf):
    timed = eventtime.json_event_time(i.raw_records(spark, sf), "ts")
    return timed.select("event_id", F.unix_millis("event_time").alias("millis"))


# --- streams ---------------------------------------------------------------------------------------------------------


def _stream(spark, sf, name):
    schema = i.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def _event_stream(spark, sf):
    return _stream(spark, sf, "events")


def _run(spark, name, start):
    """Work off the events as a stream and return the folder of its result table, which lies beside its checkpoint."""
    folder = tables.shared_folder(spark, name)
    start(f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return f"{folder}/table"


@query
def stream_cumulative_sales(spark, sf):
    orders = i.lines_from(_event_stream(spark, sf))
    path = _run(spark, "sales", lambda t, c: reports.stream_cumulative_sales(orders, t, c, "10 minutes"))
    return _windows(reports.cumulative_sales_view(spark, path))


@query
def stream_gmv_topn(spark, sf):
    orders = i.lines_from(_event_stream(spark, sf))
    path = _run(spark, "gmv", lambda t, c: reports.stream_gmv(orders, t, c))
    return reports.gmv_view(spark, path)


@query
def stream_tumble_top5(spark, sf):
    orders = i.lines_from(_event_stream(spark, sf))
    path = _run(spark, "top5", lambda t, c: reports.stream_tumble_top5(orders, t, c))
    return _windows(reports.tumble_top5_view(spark, path))


@query
def stream_tumble_top5_zone(spark, sf):
    orders, zone = i.lines_from(_event_stream(spark, sf)), "Asia/Shanghai"
    path = _run(spark, "top5", lambda t, c: reports.stream_tumble_top5(orders, t, c, "12 hours", zone=zone))
    return _windows(reports.tumble_top5_view(spark, path))


@query
def stream_page_pv(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    path = _run(spark, "pv", lambda t, c: reports.stream_page_pv(rows, t, c))
    return reports.page_pv_view(spark, path).drop("update_time")


@query
def stream_region_login(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    path = _run(spark, "regions", lambda t, c: reports.stream_counts("regions", rows, t, c, login_type="signup"))
    return reports.counts_view(spark, "regions", path).drop("update_time")


@query
def stream_device_stats(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    path = _run(spark, "devices", lambda t, c: reports.stream_counts("devices", rows, t, c))
    return reports.counts_view(spark, "devices", path).drop("update_time")


@query
def stream_path_distribution(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    path = _run(spark, "paths", lambda t, c: reports.stream_counts("paths", rows, t, c))
    return logs.path_distribution(reports.counts_view(spark, "paths", path)).drop("update_time")


@query
def stream_user_profile(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    path = _run(spark, "profile", lambda t, c: reports.stream_user_profile(rows, t, c))
    return reports.user_profile_view(spark, path).drop("update_time")


@query
def stream_active_users(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    return reports.active_users_view(spark, _run(spark, "active", lambda t, c: reports.stream_active_users(rows, t, c)))


@query
def stream_active_users_daily(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    return reports.active_users_view(spark, _run(spark, "active", lambda t, c: reports.stream_active_users(rows, t, c, daily=True)))


@query
def stream_path_patterns(spark, sf):
    rows = i.logs_from(_event_stream(spark, sf))
    path = _run(spark, "walks", lambda t, c: reports.stream_paths(rows, t, c, ["event_id"]))
    reports.shorten_paths(spark, path)
    return reports.paths_view(spark, path, ["event_id"])


@query
def stream_keyword_top10(spark, sf):
    rows = i.searches_from(_event_stream(spark, sf), i.table(spark, sf, "part"))
    path = _run(spark, "words", lambda t, c: reports.stream_keyword_top10(rows, t, c))
    snapshots = reports.keyword_snapshots(spark, path)
    last = snapshots.filter(F.col("batch_id") == snapshots.agg(F.max("batch_id")).scalar())
    return last.select("keyword", "search_count", "ranking", "total_keywords")


@query
def stream_cdc_latest_state(spark, sf):
    texts = i.envelopes_from(_stream(spark, sf, "orders"))
    rows = records.parse_json(texts, changes.envelope_schema(_ORDER_ROW))
    path = _run(spark, "changes", lambda t, c: reports.stream_changes(rows, t, c, ["o_orderkey"], ["ts_ms"]))
    return reports.changes_view(spark, path, ["o_orderkey"], ["ts_ms"])
