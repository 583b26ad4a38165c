"""Streams against the batch answers: several files, restarts, replays, late and out-of-order rows."""

import datetime as dt
import json
import random
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from tidemark.plans import logs, profile, sales
from tidemark.sources import changes, folders, records
from tidemark.streaming import eventtime, reports, running, tables

ORDERS = "id string, product_id string, sale_num string, total_amount string, ts timestamp"
LOGS = "user_id string, log_type string, keywords string, region string, opa string, pageinfo string, brand string, device string, plat string, platv string, softv string, ts timestamp"
DAY0 = dt.datetime(2024, 1, 1)


def order_rows(n=240, seed=5):
    rnd = random.Random(seed)
    stamps = sorted(rnd.randrange(2 * 86400) for _ in range(n))
    return [
        (str(i), f"p{rnd.randrange(9)}", str(rnd.randrange(1, 5)), f"{rnd.randrange(100, 9999) / 100:.2f}", DAY0 + dt.timedelta(seconds=s))
        for i, s in enumerate(stamps)
    ]


def log_rows(n=200, seed=6):
    rnd = random.Random(seed)
    pick = rnd.choice
    return [
        (
            f"u{rnd.randrange(12)}", pick(["login", "view", "search", "purchase"]), pick(["a,b", "b，c", "", "c"]), pick(["中国 广东", "北京市", "美国"]),
            pick(["tap", ""]), pick(["home", "cart"]), pick(["Apple", "OPPO", "其他", ""]), pick(["HUAWEI P", "Nokia"]), pick(["android", ""]), "1", "2",
            DAY0 + dt.timedelta(minutes=rnd.randrange(3 * 1440)),
        )
        for _ in range(n)
    ]


class Feed:
    """A folder that rows arrive in, one Parquet file per call."""

    def __init__(self, spark, folder, schema):
        self.spark, self.path, self.schema, self.files = spark, f"{folder}/in", schema, 0

    def add(self, rows):
        self.files += 1
        df = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        df.write.mode("append").parquet(self.path)

    def stream(self):
        schema = self.spark.read.parquet(self.path).schema
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(self.path)

    def table(self):
        return self.spark.read.parquet(self.path)


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def fill(feed, data, parts=4):
    for n in range(parts):
        feed.add(data[n * len(data) // parts : (n + 1) * len(data) // parts])


@pytest.mark.parametrize("zone", [None, "Asia/Shanghai", "Asia/Kathmandu"])
def test_cumulative_sales_stream_equals_batch_up_to_the_last_closed_window(spark, folder, zone):
    feed = Feed(spark, folder, ORDERS)
    fill(feed, order_rows())
    reports.stream_cumulative_sales(feed.stream(), f"{folder}/t", f"{folder}/c", "10 minutes", zone=zone).awaitTermination()
    got = reports.cumulative_sales_view(spark, f"{folder}/t")
    last = got.agg(F.max("window_end")).first()[0]
    batch = sales.cumulative_sales(feed.table(), "10 minutes", zone=zone)
    assert rows(got) == rows(batch.filter(F.col("window_end") <= last))
    newest = order_rows()[-1][4]
    local = newest if zone is None else newest + {"Asia/Shanghai": dt.timedelta(hours=8), "Asia/Kathmandu": dt.timedelta(hours=5, minutes=45)}[zone]
    assert last >= local - dt.timedelta(minutes=60)


def test_gmv_stream_equals_batch(spark, folder):
    feed = Feed(spark, folder, ORDERS)
    fill(feed, order_rows())
    reports.stream_gmv(feed.stream(), f"{folder}/t", f"{folder}/c").awaitTermination()
    got = reports.gmv_view(spark, f"{folder}/t")
    last = got.agg(F.max("window_end")).first()[0]
    assert got.count() > 200
    assert rows(got) == rows(sales.gmv_topn(feed.table()).filter(F.col("window_end") <= last))


@pytest.mark.parametrize("zone, window", [("UTC", "1 hour"), ("Asia/Shanghai", "1 day"), ("Asia/Kathmandu", "4 hours"), ("America/New_York", "12 hours")])
def test_top5_stream_equals_batch_for_closed_windows(spark, folder, zone, window):
    feed = Feed(spark, folder, ORDERS)
    fill(feed, order_rows())
    reports.stream_tumble_top5(feed.stream(), f"{folder}/t", f"{folder}/c", window, key="product_id", zone=zone).awaitTermination()
    got = reports.tumble_top5_view(spark, f"{folder}/t")
    mark = order_rows()[-1][4] - dt.timedelta(seconds=5)
    local = mark.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(zone)).replace(tzinfo=None)
    batch = sales.tumble_top5(feed.table(), window, key="product_id", zone=zone)
    assert rows(got) == rows(batch.filter(F.col("window_end") <= F.lit(local).cast("timestamp_ntz")))


def test_windows_without_sales_close_with_the_watermark(spark, folder):
    feed = Feed(spark, folder, ORDERS)
    first = order_rows()[0]
    day = first[4].replace(hour=0, minute=0, second=0, microsecond=0)
    for hour, minute in ((10, 10), (13, 0)):
        feed.add([(*first[:4], day + dt.timedelta(hours=hour, minutes=minute), *first[5:])])
    reports.stream_cumulative_sales(feed.stream(), f"{folder}/t", f"{folder}/c", "1 hour").awaitTermination()
    got = reports.cumulative_sales_view(spark, f"{folder}/t").collect()
    assert sorted(r["window_end"].hour for r in got) == [11, 12]


def test_restart_goes_on_where_it_stopped(spark, folder):
    feed = Feed(spark, folder, ORDERS)
    data = order_rows()
    for n in range(4):
        feed.add(data[n * 60 : (n + 1) * 60])
        reports.stream_cumulative_sales(feed.stream(), f"{folder}/t", f"{folder}/c", "10 minutes").awaitTermination()
    got = reports.cumulative_sales_view(spark, f"{folder}/t")
    last = got.agg(F.max("window_end")).first()[0]
    assert rows(got) == rows(sales.cumulative_sales(feed.table(), "10 minutes").filter(F.col("window_end") <= last))


def test_late_rows_count_within_the_watermark_and_are_dropped_beyond(spark, folder):
    def order(i, seconds):
        return (str(i), "p", "1", "1.00", DAY0 + dt.timedelta(seconds=seconds))

    feed = Feed(spark, folder, ORDERS)
    for part in ([order(1, 5), order(2, 14)], [order(3, 8)], [order(4, 100)], [order(5, 3)], [order(6, 200)]):
        feed.add(part)
        reports.stream_cumulative_sales(feed.stream(), f"{folder}/t", f"{folder}/c", "10 seconds").awaitTermination()
    closed = {10 * r.step: r.total_cumulative_amount for r in tables.append_view(spark, f"{folder}/t/sums").collect()}
    # 3 came 6 seconds late into a window that was still open, 5 after its window had closed
    assert {k: float(v) for k, v in closed.items()} == {0: 2.0, 10: 1.0, 100: 1.0}


def test_page_views_and_profiles_run_on_and_keep_the_last_value(spark, folder):
    feed = Feed(spark, folder, LOGS)
    fill(feed, log_rows())
    for name, start, view, batch in (
        ("pv", reports.stream_page_pv, reports.page_pv_view, logs.page_pv),
        ("profile", reports.stream_user_profile, reports.user_profile_view, profile.user_profile),
    ):
        start(feed.stream(), f"{folder}/{name}", f"{folder}/{name}-c").awaitTermination()
        assert rows(view(spark, f"{folder}/{name}").drop("update_time")) == rows(batch(feed.table()))
    feed.add(log_rows(40, seed=9))
    reports.stream_page_pv(feed.stream(), f"{folder}/pv", f"{folder}/pv-c").awaitTermination()
    assert rows(reports.page_pv_view(spark, f"{folder}/pv").drop("update_time")) == rows(logs.page_pv(feed.table()))


@pytest.mark.parametrize(
    "kind, batch",
    [("keywords", logs.keyword_counts), ("regions", logs.region_login), ("paths", logs.path_counts), ("devices", logs.device_stats)],
)
def test_counts_add_up_over_batches(spark, folder, kind, batch):
    feed = Feed(spark, folder, LOGS)
    fill(feed, log_rows())
    reports.stream_counts(kind, feed.stream(), f"{folder}/t", f"{folder}/c").awaitTermination()
    got = reports.counts_view(spark, kind, f"{folder}/t")
    assert got.filter(F.col("update_time").isNull()).count() == 0
    assert rows(got.drop("update_time")) == rows(batch(feed.table()))


def test_keyword_rankings_are_appended_per_batch(spark, folder):
    feed = Feed(spark, folder, LOGS)
    data = log_rows()
    for n in range(3):
        feed.add([(*r[:2], f"{r[2]},w{(7 * i + n) % 23}" if n < 2 else r[2], *r[3:]) for i, r in enumerate(data[n * 60 : (n + 1) * 60])])
        reports.stream_keyword_top10(feed.stream(), f"{folder}/t", f"{folder}/c", 3).awaitTermination()
        got = reports.keyword_snapshots(spark, f"{folder}/t").filter(F.col("batch_id") == n)
        assert rows(got.drop("batch_id", "update_time")) == rows(logs.keyword_top10(feed.table(), k=3))
    assert reports.keyword_snapshots(spark, f"{folder}/t").count() == 9
    # a batch stores the words it has touched, not all words
    touched = {r["batch_id"]: r["count"] for r in tables.read_batches(spark, f"{folder}/t/words").groupBy("batch_id").count().collect()}
    assert touched[2] <= 3 < touched[0]
    totals = tables.unique_view(spark, f"{folder}/t/words", ["keyword"]).drop("is_new")
    assert rows(totals) == rows(logs.keyword_counts(feed.table()))


def test_replayed_rankings_stay_as_they_were(spark, folder):
    feed = Feed(spark, folder, LOGS)
    for n in range(2):
        feed.add(log_rows(40, seed=n))
        reports.stream_keyword_top10(feed.stream(), f"{folder}/t", f"{folder}/c").awaitTermination()
    before = rows(reports.keyword_snapshots(spark, f"{folder}/t").drop("update_time"))
    for name in ("1", ".1.crc"):
        folders.delete(spark, f"{folder}/c/commits/{name}")
    reports.stream_keyword_top10(feed.stream(), f"{folder}/t", f"{folder}/c").awaitTermination()
    assert rows(reports.keyword_snapshots(spark, f"{folder}/t").drop("update_time")) == before


def test_active_users_run_on_as_exact_distinct_counts(spark, folder):
    feed = Feed(spark, folder, LOGS)
    data = log_rows() + [(None, *log_rows()[0][1:]), ("unknown", *log_rows()[1][1:])]
    for n in range(3):
        feed.add(data[n * 70 : (n + 1) * 70])
        for daily in (False, True):
            reports.stream_active_users(feed.stream(), f"{folder}/{daily}", f"{folder}/{daily}-c", daily).awaitTermination()
        assert rows(reports.active_users_view(spark, f"{folder}/False")) == rows(logs.active_users(feed.table()))
        days = logs.named(feed.table()).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("stat_date")).agg(F.count_distinct("user_id").alias("active_users"))
        assert rows(reports.active_users_view(spark, f"{folder}/True")) == rows(days)


def test_common_paths_run_on_from_slice_to_slice(spark, folder):
    """Rows out of order within a slice, merges in the middle and a replay give the paths of the closed part; late rows are left out."""
    feed = Feed(spark, folder, LOGS)
    data = sorted(log_rows(300), key=lambda r: r[-1])
    rnd = random.Random(1)
    data = [(f"u{n % 12}", "abc"[(n // 12 + (n % 4) * (n > 250)) % 3] if n % 5 else rnd.choice("ab"), *r[2:]) for n, r in enumerate(data)]
    path, checkpoint = f"{folder}/t", f"{folder}/c"

    def begin():
        reports.stream_paths(feed.stream(), path, checkpoint, ["opa", "pageinfo"], "6 hours").awaitTermination()

    for n in range(5):
        part = data[n * 60 : (n + 1) * 60]
        rnd.shuffle(part)
        feed.add(part)
        begin()
        if n == 2:
            before = rows(reports.paths_view(spark, path, ["opa", "pageinfo"], 12))
            reports.shorten_paths(spark, path)
            assert rows(reports.paths_view(spark, path, ["opa", "pageinfo"], 12)) == before and before
    ended = F.timestamp_seconds(F.lit(reports.closed_slices(spark, path) * 6 * 3600))
    want = rows(logs.common_paths(feed.table().filter(F.col("ts") < ended), ["opa", "pageinfo"], k=12))
    assert rows(reports.paths_view(spark, path, ["opa", "pageinfo"], 12)) == want and len(want) > 2
    for name in ("4", ".4.crc"):
        folders.delete(spark, f"{checkpoint}/commits/{name}")
    begin()
    feed.add([("u1", "zz", *data[0][2:])])  # its slice was closed long ago
    begin()
    assert rows(reports.paths_view(spark, path, ["opa", "pageinfo"], 12)) == want


def test_profiles_keep_one_row_per_user_and_month(spark, folder):
    feed = Feed(spark, folder, LOGS)
    feed.add([("u", "view", "", "", "", "", "", "", "", "", "", dt.datetime(2024, 1 + n % 2, 1 + n % 28, n % 24)) for n in range(500)])
    reports.stream_user_profile(feed.stream(), f"{folder}/t", f"{folder}/c").awaitTermination()
    assert tables.append_view(spark, f"{folder}/t").count() == 2
    assert rows(reports.user_profile_view(spark, f"{folder}/t").drop("update_time")) == rows(profile.user_profile(feed.table()))


def test_counting_plans_also_run_as_stateful_streams(spark, folder):
    feed = Feed(spark, folder, LOGS)
    fill(feed, log_rows())
    for name, plan, keys in (
        ("regions", logs.region_login, ["country", "province"]),
        ("devices", logs.device_stats, ["stat_type", "platform_type", "stat_key"]),
        ("paths", logs.path_counts, ["stat_type", "stat_key"]),
    ):
        sink = tables.batch_sink(f"{folder}/{name}")
        tables.start(plan(feed.stream()), sink, f"{folder}/{name}-c", "update").awaitTermination()
        assert rows(tables.unique_view(spark, f"{folder}/{name}", keys)) == rows(plan(feed.table()))


def test_a_replayed_batch_changes_nothing(spark, folder):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n bigint")
    sink = tables.batch_sink(f"{folder}/t")
    sink(df, 0)
    sink(df.withColumn("n", F.col("n") + 1), 1)
    before = rows(tables.aggregate_view(spark, f"{folder}/t", ["k"], ["n"]))
    sink(df.withColumn("n", F.col("n") + 1), 1)
    sink(df, 0)
    assert rows(tables.aggregate_view(spark, f"{folder}/t", ["k"], ["n"])) == before == [("a", 3), ("b", 5)]
    assert rows(tables.unique_view(spark, f"{folder}/t", ["k"])) == [("a", 2), ("b", 3)]


def test_a_long_table_goes_on_in_a_new_folder(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, n bigint")
    for batch in range(3):
        tables.write_batch(df, f"{folder}/old", batch)
    tables.write_batch(tables.aggregate_view(spark, f"{folder}/old", ["k"], ["n"]), f"{folder}/new", 2)
    tables.write_batch(df, f"{folder}/new", 3)
    assert rows(tables.aggregate_view(spark, f"{folder}/new", ["k"], ["n"])) == [("a", 4)]


def test_changes_settle_whatever_batch_they_came_in(spark, folder):
    def text(op, value, at):
        row = {"k": "1", "v": value}
        return (json.dumps({"before": row if op == "d" else None, "after": None if op == "d" else row, "source": {"db": "d", "schema": "s", "table": "t"}, "op": op, "ts_ms": at}),)

    feed = Feed(spark, folder, "value string")
    for change in (text("u", "new", 4), text("d", "old", 3), text("r", "old", 1)):
        feed.add([change])
    parsed = records.parse_json(feed.stream(), changes.envelope_schema(records.text_schema("k v")))
    reports.stream_changes(parsed, f"{folder}/t", f"{folder}/c", ["k"], ["ts_ms"]).awaitTermination()
    assert [r.v for r in reports.changes_view(spark, f"{folder}/t", ["k"], ["ts_ms"]).collect()] == ["new"]
    flat = changes.flatten_envelope(parsed)
    tables.start(flat, tables.batch_sink(f"{folder}/flat"), f"{folder}/flat-c").awaitTermination()
    assert sorted(r.v for r in tables.append_view(spark, f"{folder}/flat").collect()) == ["new", "old"]


def test_a_snapshot_precedes_the_change_stream(spark, folder):
    rows_ = spark.createDataFrame([("1", "old"), ("2", "kept")], "k string, v string")
    tables.write_batch(changes.snapshot_envelopes(rows_, "d", "s", "t"), f"{folder}/t", -1)
    feed = Feed(spark, folder, "value string")
    feed.add([(json.dumps({"after": {"k": "1", "v": "new"}, "source": {"db": "d", "schema": "s", "table": "t"}, "op": "u", "ts_ms": 5}),)])
    parsed = records.parse_json(feed.stream(), changes.envelope_schema(records.text_schema("k v")))
    reports.stream_changes(parsed, f"{folder}/t", f"{folder}/c", ["k"], ["ts_ms"]).awaitTermination()
    assert rows(reports.changes_view(spark, f"{folder}/t", ["k"], ["ts_ms"])) == [("1", "u", "new"), ("2", "r", "kept")]


def test_json_stream_to_report(spark, folder):
    feed = Feed(spark, folder, "value string")
    feed.add([('{"user_id":"u","log_type":"view","ts":1700000000}',), ("broken",)])
    feed.add([('{"user_id":"u","log_type":"view","ts":1700000000000}',)])
    reports.stream_page_pv(logs.log_rows(feed.stream()), f"{folder}/t", f"{folder}/c").awaitTermination()
    assert rows(reports.page_pv_view(spark, f"{folder}/t").drop("update_time")) == [("view", 2, "2023-11-14")]


def test_event_time_from_fields(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (None, None)], "block_timestamp bigint, timestamp bigint")
    got = eventtime.with_event_time(df, F.col("block_timestamp"), F.col("timestamp"), unit="s")
    assert [r[0] for r in got.select(F.unix_millis("event_time")).collect()] == [1000, 2000, 0]
    texts = spark.createDataFrame([('{"at":5}',), ('{"at":"x"}',), ("broken",), (None,)], "value string")
    assert [r[0] for r in eventtime.json_event_time(texts, "at").select(F.unix_millis("event_time")).collect()] == [5, 0, 0, 0]
    lists = spark.createDataFrame([([(7,), (9,)],), ([],)], "col array<struct<window_start_time:bigint>>")
    assert [r[0] for r in eventtime.batch_event_time(lists, "col").select(F.unix_millis("event_time")).collect()] == [7, 0]


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = tables.shared_folder(spark, "x"), tables.shared_folder(spark, "x")
    assert one.startswith(root.rstrip("/")) and one != two


STREAMS = {
    "sales": (lambda o, t, c, z: reports.stream_cumulative_sales(o, t, c, "10 minutes", zone=z), lambda o, z: sales.cumulative_sales(o, "10 minutes", zone=z), ["step"], ["total_cumulative_amount"]),
    "gmv": (lambda o, t, c, z: reports.stream_gmv(o, t, c, zone=z), lambda o, z: sales.gmv_topn(o, zone=z), ["step", "clean_product_id"], ["product_gmv"]),
    "top5": (lambda o, t, c, z: reports.stream_tumble_top5(o, t, c, "4 hours", key="product_id", zone=z), lambda o, z: sales.tumble_top5(o, "4 hours", key="product_id", zone=z), ["window_start", "window_end", "product_id"], ["total"]),
}


def closed_part(spark, batch, checkpoint, zone):
    """The rows of a batch report whose windows the stream has closed."""
    mark = tables.closed_until(spark, checkpoint)
    end = F.col("window_end").cast("timestamp_ntz")
    return batch.filter(end <= (mark.cast("timestamp_ntz") if zone is None else F.convert_timezone(None, F.lit(zone), mark.cast("timestamp_ntz"))))


@pytest.mark.parametrize("zone", [None, "Asia/Shanghai"])
@pytest.mark.parametrize("kind", STREAMS)
def test_windows_are_written_once_and_equal_batch(spark, folder, kind, zone):
    """Restarts, a merge in the middle of the stream and a replayed batch leave each window once, with the rows of the batch report."""
    begin, batch, keys, sums = STREAMS[kind]
    feed = Feed(spark, folder, ORDERS)
    data, path, checkpoint = order_rows(), f"{folder}/t", f"{folder}/c"
    for n in range(4):
        feed.add(data[n * 60 : (n + 1) * 60])
        begin(feed.stream(), path, checkpoint, zone).awaitTermination()
        if n == 1:
            before = rows(running.windows_view(spark, path))
            running.shorten(spark, path, sums, keys)
            assert rows(running.windows_view(spark, path)) == before
            assert tables.vacuum(spark, f"{path}/windows") and tables.vacuum(spark, f"{path}/sums")
    got = running.windows_view(spark, path)
    want = rows(closed_part(spark, batch(feed.table(), zone), checkpoint, zone))
    assert rows(got) == want and len(want) > 5
    last = max(int(n) for n in folders.listed(spark, f"{checkpoint}/commits") if n.isdigit())
    replay = tables.read_batch(spark, f"{path}/windows", last)
    stored = rows(replay)
    folders.delete(spark, f"{checkpoint}/commits/{last}")
    folders.delete(spark, f"{checkpoint}/commits/.{last}.crc")
    begin(feed.stream(), path, checkpoint, zone).awaitTermination()
    assert rows(tables.read_batch(spark, f"{path}/windows", last)) == stored
    assert rows(running.windows_view(spark, path)) == want


def test_a_view_of_one_day_reads_one_folder(spark, folder):
    feed = Feed(spark, folder, ORDERS)
    fill(feed, order_rows())
    reports.stream_gmv(feed.stream(), f"{folder}/t", f"{folder}/c").awaitTermination()
    for merged in (False, True):
        if merged:
            running.shorten(spark, f"{folder}/t", ["product_gmv"], ["step", "clean_product_id"])
        day = reports.gmv_view(spark, f"{folder}/t", "2024-01-02")
        assert rows(day) == rows(reports.gmv_view(spark, f"{folder}/t").filter("ds = DATE'2024-01-02'"))
        assert {p.split("day=")[1][:10] for p in read_files(day)} == {"2024-01-02"}
        plan = day._jdf.queryExecution().simpleString()
        assert plan.count("FileScan") == plan.count("PartitionFilters: [isnotnull(day") > 0


def read_files(df):
    """The files that rows come from."""
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_a_day_with_an_hour_twice(spark, folder):
    """Clocks go back at 2:00: windows of the hour that comes again are closed after its second time."""
    zone, at = "America/New_York", dt.datetime(2024, 11, 3, 4, 30)
    data = [(str(n), "p", "1", "1.00", at + dt.timedelta(minutes=7 * n)) for n in range(60)]
    feed = Feed(spark, folder, ORDERS)
    for n in range(0, 60, 5):
        feed.add(data[n : n + 5])
        reports.stream_cumulative_sales(feed.stream(), f"{folder}/t", f"{folder}/c", "10 minutes", zone=zone).awaitTermination()
    got = reports.cumulative_sales_view(spark, f"{folder}/t")
    last = got.agg(F.max("window_end")).first()[0]
    batch = sales.cumulative_sales(feed.table(), "10 minutes", zone=zone)
    assert rows(got) == rows(batch.filter(F.col("window_end") <= last)) and last.hour >= 5


def test_merges_by_each_rule_while_batches_come(spark, folder):
    df = spark.createDataFrame([("a", "2024-01-01", 1), ("b", "2024-01-02", 2)], "k string, d string, n bigint").withColumn("d", F.col("d").cast("date"))
    views = {
        "unique": (tables.unique(["k"]), lambda p: tables.unique_view(spark, p, ["k"])),
        "aggregate": (tables.aggregate(["k", "d"], ["n"]), lambda p: tables.aggregate_view(spark, p, ["k", "d"], ["n"])),
        "append": (tables.append, lambda p: tables.append_view(spark, p)),
    }
    for by in (None, "d"):
        for name, (rule, view) in views.items():
            path, plain = f"{folder}/{name}-{by}", f"{folder}/{name}-{by}-plain"
            assert not tables.compact(spark, path, rule)
            for n in range(5):
                rows_ = df.withColumn("n", F.col("n") + n).filter(F.col("k") == "a" if n == 3 else F.lit(n != 4))
                for p in (path, plain):
                    tables.write_batch(rows_, p, n, by)
                if n in (1, 3):
                    assert tables.compact(spark, path, rule) and not tables.compact(spark, path, rule)
                    tables.write_batch(rows_, path, n, by)  # a batch that is merged already comes again
                assert rows(view(path)) == rows(view(plain))
            gone = tables.vacuum(spark, path)
            assert any(g.startswith("batch_id=") for g in gone) and any(g.startswith("generation=") for g in gone)
            assert rows(view(path)) == rows(view(plain)) and not tables.vacuum(spark, path)


def test_days_without_new_batches_keep_their_generation(spark, folder):
    day = spark.createDataFrame([("a", 1)], "k string, n bigint")
    for n in range(3):
        tables.write_batch(day.withColumn("d", F.lit(f"2024-01-0{n + 1}").cast("date")), f"{folder}/t", n, "d")
    tables.compact(spark, f"{folder}/t", tables.append)
    first = tables.live(spark, f"{folder}/t").parts
    tables.write_batch(day.withColumn("d", F.lit("2024-01-03").cast("date")), f"{folder}/t", 3, "d")
    tables.compact(spark, f"{folder}/t", tables.append)
    second = tables.live(spark, f"{folder}/t").parts
    assert {k for k in first if first[k] != second[k]} == {"d=2024-01-03"}


def test_of_two_merges_one_succeeds(spark, folder, monkeypatch):
    df = spark.createDataFrame([("a", 1)], "k string, n bigint")
    tables.write_batch(df, f"{folder}/t", 0)

    def late(rows_):
        monkeypatch.undo()
        tables.compact(spark, f"{folder}/t", tables.append)
        return rows_

    with pytest.raises(RuntimeError, match="another writer"):
        tables.compact(spark, f"{folder}/t", late)
    assert rows(tables.append_view(spark, f"{folder}/t")) == [("a", 1)]


def test_a_list_that_is_being_written_is_not_used(spark, folder):
    df = spark.createDataFrame([("a", 1)], "k string, n bigint")
    tables.write_batch(df, f"{folder}/t", 0)
    tables.compact(spark, f"{folder}/t", tables.append)
    folders.create(spark, f"{folder}/t/_live/000000000002", '{"through": 0, "pa')
    assert tables.live(spark, f"{folder}/t").number == 1
    assert rows(tables.append_view(spark, f"{folder}/t")) == [("a", 1)]
