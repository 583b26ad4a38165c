"""Reports on hand-made rows, and the shape of their plans."""

import datetime as dt
import functools
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from tidemark_driver.queries import QUERIES
from tests.oracle import TESTDATA
from tidemark.operators import membership, merging, paths
from tidemark.plans import launches, logs, profile, report, sales

D = dt.datetime


def orders(spark, *rows):
    return spark.createDataFrame(rows, "id string, product_id string, sale_num string, total_amount string, ts timestamp_ntz")


def test_sales_skip_empty_and_unreadable_amounts(spark):
    df = orders(
        spark,
        ("1", "p", "1", "10.00", D(2024, 1, 1, 0, 0)),
        ("2", "p", "1", "", D(2024, 1, 1, 1)),
        ("3", "p", "1", None, D(2024, 1, 1, 2)),
        ("4", "p", "1", "abc", D(2024, 1, 1, 12)),
        ("5", "p", "1", "1.239", D(2024, 1, 1, 23, 59, 59)),
        ("6", "p", "1", "7", D(2024, 1, 2, 0, 0)),
    )
    got = sales.cumulative_sales(df, "12 hours", "2024-01-01").orderBy("window_end").collect()
    assert [r.total_cumulative_amount for r in got] == [Decimal("10.00"), Decimal("11.24")]
    working = sales.cumulative_process(df, "12 hours", "2024-01-01").orderBy("window_end").collect()
    assert [r.cumulative_process for r in working] == ["1(10.00)", "1(10.00)+5(1.24)"]
    lines = sales.sale_lines(df, "12 hours").orderBy("ts").collect()
    assert [(r.id, r.first_window_end) for r in lines] == [("1", D(2024, 1, 1, 12)), ("4", D(2024, 1, 2)), ("5", D(2024, 1, 2)), ("6", D(2024, 1, 2, 12))]


def test_top5_skips_rows_without_id_or_number(spark):
    df = orders(spark, ("", "p", "5", "1", D(2024, 1, 1)), (None, "p", "5", "1", D(2024, 1, 1)), ("a", "p", "", "1", D(2024, 1, 1)), ("b", "p", "x", "1", D(2024, 1, 1)), ("c", "p", "2", "1", D(2024, 1, 1)))
    assert [r.top5_ids for r in sales.tumble_top5(df).collect()] == ["c,b,,,"]


def test_gmv_sums_the_listed_products_and_cleans_ids(spark):
    rows = [(str(n), f" p{n}\n" if n % 2 else f"p{n}\\n", "1", str(10 * n), D(2024, 1, 1, 23, 55)) for n in range(1, 8)]
    got = sales.gmv_topn(orders(spark, *rows)).collect()
    assert [(r.window_end, r.top5_product_ids, r.win_gmv, r.total_gmv) for r in got] == [
        ("2024-01-02 00:00:00", "p7,p6,p5,p4,p3", Decimal("250.00"), Decimal("280.00"))
    ]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sales.gmv_topn(orders(spark, ("1", "p", "1", "abc", D(2024, 1, 1)))).collect()


def test_daily_report(spark):
    gmv = spark.createDataFrame(
        [
            ("2024-01-01", "2024-01-01 00:00:00", "2024-01-01 10:00:00", Decimal("5.00"), "9"),
            ("2024-01-01", "2024-01-01 00:00:00", "2024-01-02 00:00:00", Decimal("0.00"), "1,2,3"),
            ("2024-01-02", "2024-01-02 00:00:00", "2024-01-03 00:00:00", Decimal("50.00"), "2,1"),
            ("2024-01-03", "2024-01-03 00:00:00", "2024-01-04 00:00:00", Decimal("60.00"), "8,3,1,1"),
        ],
        "ds string, window_start string, window_end string, win_gmv decimal(18,2), top5_product_ids string",
    )
    names = spark.createDataFrame([(1, "shirt, red"), (2, "hat"), (2, "a hat"), (3, "sock"), (4, "unused")], "product_id int, product_desc string")
    got = report.daily_report(gmv, names).orderBy("ds").collect()
    assert [r.product_topN_name for r in got] == ["shirt, red,a hat,sock", "a hat,shirt, red", "sock,shirt, red"]
    assert [r.similarity_rate for r in got] == ["0.00%", "40.00%", "20.00%"]
    assert [r.dod_rate for r in got] == [None, None, "20.00%"]


INFO = "product_id int, product_title string, product_code string, product_image string"
HISTORY = "product_id int, online_status int, online_date date, online_time timestamp_ntz"
ORDERS = "product_id int, order_id int, user_id int, payment_status int, payment_time timestamp_ntz, payment_amount decimal(18,2)"


def shop(spark, seed=3):
    rnd = random.Random(seed)
    start = D(2024, 1, 10, 8)
    info = [(p, f"t{p}", "c", "i") for p in range(8)]
    history = [(p, 1, start.date(), start + dt.timedelta(days=p)) for p in range(7)] + [(0, 1, start.date(), start), (1, 1, dt.date(2024, 3, 1), D(2024, 3, 1)), (7, 0, start.date(), start), (6, 1, None, None)]
    paid = [
        (rnd.randrange(9), rnd.randrange(60), rnd.randrange(20), rnd.randrange(2), D(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(90 * 86400)), Decimal(rnd.randrange(1, 999)) / 100)
        for _ in range(300)
    ] + [(0, 900, 1, 1, start, Decimal("1.11")), (0, 901, 1, 1, start + dt.timedelta(days=30), Decimal("2.22")), (0, 902, 1, 1, start + dt.timedelta(days=30, seconds=1), Decimal("4.44")), (0, 903, 1, 1, None, Decimal("8.88"))]
    tags = [(p, int(p % 2 == 0)) for p in range(8)] + [(0, 1), (3, 1)]
    seen = [(rnd.randrange(9), rnd.randrange(8), rnd.choice(["pv", "cart"])) for _ in range(60)]
    frames = (
        spark.createDataFrame(info, INFO),
        spark.createDataFrame(history, HISTORY),
        spark.createDataFrame(tags, "product_id int, is_tmall_new_product int"),
        spark.createDataFrame(paid, ORDERS),
        spark.createDataFrame(seen, "user_id int, product_id int, behavior_type string"),
    )
    return frames, (info, set(h for h in history if h[1] == 1 and h[3]), tags, paid, seen)


def paid_within(paid, product, online):
    return sum((o[5] for o in paid if o[0] == product and o[3] == 1 and o[4] and online <= o[4] <= online + dt.timedelta(days=30)), Decimal(0))


def test_launch_reports_equal_brute_force(spark):
    (info, history, tags, order_rows, seen), (_, launched, tag_rows, paid, seen_rows) = shop(spark)
    got = launches.recent_launches(info, history, order_rows, k=4).orderBy("rn").collect()
    newest = sorted(launched, key=lambda h: (-h[3].timestamp(), h[0]))[:4]
    assert [(r.product_id, r.online_time, r.total_payment_30d, r.rn) for r in got] == [
        (h[0], h[3], paid_within(paid, h[0], h[3]), n) for n, h in enumerate(newest, 1)
    ]
    calendar = {r.online_date: (r.new_product_count, r.total_payment_30d) for r in launches.launch_calendar(info, history, order_rows).collect()}
    assert calendar == {
        day: (len({h[0] for h in launched if h[2] == day}), sum(paid_within(paid, h[0], h[3]) for h in launched if h[2] == day))
        for day in {h[2] for h in launched}
    }
    new = {t[0] for t in tag_rows if t[1] == 1} & {h[0] for h in launched}
    viewers = {(s[0], s[1]) for s in seen_rows if s[2] == "pv" and s[1] in new}
    row = launches.launch_monitor(info, history, tags, order_rows, seen).collect()[0]
    buys = [o for o in paid if o[3] == 1 and o[0] in new]
    money = sum(paid_within(paid, h[0], h[3]) for h in launched if h[0] in new)
    assert (row.new_product_count, row.total_payment_amount) == (len(new), money)
    assert (row.total_order_count, row.total_user_count) == (len({o[1] for o in buys}), len({o[2] for o in buys}))
    assert row.conversion_rate == round(Decimal(row.total_order_count) * 100 / len({v[0] for v in viewers}), 2)
    # the plain join makes a row per tag and viewer of the product
    plain = sum(
        paid_within(paid, h[0], h[3]) * sum(1 for t in tag_rows if t == (h[0], 1)) * max(1, sum(1 for v in viewers if v[1] == h[0]))
        for h in launched
        if h[0] in new
    )
    assert launches.launch_monitor(info, history, tags, order_rows, seen, faithful=True).first().total_payment_amount == plain


def test_launch_reports_on_empty_tables(spark):
    (info, history, tags, order_rows, seen), _ = shop(spark)
    none = history.filter("product_id < 0")
    assert launches.launch_monitor(info, none, tags, order_rows, seen).count() == 0
    assert launches.launch_calendar(info, none, order_rows).count() == 0
    no_sales = launches.launch_monitor(info, history, tags, order_rows.filter("order_id < 0"), seen.filter("user_id < 0")).first()
    assert (no_sales.total_payment_amount, no_sales.conversion_rate) == (0, 0)


def test_launch_reports_read_the_latest_partition(spark):
    (info, history, _, order_rows, _), _ = shop(spark)
    old = order_rows.withColumn("ds", F.lit("20240101"))
    new = order_rows.limit(0).withColumn("ds", F.lit("20240102"))
    dated = old.unionByName(new)
    assert launches.recent_launches(info, history, dated).agg(F.sum("total_payment_30d")).first()[0] > 0
    dated = old.unionByName(order_rows.filter("order_id = 900").withColumn("ds", F.lit("20240102")))
    assert launches.recent_launches(info, history, dated).agg(F.sum("total_payment_30d")).first()[0] == Decimal("1.11")


def walk(rows, k):
    """Users per path, straight from the definition."""
    found = {}
    for user in {r[0] for r in rows}:
        steps = []
        for r in sorted((r for r in rows if r[0] == user), key=lambda r: (r[2], r[3])):
            if not steps or steps[-1] != r[1]:
                steps.append(r[1])
        if len(steps) >= 2:
            found.setdefault(tuple(steps), []).append(user)
    ranked = sorted(found.items(), key=lambda p: (-len(p[1]), len(p[0]), min(p[1])))
    return [(" → ".join(p), len(p), len(users), min(users)) for p, users in ranked[:k]]


@pytest.mark.parametrize("batch_rows", [3, 10_000])
@pytest.mark.parametrize("seed", range(3))
def test_paths_equal_brute_force_however_users_are_split(spark, batch_rows, seed):
    rnd = random.Random(seed)
    rows = []
    for n in range(400):
        user = "hot" if n % 3 == 0 else f"u{rnd.randrange(40)}"
        rows.append((user, rnd.choice("abb"), D(2024, 1, 1) + dt.timedelta(minutes=20 * rnd.randrange(60)), n))
    rows += [("second", rnd.choice("ab"), D(2024, 1, 1), 1000 + n) for n in range(300)]  # all in one second
    rows += [("same", "x", D(2024, 1, 1), 5)] * 200 + [("same", "y", D(2024, 1, 1), 6)] * 200
    df = spark.createDataFrame(rows, "user string, step string, ts timestamp_ntz, n int").repartition(4)
    settings = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(batch_rows), "spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = paths.path_patterns(df, "user", "step", "ts", ["n"], k=8)
        ranked = sorted((tuple(r) for r in got.collect()), key=lambda r: (-r[2], r[1], r[3]))
        assert ranked == walk(rows, 8)
        busy = paths.path_pieces(df.filter("user = 'second'"), "user", "step", "ts", ["n"])
        assert busy.count() >= 5  # one second of one user is cut, too
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_digests_of_pieces_join_to_the_digest_of_the_whole(spark):
    """Whatever the cuts are: the digest of a path is that of its pieces, joined in any grouping."""
    rnd = random.Random(4)
    rows = [("u", rnd.choice("ab"), D(2024, 1, 1) + dt.timedelta(seconds=n), n) for n in range(60)]
    df = spark.createDataFrame(rows, "user string, step string, ts timestamp_ntz, n int")
    whole = paths.path_pieces(df.coalesce(1), "user", "step", "ts", ["n"])
    whole = paths.user_digests(whole, "user", paths.PIECE).collect()
    for cuts in ([7], [1, 2, 3], [10, 11, 40, 59], [5, 20, 21, 22, 30, 31, 50]):
        edges = [0, *cuts, 60]
        parts = [paths.path_pieces(df.filter(F.col("n").between(a, b - 1)), "user", "step", "ts", ["n"]).withColumn("at", F.lit(a)) for a, b in zip(edges, edges[1:])]
        pieces = functools.reduce(lambda x, y: x.unionByName(y), parts)
        assert paths.user_digests(pieces, "user", "at", paths.PIECE).collect() == whole


def test_paths_scan_their_rows_twice(spark):
    text = plan(QUERIES["path_patterns"](spark, f"{TESTDATA}/sf0.001"))
    assert text.count("FileScan") <= 2 and "Window" not in text


@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("name, scans", [("cumulative_gmv_topn", 1), ("gmv_daily_report", 2), ("gmv_since_midnight", 2), ("launch_monitor", 9)])
def test_reports_read_their_facts_once(spark, adaptive, name, scans):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = QUERIES[name](spark, f"{TESTDATA}/sf0.001")
        df.collect()
        text = plan(df).split("== Initial Plan")[0]
        assert text.count("FileScan") <= scans
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_launch_costs_two_rows_at_most(spark):
    """Payments at every edge of the period are found, with spans as long as the period."""
    starts = spark.range(200).selectExpr("id AS product_id", "timestamp'1969-11-20 00:00:00' + make_dt_interval(cast(id / 2 as int), cast(id % 24 as int)) AS online_time")
    for days in (0, 1, 7, 30):
        spans = launches.launch_spans(starts, days).groupBy("product_id").count()
        assert spans.agg(F.max("count")).first()[0] <= 2 and spans.count() == 200
        offsets = [-1, 0, 1, days * 86400 - 1, days * 86400, days * 86400 + 1]
        paid = starts.select("product_id", F.explode(F.array(*map(F.lit, offsets))).alias("s"), "online_time").selectExpr(
            "product_id", "online_time + make_dt_interval(0, 0, 0, s) AS payment_time", "CAST(1 AS DECIMAL(18,2)) AS payment_amount", "1 AS payment_status"
        )
        got = launches.payments_after(paid, starts, days).collect()
        want = sum(0 <= o <= days * 86400 for o in offsets)
        assert len(got) == 200 and {int(r.paid) for r in got} == {want}


def test_reports_come_in_order(spark):
    for name, key in (("gmv_daily_report", "ds"), ("launch_calendar", "online_date")):
        text = plan(QUERIES[name](spark, f"{TESTDATA}/sf0.001"))
        assert text.index("Sort") < text.index("Aggregate"), name


def test_text_checks_need_no_shuffle(spark):
    assert "Exchange" not in plan(QUERIES["text_valid"](spark, f"{TESTDATA}/sf0.001"))


def test_common_paths_leave_out_unknown_users(spark):
    df = spark.createDataFrame(
        [(None, "a", D(2024, 1, 1), 1), ("unknown", "a", D(2024, 1, 1), 2), ("u", " a ", D(2024, 1, 1), 3), ("u", "b", D(2024, 1, 2), 4), ("v", "", D(2024, 1, 1), 5)],
        "user_id string, log_type string, ts timestamp_ntz, n int",
    )
    assert [r.path for r in logs.common_paths(df, ["n"]).collect()] == ["a → b"]
    assert logs.active_users(df).first().active_users == 1


def test_log_rows_take_both_epoch_units(spark):
    texts = ['{"user_id":"u","log_type":"view","ts":1700000000}', '{"user_id":"u","log_type":"view","ts":1700000000000}', "broken", '{"user_id":"u"}']
    rows = logs.log_rows(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert {r.ts for r in rows.filter("ts is not null").collect()} == {D(2023, 11, 14, 22, 13, 20)}
    assert [(r.page_type, r.pv_count) for r in logs.page_pv(rows).collect()] == [("view", 2)]


def test_search_words_come_as_text_or_as_a_list(spark):
    df = spark.createDataFrame([("a,b，c",), ('["a"," b ",""]',), ("[a",), (None,), ("",)], "keywords string")
    got = {r.keyword: r.search_count for r in logs.keyword_counts(df).collect()}
    assert got == {"a": 2, "b": 2, "c": 1, "[a": 1}
    ranked = logs.rank_keywords(logs.keyword_counts(df), 2).orderBy("ranking").collect()
    assert [(r.ranking, r.keyword, r.total_keywords) for r in ranked] == [(1, "a", 4), (2, "b", 4)]


def test_device_rows_without_brand_and_plat_are_left_out(spark):
    schema = "brand string, device string, plat string, platv string, softv string"
    df = spark.createDataFrame([("", "HUAWEI", " ", "1", "2"), (None, None, None, "1", None), ("其他", "huawei p", "x", "1:2", None), ("Apple", "any", "", None, "")], schema)
    got = {(r.stat_type, r.platform_type, r.stat_key): r.stat_value for r in logs.device_stats(df).collect()}
    assert got == {
        ("platform_type", "其他", "其他"): 1,
        ("device_model", "其他", "huawei p"): 1,
        ("platform_version", "其他", "1:2"): 1,
        ("platform_type", "iOS", "iOS"): 1,
        ("brand", "iOS", "Apple"): 1,
        ("device_model", "iOS", "any"): 1,
    }
    share = {r.platform_type: (r.cnt, r.share) for r in logs.platform_share(logs.device_stats(df)).collect()}
    assert share == {"iOS": (1, "50.0%"), "Android": (0, "0.0%"), "其他": (1, "50.0%")}
    assert logs.platform_share(logs.device_stats(df.limit(0))).count() == 0


def test_same_version_on_two_platforms_stays_apart(spark):
    schema = "brand string, device string, plat string, platv string, softv string"
    df = spark.createDataFrame([("Apple", "", "", "9", ""), ("OPPO", "", "", "9", "")], schema)
    got = logs.device_stats(df).filter("stat_type = 'platform_version'").collect()
    assert {(r.platform_type, r.stat_value) for r in got} == {("iOS", 1), ("Android", 1)}


def test_profile(spark):
    df = spark.createDataFrame(
        [("u", "view", D(2024, 1, 2, 7)), ("u", "search", D(2024, 1, 1, 23)), ("u", "view", D(2024, 1, 2, 13)), ("unknown", "view", D(2024, 1, 1)), (None, "view", D(2024, 1, 1)), ("w", None, D(2024, 1, 1))],
        "user_id string, log_type string, ts timestamp_ntz",
    )
    got = [tuple(r) for r in profile.user_profile(df).collect()]
    assert got == [("u", "2024-01-01,2024-01-02", 2, "12:00-18:00,22:00-6:00,6:00-12:00", "false", "true", "true", "2024-01-01", "2024-01-02")]


def test_membership(spark):
    df = spark.createDataFrame([("a",), ("b",), ("",), (None,), ("a",)], "word string")
    listed = spark.createDataFrame([("a",), ("a",), ("",), (None,)], "word string")
    flags = Counter((r.word, r.is_member) for r in membership.membership(df, listed, "word").collect())
    assert flags == {("a", True): 2, ("b", False): 1, ("", False): 1, (None, False): 1}
    assert membership.membership(df, listed, "word", "keep").count() == 2
    assert membership.membership(df, listed, "word", "drop").count() == 3
    assert {(r.word, r.is_member) for r in membership.check_words(df, listed, "word").collect()} == {("a", True), ("b", False)}


def test_upsert_is_idempotent_and_last_write_wins(spark):
    schema = "k string, v int, at int"
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 1)], schema)
    batch = spark.createDataFrame([("a", 10, 2), ("a", 11, 3), ("c", 5, 2)], schema)
    once = merging.upsert(old, batch, ["k"], ["at"])
    twice = merging.upsert(once, batch, ["k"], ["at"])
    expected = [("a", 11, 3), ("b", 2, 1), ("c", 5, 2)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected


def test_merge_aggregate_adds_and_replaces(spark):
    schema = "k string, n bigint, at string"
    got = merging.merge_aggregate(
        spark.createDataFrame([("a", 1, "1"), ("b", 2, "1")], schema), spark.createDataFrame([("a", 5, "2")], schema), ["k"], ["n"], ["at"], ["at"]
    )
    assert sorted(map(tuple, got.collect())) == [("a", 6, "2"), ("b", 2, "1")]


# --- plan shapes -----------------------------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_range_reaches_the_scan(spark):
    text = plan(driver.queries()["cumulative_sales_day"](spark, f"{TESTDATA}/sf0.001"))
    assert "GreaterThanOrEqual(ts,2024-01-15" in text and "LessThan(ts,2024-01-16" in text and "EqualTo(event_type,purchase)" in text


def test_scans_read_only_what_they_need(spark):
    text = plan(driver.queries()["page_pv"](spark, f"{TESTDATA}/sf0.001"))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_rankings_limit_before_the_shuffle(spark):
    for name in ("tumble_top5", "cumulative_gmv_topn", "path_distribution"):
        text = plan(driver.queries()[name](spark, f"{TESTDATA}/sf0.001"))
        assert "WindowGroupLimit" in text and "Partial" in text


def test_global_top_k_never_sorts_everything(spark):
    for name in ("keyword_top10", "recent_launches", "top_brands"):
        assert "TakeOrderedAndProject" in plan(driver.queries()[name](spark, f"{TESTDATA}/sf0.001"))


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_pair_joins_and_no_python_rows(spark, name):
    text = plan(driver.queries()[name](spark, f"{TESTDATA}/sf0.001"))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "InPandas" not in text
    if name != "amount_normalise":
        assert "ArrowEvalPython" not in text
