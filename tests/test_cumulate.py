"""Cumulative windows and rankings against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cumulate as c
from tidemark.operators import ranking

DAY0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, key string, amount int"


def sales(n, days=2, keys=6, low=-50, seed=1):
    rnd = random.Random(seed)
    rows = [(DAY0 + dt.timedelta(seconds=rnd.randrange(days * 86400)), f"k{rnd.randrange(keys)}", rnd.randrange(low, 100)) for _ in range(n)]
    # step edges, midnight, the last second of a day
    return rows + [(DAY0 + dt.timedelta(seconds=s), "edge", 5) for s in (0, 3599, 3600, 7200, 86399, 86400, 172799)]


def windows(rows, step):
    """Every window that holds a row, with its rows: straight from the definition."""
    for day in sorted({r[0].date() for r in rows}):
        start = dt.datetime.combine(day, dt.time())
        mine = [r for r in rows if r[0].date() == day]
        for end in range(step, 86400 + 1, step):
            inside = [r for r in mine if r[0] < start + dt.timedelta(seconds=end)]
            if inside:
                yield start, start + dt.timedelta(seconds=end), inside


@pytest.mark.parametrize("step", [600, 3600, 7200, 43200, 86400])
def test_cumulate_equals_the_definition(spark, step):
    rows = sales(120)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.window_start, r.window_end): r.total for r in c.cumulate(df, "ts", step, {"total": F.col("amount")}).collect()}
    assert got == {(s, e): sum(r[2] for r in inside) for s, e, inside in windows(rows, step)}


def test_keyed_cumulate_starts_with_the_key(spark):
    rows = sales(60)
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.window_end, r.key): r.total for r in c.cumulate(df, "ts", "1 hour", {"total": F.col("amount")}, ["key"]).collect()}
    expected = {}
    for _, end, inside in windows(rows, 3600):
        for r in inside:
            expected[end, r[1]] = expected.get((end, r[1]), 0) + r[2]
    assert got == expected


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("step", [900, 5400, 86400])
def test_cumulative_top_equals_ranking_every_window(spark, seed, step):
    rows = sales(150, keys=12, seed=seed)
    partials = c.step_partials(spark.createDataFrame(rows, SCHEMA), "ts", step, {"total": F.col("amount")}, ["key"])
    top = c.with_bounds(c.cumulate_top(partials, step, "key", "total", 3), step)
    got = {(r.window_start, r.window_end, r.rank_num): (r.key, r.total) for r in top.collect()}
    expected = {}
    for start, end, inside in windows(rows, step):
        sums = {}
        for _, key, amount in inside:
            sums[key] = sums.get(key, 0) + amount
        for rank, (key, total) in enumerate(sorted(sums.items(), key=lambda s: (-s[1], s[0]))[:3], 1):
            expected[start, end, rank] = (key, total)
    assert got == expected


def test_blocks_tile_every_span(spark):
    n = 24
    spans = [(a, b) for a in range(n) for b in range(a + 1, n + 1)]
    df = spark.createDataFrame([(a, b, a, b) for a, b in spans], "first int, after int, _step int, _until int")
    cut = c._with_blocks(df, n)
    steps = cut.withColumn("step", F.explode(c._block_steps("_block", n))).groupBy("first", "after").agg(
        F.sort_array(F.collect_list("step")).alias("steps"), F.count_distinct("_block").alias("blocks")
    )
    found = steps.collect()
    assert len(found) == len(spans)
    for row in found:
        assert row.steps == list(range(row.first, row.after)) and row.blocks <= 2 * n.bit_length()


def test_cumulate_needs_whole_steps(spark):
    with pytest.raises(ValueError):
        c.cumulate(spark.createDataFrame([], SCHEMA), "ts", "7 seconds", {"x": F.col("amount")})


def test_unreadable_amounts_keep_their_window_without_a_sum(spark):
    df = spark.createDataFrame([(DAY0, None), (DAY0 + dt.timedelta(hours=12), 4)], "ts timestamp_ntz, amount int")
    got = [r.total for r in c.cumulate(df, "ts", 43200, {"total": F.col("amount")}).orderBy("window_end").collect()]
    assert got == [None, 4]


def test_days_are_local(spark):
    stamps = [dt.datetime(2024, 1, 1, 15, 59), dt.datetime(2024, 1, 1, 16, 0)]
    df = spark.createDataFrame([(s, 1) for s in stamps], "ts timestamp, amount int")
    got = c.cumulate(df, "ts", "1 day", {"n": F.col("amount")}, zone="Asia/Shanghai").orderBy("window_start").collect()
    assert [(r.window_start, r.n) for r in got] == [(dt.datetime(2024, 1, 1), 1), (dt.datetime(2024, 1, 2), 1)]


def test_monotone_and_day_total(spark):
    rows = sales(200, low=0)
    result = c.cumulate(spark.createDataFrame(rows, SCHEMA), "ts", 600, {"total": F.col("amount")}).orderBy("window_end").collect()
    for day in {r.window_start for r in result}:
        sums = [r.total for r in result if r.window_start == day]
        assert sums == sorted(sums)
        assert sums[-1] == sum(r[2] for r in rows if dt.datetime.combine(r[0].date(), dt.time()) == day)


def test_top_per_window_pads_and_breaks_ties_by_key(spark):
    rows = [(DAY0, "b", 3), (DAY0, "a", 3), (DAY0, "c", 9), (DAY0 + dt.timedelta(minutes=5), "z", 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.window_start: r.top_keys for r in ranking.top_per_window(df, "ts", "5 minutes", "key", F.col("amount")).collect()}
    assert got == {DAY0: "c,a,b,,", DAY0 + dt.timedelta(minutes=5): "z,,,,"}


def test_latest_per_group(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, None)], "k string, at int, v string")
    assert sorted(tuple(r) for r in ranking.latest_per_group(df, ["k"], ["at"]).collect()) == [("a", 3, "y"), ("b", 1, None)]
