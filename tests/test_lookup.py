"""As-of lookups against brute force, and their stream."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import lookup
from tidemark.streaming import reports, tables
from tests.test_streaming import Feed, rows

D = dt.datetime
FACTS, CHANGES = "k string, ts timestamp, n int, _x string", "k string, at timestamp, name string, price int, op string"


def sample(seed):
    rnd = random.Random(seed)
    facts = [(rnd.choice("abcdh") if rnd.random() < 0.7 else "h", D(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(240)), n, "x") for n in range(150)]
    facts += [(None, D(2024, 1, 2), 900, "x"), ("a", None, 901, "x"), facts[0], facts[0]]
    changes, used = [], set()
    for n in range(60):
        key, at = rnd.choice("abch"), D(2024, 1, 2) + dt.timedelta(hours=rnd.randrange(200))
        if (key, at) not in used:
            used.add((key, at))
            gone = rnd.random() < 0.2
            changes.append((key, at, None if gone else f"n{n}", None if gone else n, "d" if gone else "u"))
    return facts, [*changes, changes[0], (None, D(2024, 1, 1), "no", 1, "u"), ("a", None, "no", 1, "u")]


def plain(facts, changes):
    out = []
    for k, ts, n, x in facts:
        past = [c for c in changes if k is not None and ts is not None and c[0] == k and c[1] is not None and c[1] <= ts]
        last = max(past, key=lambda c: c[1], default=None)
        out.append((k, ts, n, x, *((None, None) if last is None or last[4] == "d" else last[2:4])))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", ["1 day", "6 hours", "40 days"])
@pytest.mark.parametrize("seed", range(2))
def test_facts_meet_the_version_of_their_time(spark, bucket, seed):
    facts, changes = sample(seed)
    got = lookup.as_of(spark.createDataFrame(facts, FACTS), spark.createDataFrame(changes, CHANGES), "k", "ts", "at", ["name", "price"], bucket, F.col("op") == "d")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(facts, changes)
    none = lookup.as_of(spark.createDataFrame(facts, FACTS), spark.createDataFrame([], CHANGES), "k", "ts", "at", ["name"])
    assert none.count() == len(facts) and none.filter("name IS NOT NULL").count() == 0


def test_the_stream_of_lookups_equals_batch(spark, folder):
    facts, changes = sample(3)
    table = spark.createDataFrame(changes, CHANGES)
    feed = Feed(spark, folder, FACTS)
    for n in range(3):
        # changes land ahead of the facts; later ones do not touch what has been looked up
        day = D(2024, 1, 1) + dt.timedelta(days=4 * (n + 1))
        low = D(2023, 1, 1) if n == 0 else day - dt.timedelta(days=4)
        tables.write_batch(table.filter((F.col("at") >= F.lit(low)) & (F.col("at") < F.lit(day))), f"{folder}/dim", n)
        feed.add([f for f in facts if f[1] is not None and low <= f[1] < day])
        reports.stream_as_of(feed.stream(), f"{folder}/dim", f"{folder}/t", f"{folder}/c", "k", "ts", "at", ["name"], F.col("op") == "d").awaitTermination()
    want = lookup.as_of(feed.table(), table, "k", "ts", "at", ["name"], deleted=F.col("op") == "d")
    assert rows(tables.append_view(spark, f"{folder}/t")) == rows(want)


def test_of_changes_at_one_time_the_last_of_the_log_counts(spark, folder):
    at, late = D(2024, 1, 2), D(2024, 1, 3)
    # a first name and its change in the same moment, a change and a delete, a delete and a new beginning
    log = [("a", at, 1, "zebra", "c"), ("a", at, 2, "new zebra", "u"), ("b", at, 1, "b", "u"), ("b", at, 2, None, "d"), ("h", at, 1, None, "d"), ("h", at, 2, "h", "c")]
    changes = spark.createDataFrame(log, "k string, at timestamp, n int, name string, op string")
    facts = [(k, ts, 0, "x") for k in "abh" for ts in (at, late)]
    got = lookup.as_of(spark.createDataFrame(facts, FACTS), changes, "k", "ts", "at", ["name"], deleted=F.col("op") == "d", order=["n"])
    assert {(r["k"], r["ts"], r["name"]) for r in got.collect()} == {(k, ts, name) for k, name in (("a", "new zebra"), ("b", None), ("h", "h")) for ts in (at, late)}
    feed = Feed(spark, folder, FACTS)
    tables.write_batch(changes, f"{folder}/dim", 0)
    feed.add(facts)
    reports.stream_as_of(feed.stream(), f"{folder}/dim", f"{folder}/t", f"{folder}/c", "k", "ts", "at", ["name"], F.col("op") == "d", order=["n"]).awaitTermination()
    assert rows(tables.append_view(spark, f"{folder}/t")) == rows(got)
