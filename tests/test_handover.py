"""An initial load that is read while its table changes: every interleaving on small tables."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from tidemark.sources import changes, folders, handover, records, topics
from tidemark.streaming import reports

ROW = "struct<case:bigint,k:bigint,v:string>"
ENVELOPE = f"before {ROW}, after {ROW}, source struct<db:string,schema:string,table:string>, op string, position bigint"


def histories():
    """Every table of one row or none and up to three changes that fit it."""
    for start in (None, "a"):
        for n in range(4):
            for kinds in itertools.product("wd", repeat=n):
                state, events, ok = start, [], True
                for at, kind in enumerate(kinds, 1):
                    if kind == "d" and state is None:
                        ok = False
                        break
                    new = None if kind == "d" else f"v{at}"
                    events.append((at, "d" if kind == "d" else "u" if state else "c", state, new))
                    state = new
                if ok:
                    yield start, events


def state_at(start, events, at):
    return next((e[3] for e in reversed(events) if e[0] <= at), start)


def cases():
    """(case, row as read or None, low, high, events, state in the end) for every time to read at and every pair of fences."""
    out = []
    for start, events in histories():
        for low in range(len(events) + 1):
            for at in range(low, len(events) + 1):
                for high in range(at, len(events) + 1):
                    out.append((len(out), state_at(start, events, at), low, high, events, state_at(start, events, len(events))))
    return out


CASES = cases()


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(n, 1, v, low, high) for n, v, low, high, _, _ in CASES if v is not None]
    loaded = spark.createDataFrame(rows, "case bigint, k bigint, v string, fence_low bigint, fence_high bigint")
    log = [
        (None if old is None else (n, 1, old), None if new is None else (n, 1, new), ("d", "s", "t"), op, at)
        for n, _, _, _, events, _ in CASES
        for at, op, old, new in events
    ]
    return loaded.cache(), spark.createDataFrame(log, ENVELOPE).cache()


def test_the_table_ends_in_the_true_state_in_any_order(tables):
    assert len(CASES) > 100
    loaded, log = tables
    both = handover.at_low_fence(loaded, "d", "s", "t").unionByName(log)
    got = {r["case"]: r["v"] for r in changes.latest_state(both, ["case", "k"], ["position"]).collect()}
    assert got == {n: v for n, _, _, _, _, v in CASES if v is not None}


def test_the_stream_loses_no_row_and_sets_none_back(tables):
    loaded, log = tables
    settled = handover.settled(loaded, log, ["case", "k"], "d", "s", "t")
    assert settled.schema.simpleString() == handover.at_low_fence(loaded, "d", "s", "t").schema.simpleString()
    sent = {r["after"]["case"]: r for r in settled.collect()}
    for n, read, low, high, events, end in CASES:
        # the log goes out in order; the chunk follows the change at its high fence
        out = [(at, 0, new) for at, _, _, new in events] + ([(sent[n]["position"], 1, sent[n]["after"]["v"])] if n in sent else [])
        state, seen = None, -1
        for at, _, value in sorted(out, key=lambda x: x[:2]):
            version = 0 if value in (None, "a") else int(value[1:])
            if value is not None:
                assert version >= seen, CASES[n]
                seen = version
            state = value
        assert state == end, CASES[n]


def test_chunks_cover_all_keys_once(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k"))
    for n in (1, 2, 7):
        chunks = handover.key_chunks(df, "k", n)
        counts = [df.filter(handover.in_chunk("k", b)).count() for b in chunks]
        assert sum(counts) == 1001 and len(chunks) == n and max(counts) < 1.2 * 1001 / n + 2
    assert handover.key_chunks(df.filter("k < 0"), "k", 4) == [(None, None)]


def test_a_load_goes_on_where_it_stopped(spark, folder):
    positions, reads = itertools.count(10, 10), []

    def read_chunk(bounds, stop=None):
        reads.append(bounds)
        if bounds[0] == stop:
            raise RuntimeError("lost")
        return spark.range(10).withColumnRenamed("id", "k").filter(handover.in_chunk("k", bounds))

    chunks = [(None, 3), (3, 6), (6, None)]
    with pytest.raises(RuntimeError):
        handover.fenced_load(spark, f"{folder}/t", lambda b: read_chunk(b, 6), chunks, lambda: next(positions))
    handover.fenced_load(spark, f"{folder}/t", read_chunk, chunks, lambda: next(positions))
    assert reads == [(None, 3), (3, 6), (6, None), (6, None)]
    rows = sorted(tuple(r) for r in handover.loaded(spark, f"{folder}/t").select("k", "fence_low", "fence_high").collect())
    assert [r[0] for r in rows] == list(range(10))
    assert {r[1:] for r in rows} == {(10, 20), (30, 40), (60, 70)}
    assert folders.listed(spark, f"{folder}/none") == []


def test_clean_rows_go_out_as_messages(spark, folder):
    def event(op, after, before=None):
        return (json.dumps({"before": before, "after": after, "source": {"db": "d", "schema": "s", "table": "t"}, "op": op, "ts_ms": 1}),)

    df = spark.createDataFrame([event("c", {"k": "1", "v": "é"}), event("d", None, {"k": "2", "v": "x"}), event("u", {"k": "3", "v": None})], "value string")
    df.coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema("value string").parquet(f"{folder}/in")
    envelopes = records.parse_json(stream, changes.envelope_schema(records.text_schema("k v")))
    for _ in range(2):  # a second run has nothing new to send
        reports.stream_clean_rows(envelopes, {"path": f"{folder}/out"}, f"{folder}/c", "k", sink="parquet").awaitTermination()
    sent = sorted((r["key"].decode(), json.loads(r["value"].decode())) for r in spark.read.parquet(f"{folder}/out").collect())
    assert sent == [("1", {"k": "1", "v": "é", "table_name": "d.s.t", "op": "c"}), ("3", {"k": "3", "table_name": "d.s.t", "op": "u"})]
    assert topics.to_topic_value(spark.range(1)).columns == ["value"]
