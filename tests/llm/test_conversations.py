"""Conversation repair against a search over single edits, and against the table of every span and cut."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations as c
from tidemark.llm.driver import QUERIES

LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        yield from [(conv, turn, "user" if draw == 4 else role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1)


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows, found):
    """Least (cost, audit, texts) by extending one prefix of edits at a time."""
    ahead = {"": (0, "", ())}  # the last two initials written, or all of them, decide what may follow

    def write(states, role, cost, letter, text, into):
        for at, (c0, a0, t0) in states.items():
            if LEGAL.match(at + role[:1]) or any(LEGAL.match(at + role[:1] + x) for x in ("a", "ua")):
                if role[:1] not in ("s", "u", "a"):
                    continue
                new = (at + role[:1])[-1]
                new = {"s": "s", "u": "u", "a": "ua"}[new]
                cand = (c0 + cost, a0 + letter, t0 + ((role, text),))
                if new not in into or cand[:2] < into[new][:2]:
                    into[new] = cand

    def insert(states):
        for _ in range(4):
            more = dict(states)
            for role in ("user", "assistant"):
                write(states, role, 5, "I", "", more)
            states = more
        return states

    for (_, _, role, text), fault in zip(rows, found):
        ahead = insert(ahead)
        after = {k: (a + 2, b + "D", t) for k, (a, b, t) in ahead.items()}
        if fault not in ("blank", "duplicate"):
            late = 5 if fault == "truncated" else 0
            write(ahead, role, late, "K", text, after)
            for new in ("user", "assistant"):
                write(ahead, new, 1 + late, "R", text, after)
        ahead = after
    ahead = insert(ahead)
    return min((v for k, v in ahead.items() if LEGAL.match(k)), key=lambda v: v[:2])


def plain(rows):
    out = {conv: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    after = sorted(damaged(rows), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    for conv in out:
        own = [r for r in after if r[0] == conv]
        if not own:
            continue
        turns = [r[1] for r in own if r[1] is not None]
        found = faults(own)
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, texts = plain_repair(own, found)
        text = "\n".join(f"{r}:{t}" for r, t in texts)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(found.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def result(df):
    rows = df.collect()
    got = {r[0]: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


SCHEMA = "conv_id long, turn long, role string, text string, conv string, copies string, kind string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def random_rows(seed, conversations, turns):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "summary", "agent", ""]
    texts = ["Hello.", "What now?", "and then", "  \n", "", None, "Yes!", "größe.", "end. \t"]
    return [(n, t, rng.choice(roles), rng.choice(texts)) for n in range(conversations) for t in range(rng.randint(1, turns))]


def test_repair_equals_the_plain_search(spark):
    rows = random_rows(1, 60, 9)
    rows += [(None, None, "user", "Hi."), (None, 3, None, None), (None, 1, "assistant", "Oh."), (900, None, "user", "a."), (900, None, "user", "a."), (900, None, "assistant", "a.")]
    rows += [rows[5], rows[5], (901, 4, "user", "x" * 300_000 + "."), (901, 5, "assistant", "y. " * 50_000), (902, 2, "user", "tie."), (902, 2, "assistant", "tie."), (902, -3, "system", "s.")]
    assert result(c.repair(c.damage(frame(spark, rows)))) == plain(rows)


def test_one_conversation_in_many_ranges(spark):
    """Long conversations are parsed in parts by several tasks, with the same result."""
    rows = random_rows(2, 3, 40) + [(7, t, "user" if t % 2 else "assistant", f"Row {t // 3}.") for t in range(400)] + [(8, None, "user", "same.")] * 90
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        df = frame(spark, rows)
        assert result(c.repair(c.damage(df))) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_rows_and_rows_all_dropped(spark):
    dropped = next(n for n in itertools.count() if zlib.crc32(f"{n}:1".encode()) % 20 == 0)
    rows = [(dropped, 1, "user", "gone.")]
    assert result(c.repair(c.damage(frame(spark, rows)))) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert c.repair(c.damage(frame(spark, rows).filter(F.lit(False)))).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_one_cut_per_span_is_enough(seed):
    """The table of all spans with all cuts holds the cells that joining equal lengths gives."""
    rng = random.Random(seed)
    rows = [c.row_cells(rng.choice(["s", "u", "a", ""]), rng.random() < 0.2, rng.random() < 0.3) for _ in range(7)]
    spans = c.Spans()
    for cells in rows:
        spans.add(cells)
    whole = {(i, i + 1): cells for i, cells in enumerate(rows)}
    for size in range(2, len(rows) + 1):
        for i in range(len(rows) - size + 1):
            cuts = [c.join(whole[i, k], whole[k, i + size]) for k in range(i + 1, i + size)]
            whole[i, i + size] = {k: min(x[k] for x in cuts) for k in cuts[0]}
            assert all(x == cuts[0] for x in cuts)
    assert spans.all() == whole[0, len(rows)]


def test_query_over_the_given_table(spark):
    from tests.oracle import TESTDATA

    table = spark.read.parquet(f"{TESTDATA}/sf0.001/conversations.parquet")
    assert result(QUERIES["op13_conversation_repair"](spark, f"{TESTDATA}/sf0.001")) == plain([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])
