"""Repeated windows of words against brute force, and the index against plain counting."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_rows, prose
from tests.oracle import TESTDATA
from tidemark.llm import substrings as s
from tidemark.llm.fm_index import Bits, FMIndex, WaveletTree


def plain(rows):
    """Per (id, text): words, removed words and the kept text."""
    keys = {(-(1 << 63) if i is None else i, hashlib.md5((t or "").encode()).digest()): re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t, *_ in rows}
    first = {}
    for key in sorted(keys):
        w = keys[key]
        for a in range(len(w) - s.LENGTH + 1):
            first.setdefault(tuple(w[a : a + s.LENGTH]), (key, a))
    out = {}
    for key, w in keys.items():
        gone = set()
        for a in range(len(w) - s.LENGTH + 1):
            if first[tuple(w[a : a + s.LENGTH])] != (key, a):
                gone |= set(range(a, a + s.LENGTH))
        out[key] = (len(w), len(gone), " ".join(x for n, x in enumerate(w) if n not in gone))
    return Counter((i, *out[-(1 << 63) if i is None else i, hashlib.md5((t or "").encode()).digest()]) for i, t, *_ in rows)


def result(df):
    return Counter((r["doc_id"], *r["cleaned"]) for r in df.collect())


def repeats(seed, n):
    """Passages of 15 to 60 words that many rows share in changing surroundings."""
    rng = random.Random(seed)
    passages = [prose(1000 + k, rng.randint(15, 60)) for k in range(6)]
    out = []
    for i in range(n):
        parts = [prose(rng.randint(0, 10_000), rng.randint(0, 30)) if rng.random() < 0.5 else rng.choice(passages) for _ in range(rng.randint(1, 5))]
        out.append((rng.choice([i, i, i, None]), rng.choice([" ", "\n", " \t "]).join(parts)))
    return out


CASES = odd_rows() + [(20, prose(5, 6000)), (21, "same word " * 40), (22, "x " * 19), (23, "x " * 20), (24, "x " * 21), (25, ""), (26, ""), (25, prose(3, 80)), (None, prose(3, 80))]


@pytest.mark.parametrize("hot", [10**6, 1])
def test_removal_equals_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(s, "HOT", hot)
    monkeypatch.setattr(s, "SHARD_WORDS", 500)
    rows = CASES + repeats(1, 120)
    names = ("words", "begin", "text_print", "stretch_begins", "doc_key", "bits", "hot")
    df = documents(spark, [(*r, "en", "s")[:4] for r in rows]).selectExpr("*", *(f"'x' AS {n}" for n in names))
    assert result(s.remove(df)) == plain(rows)


def test_ten_thousand_rows_without_an_id(spark):
    rows = [(None, f"{prose(n % 7, 30)} {n % 50}") for n in range(10_000)]
    assert result(s.remove(documents(spark, rows))) == plain(rows)


def test_empty_table(spark):
    assert s.remove(documents(spark, [(1, "a")]).filter(F.lit(False))).count() == 0
    assert result(s.remove(documents(spark, [(1, None), (2, "a b")]))) == Counter({(1, 0, 0, ""): 1, (2, 2, 0, "a b"): 1})


def test_query_equals_brute_force(spark):
    got = {tuple(r) for r in s.op11_substring_dedup(spark, f"{TESTDATA}/sf0.001").collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert got == {(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in plain(rows)}


def test_stretches_do_not_depend_on_what_is_read_with_them():
    texts = [t.encode() for _, t in repeats(3, 40)] + [b"", b"a b", b"same word " * 30]
    together = s.Stretches(texts)
    rows = list(zip(together.text.tolist(), together.anchor.tolist(), (together.first - together.begins[together.text]).tolist(), together.words()))
    apart = []
    for n, text in enumerate(texts):
        one = s.Stretches([text])
        apart += [(n, a, f, w) for a, f, w in zip(one.anchor.tolist(), one.first.tolist(), one.words())]
    assert rows == apart and len(rows) > 40


@pytest.mark.parametrize("seed", range(6))
def test_ranks_and_matching_statistics(seed):
    rng = np.random.default_rng(seed)
    sequence = np.minimum(rng.geometric(0.3, 700) - 1, 40 if seed else 0)
    symbols = int(sequence.max()) + 3
    tree = WaveletTree(sequence, symbols)
    symbol, place = rng.integers(0, symbols - 2, 300), rng.integers(0, 701, 300)
    assert tree.rank(symbol, place).tolist() == [int((sequence[:p] == c).sum()) for c, p in zip(symbol, place)]
    bits = rng.integers(0, 2, 200)
    assert Bits(bits).ones(np.arange(201)).tolist() == [int(bits[:k].sum()) for k in range(201)]

    text = sequence.copy() + 1
    text[50::60] = 0
    text[-1] = 0
    index = FMIndex(text, 6)
    ends = np.flatnonzero(text > 0) + 1
    length, low, high = index.matching_statistics(ends, 5)
    values = rng.permutation(len(text))
    some = np.flatnonzero(length == 5)
    least = dict(zip(some.tolist(), index.least(values, low[some], high[some]).tolist()))
    for n, end in enumerate(ends.tolist()):
        want, places = 0, []
        for size in range(1, 6):
            pattern = text[end - size : end].tolist()
            if end - size < 0 or 0 in pattern:
                break
            found = [a for a in range(len(text) - size + 1) if text[a : a + size].tolist() == pattern]
            if len(found) < 2:
                break
            want, places = size, found
        assert length[n] == want
        if want:
            assert sorted(index.order[low[n] : high[n]].tolist()) == places
        if want == 5:
            assert least[n] == min(values[places])


def test_the_tree_is_compressed():
    """Frequent words lie near the root: the vectors have at most a bit a word more than the entropy."""
    sequence = np.minimum(np.random.default_rng(1).geometric(0.5, 20_000) - 1, 200)
    share = np.bincount(sequence) / len(sequence)
    entropy = -(share[share > 0] * np.log2(share[share > 0])).sum()
    tree = WaveletTree(sequence, int(sequence.max()) + 1)
    assert sum(64 * len(b.words) for b in tree.levels) / len(sequence) < entropy + 1.1
