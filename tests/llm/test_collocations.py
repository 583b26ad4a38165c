"""Collocations against plain counting and the SQL of the query."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, prose
from tests.oracle import TESTDATA, compare, connect
from tidemark.llm import collocations as c

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, support, longest, top, share):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = set()
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= support}
        ranked = []
        for p, a in candidates.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in candidates.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(ranked)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return out


def rows():
    out = []
    for seed in range(40):
        text = prose(seed, 80).replace("4", ".").replace("7", " ").replace("31", "").replace("beta", "\tBETA  Gamma").replace("nu", "é!\r\nü")
        out.append((seed, text, ["en", "fr", None, "und"][seed % 4], "s"))
    out += [(None, prose(1, 50), None, None), (None, prose(1, 50), "en", None), (41, None, "en", "s"), (42, "", "en", "s"), (43, "?!., \n", "xx", "s")]
    out += [(44, "the cat sat. " * 300, "en", "s"), (44, "the cat sat. " * 300, "en", "s"), (45, "a b c d " * 20, "zz", "s"), (46, "Straße in İstanbul, " * 30, "tr", "s")]
    return out


@pytest.mark.parametrize("support,longest,top,share", [(10, 3, 2000, 50), (4, 2, 7, 50), (6, 4, 50, 90), (1, 3, 30, 50)])
def test_mining_equals_plain_counting(spark, support, longest, top, share):
    df = documents(spark, rows()).selectExpr("*", "'x' AS shard", "'x' AS phrase", "1 AS n", "'x' AS size")
    got = c.mine(df, support, longest, top, share).collect()
    want = plain(rows(), support, longest, top, share)
    assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_long_texts_are_cut_without_losing_phrases(spark, monkeypatch):
    texts = [prose(n, 400).replace("3", ",") for n in range(3)] + ["x" * 900 + " y z", " " * 700 + "a b c", "no", ""]
    for size in (64, 200):
        monkeypatch.setattr(c, "SEGMENT", size)
        for longest in (2, 3, 4):
            parts = [p for t in texts for p in c.segments(t.encode(), longest)]
            whole = [(t.encode(), len(t.encode())) for t in texts]
            found = [phrase_counts(x, longest) for x in (parts, whole)]
            assert found[0] == found[1]
            assert max(n for _, n in parts) <= max(size + 40, 905)


def phrase_counts(parts, longest):
    import numpy as np

    words, found = c.phrases(parts, np.zeros(len(parts), dtype=np.int64), longest)
    words = words.to_pylist()
    out = Counter()
    for _, numbers, n in found:
        for key, count in zip(zip(*(w.tolist() for w in numbers)), n.tolist()):
            out[tuple(words[x] for x in key)] += count
    return out


def test_no_frequent_phrase_and_no_rows(spark):
    df = documents(spark, [(1, "a b c"), (2, None)])
    assert c.mine(df).count() == 0
    assert c.mine(df.filter(F.lit(False))).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 999_999_999_999_937
    counts = spark.createDataFrame([("en", 1, "a", big), ("en", 1, "b", big - 5), ("en", 2, "a b", big - 9)], "lang string, size int, phrase string, n long")
    row = c.scored(counts).collect()[0]
    assert row["score"] == 10**6 * (big - 9) ** 2 // (big * (big - 5))


def test_every_frequent_phrase_is_mined_in_some_shard(spark):
    """One shard with nearly all bytes, as with null ids, loses nothing."""
    df = documents(spark, [(None, prose(n % 9, 60)) for n in range(60)] + [(n, prose(n, 30)) for n in range(5)])
    got = {tuple(r) for r in c.mine(df, support=5).collect()}
    assert got == plain([(None, prose(n % 9, 60), "en") for n in range(60)] + [(n, prose(n, 30), "en") for n in range(5)], 5, 3, 2000, 50)


def test_query_equals_its_sql(spark):
    difference = compare(c.op12_collocations(spark, f"{TESTDATA}/sf0.01"), connect("sf0.01"), c.SQL)
    assert difference[1] is None and difference[0] > 100
