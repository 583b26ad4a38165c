"""Searches, packing, archive, near duplicates, repeated passages and the pipeline against brute force."""

import base64
import hashlib
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.helpers import documents, odd_rows, prose
from tests.oracle import TESTDATA, compare, connect
from tidemark.llm import bloom, common, components, ngram_join, packing, suffixes, topk, warc
from tidemark.llm.driver import QUERIES, SQL
from tidemark.sources import folders

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    rows, difference = compare(QUERIES[name](spark, f"{TESTDATA}/sf0.001"), connect("sf0.001"), SQL[name])
    assert difference is None and rows > 0


VECTORS = "vec_id long, embedding array<double>, label string"


def test_top_k_with_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 7)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 3)
    rng = np.random.default_rng(3)
    rows = [(n, [float(x) for x in rng.normal(size=6).round(1)], "a") for n in range(60)]
    rows += [(70, None, "a"), (71, [1.0, None], "a"), (72, [float("nan")] * 6, "a"), (73, [float("inf")] * 6, "a"), (None, [1.0] * 6, "a")]
    rows += [(74, [0.0] * 6, "a"), (75, [2.0, 1.0], "a"), (76, [1e9] * 6, "a"), rows[3], rows[3], (80, [], "a"), (81, [0.5] * 6, "a"), (82, [0.5] * 6, "a")]
    df = spark.createDataFrame(rows, VECTORS)
    got = topk.top_k(df, F.col("id") % 5 == 0, 4).collect()
    fine = {i: tuple(int(np.floor(256 * x)) for x in v) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in fine if i % 5 == 0):
        scores = sorted((-sum(a * b for a, b in zip(fine[q], v)), i) for i, v in fine.items() if i != q)[:4]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    assert topk.top_k(df.filter("false"), F.col("id") % 5 == 0, 4).count() == 0


def check_packing(rows, texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[(doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes()))] += 1
    assert Counter(tuple(r[:5]) for r in rows) == want
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    return len(filled), -(-sum(r["length"] for r in rows) // 1024)


def test_packing_of_odd_rows(spark, odd):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.best_fit(odd, path, public_tokenizers.PATTERN).collect()
    used, least = check_packing(rows, [(r["doc_id"], r["text"]) for r in odd.collect()])
    assert used <= least + 1
    assert packing.best_fit(odd.filter("false"), path, public_tokenizers.PATTERN).count() == 0


def test_packing_of_a_table(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect()]
    used, least = check_packing(packing.op7_best_fit_packing(spark, f"{TESTDATA}/sf0.001").collect(), texts)
    assert used <= 1.03 * least + 1


@pytest.mark.parametrize("text", ["", " ", "  a", "a  b ", " \n b\n\n c", "x<|endoftext|> y", "é. è\xa0 ç", "a \x85b \x1cc", "don't we'll"])
def test_units_equal_the_library(text):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    assert packing.units(path, public_tokenizers.PATTERN).encode(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("histogram", [{}, {5: 3}, {1024: 4}, {600: 10, 500: 10}, {1: 100_000}, {513: 1000, 511: 999, 1: 1}, {n: 1 + n % 7 for n in range(1, 1024, 3)}])
def test_plan_uses_every_piece_once(histogram):
    plan, used = packing.plan(histogram, 1024), Counter()
    for pattern, count in plan:
        assert count > 0 and sum(n * c for n, c in pattern.items()) <= 1024
        for n, c in pattern.items():
            used[n] += c * count
    assert used == Counter(histogram)


def test_archive_of_odd_pages(spark, folder):
    pages = [(1, "u\r\nX: y", "<p>a"), (2, None, "<p>a"), (3, "v", None), (4, "w", ""), (5, "x", "é" * 10), (None, "n", "<p>a"), (None, "m", "only"), (7, "z", "long" * 50_000), (7, "z", "long" * 50_000)]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    warc.write_archive(df, f"{folder}/a")
    latest = {}
    for i, _, h in pages:
        latest[h or ""] = max(latest.get(h or "", -1), -1 if i is None else i)
    want = Counter()
    for i, _, h in pages:
        data, last = (h or "").encode(), latest[h or ""]
        own = last == -1 or i == last
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if own else "revisit", None if own else last)] += 1
    assert Counter(tuple(r) for r in warc.describe(spark, f"{folder}/a").collect()) == want
    assert spark.read.parquet(f"{folder}/a/payloads").count() == len(latest)
    for r in warc.restore(spark, f"{folder}/a").collect():
        head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and body == (b"" if r["record_type"] == "revisit" else bytes(r["payload"])) + b"\r\n\r\n"
        assert f"Content-Length: {len(body) - 4}".encode() in head and b"\r\nX: y" not in head
    warc.write_archive(df, f"{folder}/b", min_bytes=5)
    small = {r["record_type"] for r in warc.read_records(spark, f"{folder}/b").filter("page_id <= 4").collect()}
    assert small == {"response"}
    warc.write_archive(df.filter("false"), f"{folder}/c")
    assert warc.describe(spark, f"{folder}/c").count() == 0


def test_changed_payload_is_found(spark, folder):
    warc.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), f"{folder}/a")
    spark.read.parquet(f"{folder}/a/payloads").withColumn("payload", F.lit(b"abd")).write.parquet(f"{folder}/b/payloads")
    with pytest.raises(Exception, match="has changed"):
        warc.read_payloads(spark, f"{folder}/b").collect()


def linked_by_hand(rows, percent=85):
    sets = []
    for _, text in rows:
        w = (text or "").lower().split()
        sets.append(frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) > 3 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    ids = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            ids[find(n)] = min(ids.get(find(n), i), i)
    return Counter((i, len(s), ids.get(find(n)) if s else i) for n, ((i, _), s) in enumerate(zip(rows, sets)))


def near_copies():
    rows = []
    for n, size in enumerate((5, 8, 21, 22, 23, 34, 35, 60, 90, 140, 230)):
        words = prose(n, size).split()
        rows.append((n * 10, " ".join(words)))
        for k in range(1, 6):
            changed = words[:]
            for j in range(k):
                changed[(j * 13 + k) % len(changed)] = f"new{j}{k}"
            rows.append((n * 10 + k, " ".join(changed[: len(changed) - k % 3])))
    return rows + [(500 + n, prose(77, 90) + f" end{n}") for n in range(40)]


def test_join_equals_brute_force(spark, odd):
    rows = near_copies()
    got = Counter(tuple(r) for r in ngram_join.join(documents(spark, rows)).collect())
    assert got == linked_by_hand(rows)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert Counter(tuple(r) for r in ngram_join.join(odd).collect()) == linked_by_hand(rows)
    assert ngram_join.join(odd.filter("false")).count() == 0


def test_every_similar_pair_shares_enough_keys():
    rng = np.random.default_rng(5)
    for size in [*range(1, 60), 100, 226, 227, 363, 900]:
        x = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
        for grown in {0, size // 12, size * 15 // 100}:
            y = np.unique(np.concatenate([x[rng.permutation(len(x))[: len(x) - grown // 3]], rng.integers(0, 2**64, grown * 2 // 3, dtype=np.uint64)]))
            both, either = len(np.intersect1d(x, y)), len(np.union1d(x, y))
            if len(y) and 100 * both >= 85 * either:
                kx, ky = ngram_join.keys_of(x, 85), ngram_join.keys_of(y, 85)
                all_x, all_y = (np.concatenate([k for k, _ in ks]) for ks in (kx, ky))
                assert len(np.intersect1d(all_x, all_y))
                assert any(len(np.intersect1d(k, all_y)) >= max(1, need) for k, need in kx)


def test_a_large_group_costs_a_pair_per_row(spark, monkeypatch):
    """A third of the rows are near copies of one text, and all share a passage; compared pairs grow with rows, not with their square."""
    base, passage = prose(1, 300), prose(2, 12)
    rows = [(n, f"{base} {n} {prose(n, 4)} {passage}") for n in range(150)] + [(1000 + n, f"{prose(500 + n, 60)} {passage}") for n in range(300)]
    made, linked = [], ngram_join._linked
    monkeypatch.setattr(ngram_join, "_linked", lambda pairs, *more: made.append(pairs.count()) or linked(pairs, *more))
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(documents(spark, rows)).collect()}
    assert all(got[n] == 0 for n in range(150)) and all(got[1000 + n] == 1000 + n for n in range(300))
    assert sum(made) < 3 * len(rows)


@pytest.mark.parametrize("shown", [32, 1])
def test_a_pair_with_many_common_keys_is_made_once(spark, monkeypatch, shown):
    monkeypatch.setattr(ngram_join, "FIRST", shown)
    nodes = {1: {10, 11, 12, 13}, 2: {10, 11, 12, 13}, 3: {11, 12, 13, 14}, 4: {14, 15}, 5: {15}}
    now = spark.createDataFrame([(k, n, n) for n, keys in nodes.items() for k in keys], "key long, node long, root long")
    sketches = spark.createDataFrame([(n, 10, [1023] + [0] * 15) for n in nodes], "node long, size long, sketch array<long>")
    made = Counter((r["x"], r["y"]) for r in ngram_join._each_with_each(now, sketches, 85).collect())
    assert set(made) == {(x, y) for x in nodes for y in nodes if x < y and nodes[x] & nodes[y]}
    assert shown == 1 or set(made.values()) == {1}


def test_small_graphs_take_few_tasks(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(40)], "u long, v long").repartition(9)
    found = components.components(edges)
    assert found.rdd.getNumPartitions() <= 2 and {r["root"] for r in found.collect()} == {0}


def test_components_of_chains_and_stars(spark):
    edges = [(n, n + 1) for n in range(0, 40)] + [(100, n) for n in range(101, 160)] + [(200, 200)]
    got = {(r["node"], r["root"]) for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {(n, 0) for n in range(41)} | {(n, 100) for n in range(100, 160)}


def removed_by_hand(rows):
    """Rows of one id are documents of their own, ordered by the MD5 of their text; equal rows are one."""
    seen, out = {}, Counter()
    keys = {(i is not None, i or 0, hashlib.md5((text or "").encode()).digest()): (text or "").encode() for i, text in rows}
    for key in sorted(keys):
        data = keys[key]
        for p in range(len(data) - 99):
            seen.setdefault(data[p : p + 100], (key, p))
    for i, text in rows:
        data = (text or "").encode()
        key = (i is not None, i or 0, hashlib.md5(data).digest())
        gone = np.zeros(len(data) + 1, dtype=int)
        for p in range(len(data) - 99):
            if seen[data[p : p + 100]] < (key, p):
                gone[p] += 1
                gone[p + 100] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        kept = bytes(b for b, m in zip(data, mask) if not m)
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out[(i, len(data), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


def removed(frame):
    c = F.col("cut")
    got = suffixes.remove(frame, into="cut").select("doc_id", c["n_bytes"], c["n_removed"], c["n_spans"], F.sha2(c["kept"], 256))
    return Counter(tuple(r) for r in got.collect())


@pytest.mark.parametrize("hot", [10**6, 1])
def test_suffix_dedup_equals_brute_force(spark, odd, monkeypatch, hot):
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 5_000)
    passage = prose(40, 30)
    rows = [(n, prose(n, 20) + (" " + passage + " " if n % 3 else passage[n:]) + prose(100 + n, 10)) for n in range(30)]
    rows += [(50, "ab" * 400), (51, "x" * 99), (52, "x" * 100), (53, "x" * 130), (54, "é" * 120), (55, prose(1, 20) + passage[:60] + "!" + passage[60:])]
    rows += [(None, passage + prose(n, 3)) for n in range(6)] + [(7, passage), (7, "!" + passage)]
    for frame, texts in ((documents(spark, rows), rows), (odd, [(r["doc_id"], r["text"]) for r in odd.collect()])):
        assert removed(frame) == removed_by_hand(texts)
    assert suffixes.remove(odd.filter("false"), into="cut").count() == 0


def test_ten_thousand_rows_without_an_id_lose_their_repeats(spark):
    rows = [(None, f"{prose(n % 7, 25)} {n % 40}") for n in range(10_000)]
    assert removed(documents(spark, rows)) == removed_by_hand(rows)


def test_a_common_phrase_is_not_cut_into_windows(spark, monkeypatch):
    """Texts that share less than ``LENGTH`` bytes: longer keys tell them apart, whatever their number."""
    spans, pieces = [], suffixes._pieces
    monkeypatch.setattr(suffixes, "HOT", 3)
    monkeypatch.setattr(suffixes, "_pieces", lambda rows, span: spans.append(span) or pieces(rows, span))
    rows = [(n, prose(n, 15) + " a phrase that all of the texts have " + prose(100 + n, 15)) for n in range(40)]
    assert removed(documents(spark, rows)) == removed_by_hand(rows)
    assert spans == [39]


@pytest.mark.parametrize("span", suffixes.SPANS)
def test_equal_windows_lie_in_pieces_of_one_key(spark, span):
    """Whatever stretches they come from; and every window of a stretch is in one piece."""
    line = prose(3, 60).encode()
    at, n = 200, suffixes.LENGTH
    rows = [(0, at - b, line[b : e + n], k, b"", b, 0) for k, (b, e) in enumerate([(124, 200), (150, 170), (124, 124), (200, 200), (185, 199), (161, 163)])]
    cut = suffixes._pieces(spark.createDataFrame(rows, "anchor long, at long, bytes binary, doc long, print binary, begin long, skip long"), span).collect()
    found, keys = Counter(), {}
    for r in cut:
        for k in range(len(r["bytes"]) - n + 1):
            window = bytes(r["bytes"][k : k + n])
            first = r["begin"] + r["skip"] + k
            assert window == line[first : first + n] and r["at"] - k == at - first
            found[r["doc"], first] += 1
            keys.setdefault(window, set()).add(r["anchor"])
    assert found == Counter((k, w) for _, _, text, k, _, b, _ in rows for w in range(b, b + len(text) - n + 1))
    assert all(len(k) == 1 for k in keys.values())


@pytest.mark.parametrize("skip, n", [(0, 1), (0, 77), (5, 58), (62, 1), (62, 2), (63, 14), (70, 3), (0, 63)])
def test_bits_of_whole_pieces(spark, skip, n):
    r = spark.range(1).select(*suffixes._whole(F.lit(skip), F.lit(n))).first()
    assert r["bits"] | r["more"] << 63 == ((1 << n) - 1) << skip


def shuffled(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for n in range(blocks.size()) if (name := blocks.apply(n).name()).startswith("shuffle_")}


def test_only_what_is_read_again_stays_on_disk(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "HOT", 1)
    passage = prose(40, 40)
    texts = documents(spark, [(n, f"{prose(n, 20)} {passage[n:]}") for n in range(20)]).selectExpr("text", "doc_id AS doc", "unhex(md5(text)) AS print")
    folder = common.shared_dir(spark)
    was = set(folders.listed(spark, folder))
    seen = spark.sparkContext.broadcast(np.full(bloom.BITS // 8, 255, dtype=np.uint8))
    assert suffixes.entries(texts, seen).count() > 20
    assert [name.partition("-")[0] for name in set(folders.listed(spark, folder)) - was] == ["repeats"]

    before, tidy = shuffled(spark), spark.conf.get(common.TIDY)
    table_ = common.stored(texts.groupBy("doc").count(), "counts")
    until = time.time() + 20
    while (left := shuffled(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and table_.count() == 20 and spark.conf.get(common.TIDY) == tidy


@pytest.mark.parametrize("seed", range(4))
def test_suffixes_are_sorted_by_hash_comparisons(seed):
    rng = np.random.default_rng(seed)
    passages = [bytes(rng.integers(97, 99, 160).astype(np.uint8)) for _ in range(5)]
    passages += [passages[0][:140], b"a" * 150, b"a" * 130, passages[1]]
    suffixes_ = suffixes.Suffixes(passages)
    size = np.array([len(p) for p in passages])
    first = np.cumsum(size) - size
    suffix = np.concatenate([f + np.arange(n - 99) for f, n in zip(first, size)])
    group = np.sort(rng.integers(0, 4, len(suffix)))
    rng.shuffle(suffix)
    data = b"".join(passages)
    got = suffixes_.sort(suffix, group)
    for g in range(4):
        own = [data[p : p + 100] for p in got[group == g].tolist()]
        assert own == sorted(own) and sorted(got[group == g]) == sorted(suffix[group == g])
    a, b = rng.choice(suffix, 200), rng.choice(suffix, 200)
    want = [next((k for k in range(100) if data[x + k] != data[y + k]), 100) for x, y in zip(a.tolist(), b.tolist())]
    assert suffixes_.common(a, b).tolist() == want


def test_collided_hashes_change_nothing(monkeypatch):
    """With hashes that say nothing the order is wrong; the bytes show it, and decide."""
    rng = np.random.default_rng(1)
    passages = [bytes(rng.integers(97, 99, 120).astype(np.uint8)) for _ in range(6)]
    passages += [passages[0], passages[2][:110], passages[3][5:]]
    places = [(n, b"", 0) for n in range(len(passages))]
    anchors = np.zeros(len(passages), dtype=np.int64)
    offsets = np.array([50] * 8 + [45])
    want = suffixes.repeated(passages, anchors, offsets, places)
    assert any(want)
    monkeypatch.setattr(suffixes, "ranges", lambda sums, a, b: np.zeros(len(a), dtype=np.uint64))
    assert suffixes.repeated(passages, anchors, offsets, places) == want


def test_pipeline(spark, tables):
    clean = [(n, prose(n, 60), "en", "s") for n in range(40)]
    rows = clean + [(100, prose(3, 60), "en", "s"), (101, "a b", "en", "s"), (102, None, "en", "s"), (103, "word " * 100, "en", "s"), (104, " ".join(map(str, range(100, 130))), "en", "s")]
    docs, kept = documents(spark, rows), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, None)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect()})
    ids = set(range(40))
    assert kept[0] == ids | {100, 104} and kept[1] == ids | {100} and kept[2] == ids == kept[3]
    packed = corpus_pipeline.run(spark, tables(documents=documents(spark, rows)))
    assert {r["doc_id"] for r in packed.collect()} == ids
    empty = documents(spark, rows).filter("false")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, None).count() == 0


def test_the_stage_of_repeated_passages_leaves_only_what_its_rows_are_made_of(spark):
    docs = documents(spark, [(n, prose(n, 20) + " " + prose(900, 40)) for n in range(12)])
    folder = common.shared_dir(spark)
    was = set(folders.listed(spark, folder))
    cut = corpus_pipeline.repeated_passages(spark, docs, None)
    assert [name.partition("-")[0] for name in set(folders.listed(spark, folder)) - was] == ["repeats"]
    assert sum(prose(900, 40) in r["text"] for r in cut.collect()) == 1


def five_word_similarity(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_pipeline_drops_near_copies_of_five_words(spark):
    rows, gone = [], set()
    for n, (size, extra) in enumerate([(84, 19), (84, 20), (84, 21), (44, 10), (44, 11), (404, 100), (404, 101)]):
        text = prose(300 + n, size)
        grown = text + " " + " ".join(f"more{n}x{k}" for k in range(extra))
        block = text.split()
        block[20 : 20 + max(1, size // 9 - 5)] = [f"other{n}x{k}" for k in range(max(1, size // 9 - 5))]
        rows += [(10 * n, text), (10 * n + 1, grown), (10 * n + 2, " ".join(block))]
        gone |= {10 * n + k for k in (1, 2) if five_word_similarity(text, rows[3 * n + k][1]) >= 0.8}
    assert {1, 11, 31, 51} <= gone and not {21, 41, 61} & gone  # just above and just below
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, documents(spark, rows), None).collect()}
    assert kept == {i for i, _ in rows} - gone


def test_near_duplicates_are_told_by_row(spark):
    """One row of a group stays, whatever the ids are: null, repeated, shared with another text."""
    a, b, c = prose(1, 60), prose(2, 60), prose(3, 60)
    rows = [(None, a), (None, a), (5, a), (5, b), (7, c), (7, c), (None, None), (None, ""), (None, prose(4, 60)), (9, b), (3, a)]
    df = documents(spark, rows).selectExpr("*", "'x' AS row_key", "1 AS component_id")
    kept = corpus_pipeline.near_duplicates(spark, df, None)
    assert kept.columns == df.columns
    want = [(3, a), (5, b), (7, c), (None, None), (None, ""), (None, prose(4, 60))]
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(want)


def test_stages_take_odd_rows(spark, odd):
    """Null and repeated ids, copies, very long and empty texts and clashing columns: each stage keeps rows as they are or lets them go."""
    rows = odd.selectExpr("*", "'x' AS row_key", "'x' AS counted").unionByName(odd.selectExpr("*", "'x' AS row_key", "'x' AS counted"))
    before = Counter((r["doc_id"], r["source"]) for r in rows.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, None)
        assert out.columns == rows.columns, name
        found = Counter((r["doc_id"], r["source"]) for r in out.collect())
        assert not found - before, name
    pieces = corpus_pipeline.STAGES[-1][1](spark, rows, None)
    assert pieces.filter("start = 0").count() == rows.count()


def test_every_operator_is_registered():
    import __spark_entry__ as driver

    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in driver.queries()}
    assert "pipeline" in driver.queries()
