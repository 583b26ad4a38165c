"""Operator 3: language-model scores from a log-frequency Bloom filter.

``count_words`` counts all tokens of the training texts exactly. ``build_filter`` puts every word and every pair of neighbours
into a Bloom filter under their quantised count: a count of level q is stored as q entries (n-gram, 1) to (n-gram, q), levels
growing with the logarithm of the count. A level is read by probing 1, 2, ... until an entry is missing. Unseen n-grams may be
taken for rare ones, never seen ones for unseen.

The filter grows with the corpus. It is cut into parts by the first bits of the hash, about one for ``PER_BUCKET`` tokens; each
part counts its entries and takes the bits at which a share of ``FALSE_RATE`` of the missing entries is found. Entries, load and
share of false entries are returned with it. The parts are a table and no task holds more than one: texts are packed into blobs
of some megabytes, the distinct n-grams of a blob go to their parts, and the levels come back to the blob. Keys of a part go in
ascending order, as differences.

A text's probability is a mixture, over ``WEIGHTS``, of interpolations between the smoothed word probability and the discounted
probability after the word before; the weight that suits a text decides its score. The discount is most of what the text itself
adds to a count, so a text that occurs twice is told from one that occurs once.

The base score needs exact counts of all words, which grow with the corpus. The most frequent words, as many levels of counts as
hold at most ``FREQUENT`` (of 64 bytes at most, so the list is bounded), are looked up in the workers; the others, with their counts per text, are joined with the stored
counts by Spark. So frequent words are no hot keys of a join.

Defined cases: null text is empty: its end is its only token. Rows without an id are learned from. Repeated rows are scored each
for itself. With nothing to learn from N and V are 0 and every token has probability 1 / 1. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, remainder, stored, table, words_of
from tidemark.llm.hashing import SEED, chunks, mix, word_hashes

#: Share of missing entries that the filter takes for present ones, and its hashes per entry.
FALSE_RATE, HASHES = 0.003, 4
#: Base of the logarithm that quantises counts, and highest level.
QUANTUM, LEVELS = 1.5, 100
FREQUENT, FREQUENT_BYTES = 100_000, 64
WEIGHTS = (0.001, 0.1, 0.5, 0.9)
#: Tokens gathered in a task before they are counted, and tokens of the corpus per bucket.
GATHER, PER_BUCKET = 1 << 21, 1 << 22
#: Bytes of texts in a blob; the larger it is, the fewer n-grams are asked for twice.
BLOB_BYTES = 4 << 20
#: A blob lies on disk twice; at Arrow's own level (1) it is a fifth larger.
BLOB_LEVEL = 6
#: Taken off the count of a pair: most texts that are scored are among those that were counted.
DISCOUNT = 0.75
#: The end of a text; no word holds a space.
END = " "
END_HASH = np.uint64(0xE7037ED1A0B428DB)


def level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(QUANTUM) + 1e-9).astype(np.int64)


def expected() -> np.ndarray:
    """The mean count of each level; 0 for level 0."""
    low = np.ceil(QUANTUM ** np.arange(LEVELS) - 1e-9)
    high = np.ceil(QUANTUM ** np.arange(1, LEVELS + 1) - 1e-9) - 1
    return np.concatenate([[0], (low + np.maximum(low, high)) / 2])


@dataclass
class Load:
    """Entries of a filter, its bits, the share of them that is set, and the share of missing entries that it takes for present."""

    entries: int
    bits: int
    load: float
    false_rate: float


def bits_for(entries: int) -> int:
    """Bits, in whole bytes, at which so many entries leave ``FALSE_RATE``."""
    return 8 * max(8, math.ceil(-HASHES * entries / math.log(1 - FALSE_RATE ** (1 / HASHES)) / 8))


@dataclass
class LogBloom:
    """Bits in ``buckets`` equal parts; the first bits of a key choose its part, the next 32 bits its places there."""

    bits: np.ndarray
    buckets: int

    @staticmethod
    def places(keys: np.ndarray, level_: int, size: int) -> Iterator[np.ndarray]:
        """Places in a part of ``size`` bits for 32-bit keys at a level."""
        for n in range(HASHES):
            salt = np.uint64(int(SEED) * (HASHES * level_ + n) & 0xFFFFFFFFFFFFFFFF)
            yield (mix(keys.astype(np.uint64) + salt) % np.uint64(size)).astype(np.int64)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        """Level of each n-gram hash by probes that stop at the first missing entry."""
        return self.levels_of(*split(hashes, self.buckets))

    def levels_of(self, bucket: np.ndarray, key: np.ndarray) -> np.ndarray:
        size = len(self.bits) * 8 // self.buckets
        out = np.zeros(len(key), dtype=np.int64)
        alive = np.arange(len(key))
        for q in range(1, LEVELS + 1):
            hit = np.ones(len(alive), dtype=bool)
            for place in self.places(key[alive], q, size):
                at = bucket[alive] * size + place
                hit &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
            alive = alive[hit]
            if not len(alive):
                break
            out[alive] = q
        return out


def split(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 32-bit key of 64-bit hashes."""
    width = buckets.bit_length() - 1
    return (hashes >> np.uint64(64 - width)).astype(np.int64) if width else np.zeros(len(hashes), dtype=np.int64), ((hashes >> np.uint64(32 - width)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of texts, ends included, and the place of each text's first token."""
    joined = b"\n".join(t.lower() for t in texts) + b"\n"
    start, words = word_hashes(np.frombuffer(joined, dtype=np.uint8))
    doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), start, side="right")
    sizes = np.bincount(doc, minlength=len(texts)) + 1
    tokens = np.full(int(sizes.sum()), END_HASH, dtype=np.uint64)
    tokens[np.arange(len(words)) + doc] = words
    return tokens, np.cumsum(sizes) - sizes


def pairs_of(tokens: np.ndarray) -> np.ndarray:
    """Hash of each token and the one before it; the first entry has no meaning."""
    return mix(np.concatenate([tokens[:1], tokens[:-1]]) * SEED + tokens)


def shortened(keys: np.ndarray) -> bytes:
    """Ascending 32-bit keys as differences of as few bytes each as all of them fit in; the first byte says how many."""
    steps = np.diff(keys, prepend=np.uint32(0)).astype("<u4")
    width = max(1, -(-int(steps.max(initial=0)).bit_length() // 8))
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()


def lengthened(packed: bytes) -> np.ndarray:
    width = packed[0]
    steps = np.zeros(((len(packed) - 1) // width, 4), dtype=np.uint8)
    steps[:, :width] = np.frombuffer(packed, dtype=np.uint8, offset=1).reshape(-1, width)
    return np.cumsum(steps.view("<u4").ravel(), dtype=np.uint32)


def _blobs(keys: np.ndarray, counts: np.ndarray, buckets: int, pair: bool) -> Iterator[tuple[int, bool, bytes, bytes, bytes]]:
    """Per bucket the keys seen once, and keys and counts of the others. ``keys`` ascend, so buckets do."""
    bucket, short = split(keys, buckets)
    new = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else []
    for a, b in zip(new, [*new[1:], len(keys)]):
        once = counts[a:b] == 1
        yield int(bucket[a]), pair, shortened(short[a:b][once]), shortened(short[a:b][~once]), counts[a:b][~once].astype(np.int64).tobytes()


BLOBS = "bucket int, pair boolean, once binary, keys binary, counts binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["bucket", "pair", "once", "keys", "counts"])


def count_words(texts: DataFrame) -> DataFrame:
    """(word, count) of all tokens in the column ``text``, the end included."""
    tokens = F.concat(words_of(lower_ascii(F.col("text"))), F.array(F.lit(END)))
    return texts.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count("*").alias("count"))


def frequent_words(words: DataFrame) -> DataFrame:
    """The words of the highest levels of counts that hold at most ``FREQUENT`` words together."""
    short = words.filter(F.octet_length("word") <= FREQUENT_BYTES)
    magnitude = F.floor(F.log2("count") * 4).cast("int")
    sizes = sorted(((r["m"], r["n"]) for r in short.groupBy(magnitude.alias("m")).agg(F.count("*").alias("n")).collect()), reverse=True)  # 256 rows at most
    least, held = 1 << 20, 0
    for m, n in sizes:
        if held + n > FREQUENT:
            break
        least, held = m, held + n
    return short.filter(magnitude >= least)


def buckets_for(n_tokens: int) -> int:
    return 1 << max(8, (n_tokens // PER_BUCKET).bit_length())


def build_filter(texts: DataFrame, words: DataFrame, n_tokens: int) -> tuple[DataFrame, Load]:
    """(bucket, bits) of every part that has entries, and the load of all."""
    buckets = buckets_for(n_tokens)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            return _batch(list(_blobs(keys, counts, buckets, True)))

        for batch in batches:
            for _, chunk in chunks(batch.column(0)):
                tokens, first = tokens_of(chunk)
                inside = np.ones(len(tokens), dtype=bool)
                inside[first] = False
                held.append(pairs_of(tokens)[inside])
                size += len(held[-1])
                if size >= GATHER:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    def single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = word_list_hashes(batch.column(0).to_pylist())
            order = np.argsort(hashes, kind="stable")
            rows = list(_blobs(hashes[order], batch.column(1).to_numpy()[order], buckets, False))
            if rows:
                yield _batch(rows)

    def fill(key, frame: pd.DataFrame) -> pd.DataFrame:
        counted = []
        for _, rows in frame.groupby("pair"):
            once = np.concatenate([lengthened(b) for b in rows["once"]])
            more = np.concatenate([lengthened(b) for b in rows["keys"]])
            counts = np.concatenate([np.ones(len(once), dtype=np.int64), *(np.frombuffer(b, dtype=np.int64) for b in rows["counts"])])
            keys, at = np.unique(np.concatenate([once, more]), return_inverse=True)
            counted.append((keys, level(np.maximum(np.bincount(at, weights=counts).astype(np.int64), 1))))
        entries = sum(int(levels.sum()) for _, levels in counted)
        size = bits_for(entries)
        bits = np.zeros(size, dtype=bool)
        for keys, levels in counted:
            for q in range(1, int(levels.max(initial=0)) + 1):
                for place in LogBloom.places(keys[levels >= q], q, size):
                    bits[place] = True
        packed = np.packbits(bits, bitorder="little").tobytes()
        return pd.DataFrame({"bucket": [key[0]], "bits": [packed], "entries": [entries], "size": [size], "ones": [int(bits.sum())]})

    blobs = texts.select("text").mapInArrow(pairs, BLOBS).unionByName(words.select("word", "count").mapInArrow(single, BLOBS))
    parts = stored(blobs.groupBy("bucket").applyInPandas(fill, "bucket int, bits binary, entries long, size long, ones long"), "filter")
    sums = parts.agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in ("entries", "size", "ones", F.col("size") * F.pow(F.col("ones") / F.col("size"), F.lit(HASHES))))).first()
    size = max(1, sums[1])
    return parts.select("bucket", "bits"), Load(sums[0], sums[1], sums[2] / size, sums[3] / size)


def word_list_hashes(words: list[str]) -> np.ndarray:
    hashes = np.full(len(words), END_HASH, dtype=np.uint64)
    real = [n for n, w in enumerate(words) if w != END]
    if real:
        hashes[real] = word_hashes(np.frombuffer(b"\n".join(words[n].encode() for n in real) + b"\n", dtype=np.uint8))[1]
    return hashes


def _pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=BLOB_LEVEL))) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> tuple[list, list, list[bytes]]:
    """Ids, marks and texts of a blob."""
    ids, texts, learned = pa.ipc.open_stream(blob).read_all().columns
    return ids.to_pylist(), learned.to_pylist(), [(t or "").encode() for t in texts.to_pylist()]


def n_grams(tokens: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of all tokens and pairs, ascending, and the place of each token's and each pair's there."""
    both = pairs_of(tokens)
    both[first] = tokens[first]  # no pair
    return np.unique(np.concatenate([tokens, both]), return_inverse=True)


def _packed(docs: DataFrame) -> DataFrame:
    """(chunk, blob): about ``BLOB_BYTES`` of rows each; ``chunk`` is the number of its first row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, texts in chunks(batch.column(1), BLOB_BYTES):
                blob = _pack(batch.slice(first, len(texts)))
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([blob], pa.binary())], ["chunk", "blob"])
                number += len(texts)

    return stored(docs.select("doc_id", "text", "learned").mapInArrow(run, "chunk long, blob binary"), "texts")


def _levels(packed: DataFrame, parts: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, levels): a byte for each distinct n-gram of a blob that belongs to the bucket."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens, first = tokens_of(_unpack(blob.as_py())[2])
                bucket, key = split(n_grams(tokens, first)[0], buckets)
                cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(key)]
                wanted = [shortened(key[a:b]) for a, b in zip(cuts, cuts[1:])]
                kinds = (pa.int64(), pa.int32(), pa.binary())
                columns = ([chunk] * len(wanted), bucket[cuts[:-1]].tolist(), wanted)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["chunk", "bucket", "keys"])

    def answer(asked: pa.Table, part: pa.Table) -> pa.Table:
        wanted = [lengthened(w) for w in asked["keys"].to_pylist()]
        keys, at = np.unique(np.concatenate([np.zeros(0, dtype=np.uint32), *wanted]), return_inverse=True)
        found = np.zeros(len(keys), dtype=np.int64)
        if part.num_rows and len(keys):
            found = LogBloom(np.frombuffer(part["bits"][0].as_py(), dtype=np.uint8), 1).levels_of(np.zeros(len(keys), dtype=np.int64), keys)
        ends = np.cumsum([len(w) for w in wanted], dtype=np.int64).tolist()
        levels = found[at].astype(np.uint8).tobytes()
        return pa.table({"chunk": asked["chunk"], "bucket": asked["bucket"], "levels": pa.array([levels[a:b] for a, b in zip([0, *ends], ends)], pa.binary())})

    asked = packed.mapInArrow(ask, "chunk long, bucket int, keys binary")
    return asked.groupBy("bucket").cogroup(parts.groupBy("bucket")).applyInArrow(answer, "chunk long, bucket int, levels binary")


def model_scores(tokens: np.ndarray, first: np.ndarray, levels: np.ndarray, at: np.ndarray, vocabulary: int, n_tokens: int) -> np.ndarray:
    """log10 probability of each text, from the levels of the distinct n-grams and the places of tokens and pairs there."""
    counts = expected()[levels][at]
    alone, both = counts[: len(tokens)], counts[len(tokens) :]
    both[first] = 0
    before = np.concatenate([[0], alone[:-1]])
    word = np.minimum((alone + 1) / (n_tokens + vocabulary + 1), 1.0)
    after = np.where((both > 0) & (before > 0), np.minimum(np.maximum(both - DISCOUNT, 0) / np.maximum(before, 1), 1.0), 0.0)
    sums = np.array([np.add.reduceat(np.log10((1 - w) * word + w * after), first) for w in WEIGHTS])
    top = sums.max(axis=0)
    return top + np.log10(np.mean(10.0 ** (sums - top), axis=0))


def _lines(rows: DataFrame) -> DataFrame:
    """One line for the row itself and one for each of its rarer words: a single shuffle by word brings the counts. In place of a
    word the row's own line has a key that no word equals and no other line has, so these lines are spread like words."""
    head = F.array(F.struct(F.concat(F.lit(END), F.col("number").cast("string")).alias("word"), F.lit(0).cast("long").alias("times"), F.struct("doc_id", "learned", "n_tokens", "seen", "base", "score").alias("row")))
    tail = F.transform("rare", lambda x: F.struct(x["word"].alias("word"), x["times"].alias("times"), F.lit(None).cast("struct<doc_id: bigint, learned: boolean, n_tokens: bigint, seen: bigint, base: double, score: double>").alias("row")))
    return rows.select("number", F.explode(F.concat(head, tail)).alias("x")).select("number", "x.*")


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, learned (whether the row was learned from), n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"), learn.alias("learned"))
    texts = docs.filter("learned").select("text")
    words = stored(count_words(texts), "words")
    totals = words.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n_tokens, vocabulary = int(totals["n"]), int(totals["v"])
    denominator = n_tokens + vocabulary + 1
    listed = frequent_words(words).collect()  # FREQUENT rows at most, whatever the number of tasks
    frequent = spark.sparkContext.broadcast({r["word"].encode(): math.log10((r["count"] + 1) / denominator) for r in listed})
    parts, _ = build_filter(texts, words, n_tokens)
    packed = _packed(docs)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        logs = frequent.value
        ids, learned, texts = _unpack(left["blob"][0].as_py())
        tokens, first = tokens_of(texts)
        answers = sorted(zip(right["bucket"].to_pylist(), right["levels"].to_pylist()))
        levels = np.frombuffer(b"".join(x for _, x in answers), dtype=np.uint8)
        scores = model_scores(tokens, first, levels, n_grams(tokens, first)[1], vocabulary, n_tokens)
        number, rows = left["chunk"][0].as_py(), []
        for n, body in enumerate(texts):
            counts = Counter(body.lower().split())
            counts[END.encode()] += 1
            base, seen, rare = 0.0, 0, []
            for word, times in counts.items():
                log = logs.get(word)
                if log is None:
                    rare.append({"word": word.decode(), "times": times})
                else:
                    base += times * log
                    seen += times
            rows.append((number + n, ids[n], learned[n], sum(counts.values()), seen, base, float(scores[n]), rare))
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())])))
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["number", "doc_id", "learned", "n_tokens", "seen", "base", "score", "rare"])

    schema = "number long, doc_id long, learned boolean, n_tokens long, seen long, base double, score double, rare array<struct<word: string, times: long>>"
    levels = _levels(packed, parts, buckets_for(n_tokens))
    rows = packed.groupBy("chunk").cogroup(levels.groupBy("chunk")).applyInArrow(run, schema)
    lines = _lines(rows)
    counted = lines.join(words, "word", "left")
    found = F.coalesce(F.col("count"), F.lit(0))
    summed = counted.groupBy("number").agg(
        F.max("row").alias("row"),
        F.sum(F.when(found > 0, F.col("times")).otherwise(0)).alias("seen"),
        F.sum(F.col("times") * F.log10((found + 1) / F.lit(float(denominator)))).alias("base"),
    )
    return summed.select(
        "row.doc_id", "row.learned", "row.n_tokens", (F.col("row.seen") + F.col("seen")).alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"), (F.col("row.base") + F.col("base")).alias("base_score"), "row.score",
    )


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, remainder(F.col("doc_id"), 7) != 2)
    held_out = remainder(F.col("doc_id"), 7) == 2
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
