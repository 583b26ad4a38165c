"""Operator 12: collocations, phrases whose words occur together far more often than their parts do.

SON partitioning, two passes over the texts:

- Mining. Documents are dealt to ``SHARDS`` shards. Each shard is mined completely, for words and phrases of up to ``longest`` words,
  at the support lowered in proportion to its share of all bytes. A phrase with the full support has at least the lowered one in
  some shard, so the union of the shards' frequent phrases misses none. With many shards the lowered support would be 1 and
  nothing would be left out, so there are few (three: 4 of 10), and a shard is mined by all tasks that hold its documents. Phrases are named by
  48-bit hashes here; a collision adds counts up and can only make a rare phrase a candidate.
  A row has all names of a chunk that fall into one bucket of names, so few and wide rows are shuffled; buckets are mined apart.
- Counting. The candidates' names fill a Bloom filter of fixed size. All texts are read again, phrases that pass are counted
  globally as the words themselves, and the exact count decides. A false probe costs a row, a fuller filter more of them; the
  result is the same.

Both passes count inside a chunk of texts before rows are shuffled, so a common phrase is no hot key. Texts above
``SEGMENT`` bytes are cut at separators, each part with as many words of the next as a phrase may reach into it.
Scores are exact: decimal(38) holds the products of counts below 10**15.

Defined cases: null text is empty, null ``lang`` is ``und``. Rows count as they come, so repeated rows count again. Other columns are
ignored. An empty table, or one without a frequent phrase, gives an empty result. Ties go by frequency and then by the phrase's UTF-8 bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bloom
from tidemark.llm.common import stored, table
from tidemark.llm.hashing import SEED, mix, prefix_sums, ranges

SUPPORT, LONGEST, TOP, SHARE_PERCENT = 10, 3, 2000, 50
SHARDS = 3
#: Bytes of text that are counted together, and the longest part of a text that is held at a time.
CHUNK, SEGMENT = 2 << 20, 8 << 20
#: Bytes of text whose phrases are mined by one group of a shard, more or less.
BUCKET_BYTES = 16 << 20
#: Bytes of a phrase's name while it is mined.
NAME_BYTES = 6
#: Bits of the filter, and of the part that one row of Spark's bitmap aggregates holds.
FILTER_BITS, REGION_BITS = 27, 15
#: Shares of a language that are ranked apart first, and then again: at most the last number times ``top`` rows of a language meet.
SALTS = (64, 8)
UNKNOWN = "und"

WORD, GAP, BREAK = 0, 1, 2
KIND = np.zeros(256, dtype=np.uint8)
KIND[[0x20, 0x09]] = GAP
KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = BREAK
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SEPARATORS = rb"[.,;:!?\x20\x09-\x0D]"


def segments(text: bytes, longest: int) -> Iterator[tuple[bytes, int]]:
    """Parts of a text and how many of their bytes are their own: words that start later only complete phrases."""
    reach = re.compile(rb"(?:%s*[^.,;:!?\x20\x09-\x0D]+){0,%d}" % (SEPARATORS, longest - 1))
    start = 0
    while len(text) - start > SEGMENT:
        cut = re.compile(SEPARATORS).search(text, start + SEGMENT)
        if cut is None:
            break
        yield text[start : reach.match(text, cut.start()).end()], cut.start() - start
        start = cut.start()
    yield text[start:] if start else text, len(text) - start


Phrases = tuple[np.ndarray, list[np.ndarray], np.ndarray]


def phrases(parts: list[tuple[bytes, int]], groups: np.ndarray, longest: int) -> tuple[pa.Array, list[Phrases]]:
    """The distinct words, and per phrase length: the group of each distinct phrase, its words' numbers and its count."""
    data = np.frombuffer(b"\n".join(p for p, _ in parts) + b"\n", dtype=np.uint8)
    kind = KIND[data]
    inside = kind == WORD
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == BREAK, dtype=np.int32)[start]
    sizes = np.array([len(p) for p, _ in parts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    number = np.searchsorted(begins, start, side="right") - 1
    own = start < begins[number] + np.array([n for _, n in parts], dtype=np.int64)[number]
    offsets = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    coded = pa.BinaryArray.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(LOWER[data[inside]])]).dictionary_encode()
    word = coded.indices.to_numpy().astype(np.int64)
    n_words = max(len(coded.dictionary), 1)

    out: list[Phrases] = []
    at = np.flatnonzero(own)  # where the phrases of the present length start
    code = groups[number[at]].astype(np.int64) * n_words + word[at]
    for size in range(1, longest + 1):
        _, first, inverse, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        lead = at[first]
        out.append((groups[number[lead]], [word[lead + k] for k in range(size)], n))
        more = at + size < len(word)
        more[more] = piece[at[more] + size] == piece[at[more]]
        at, code = at[more], inverse[more] * n_words + word[at[more] + size]
    return coded.dictionary, out


def _hashes(words: pa.Array) -> np.ndarray:
    """64-bit hashes of the values of a binary array."""
    lengths = pc.binary_length(words).to_numpy().astype(np.int64)
    ends = np.cumsum(lengths)
    sums = prefix_sums(np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint8))
    return ranges(sums, ends - lengths, ends)


def _names(groups: np.ndarray, words: list[np.ndarray], group_hash: np.ndarray, word_hash: np.ndarray) -> np.ndarray:
    """Names of phrases of one length, as numbers of ``NAME_BYTES`` bytes."""
    name = mix(group_hash[groups] + np.uint64(len(words)) * SEED)
    for w in words:
        name = mix(name + word_hash[w])
    return name >> np.uint64(64 - 8 * NAME_BYTES)


def _chunks(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[list, list]]:
    """Parts of texts, about ``CHUNK`` bytes at a time, and their further columns as tuples."""
    parts, keys, size = [], [], 0
    for batch in batches:
        further = list(zip(*(c.to_pylist() for c in batch.columns[1:])))
        for n, value in enumerate(batch.column(0)):
            for part in segments((value.as_py() or "").encode(), longest):
                parts.append(part)
                keys.append(further[n])
                size += len(part[0])
                if size >= CHUNK:
                    yield parts, keys
                    parts, keys, size = [], [], 0
    if parts:
        yield parts, keys


def _numbered(keys: list) -> tuple[list, np.ndarray]:
    distinct = {k: n for n, k in enumerate(dict.fromkeys(keys))}
    return list(distinct), np.array([distinct[k] for k in keys], dtype=np.int64)


def local_counts(docs: DataFrame, longest: int, bucket_bits: int) -> DataFrame:
    """Counts of all phrases of ``docs`` (text, lang, shard), combined per chunk: a row has the names of a bucket, in order, and their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, keys in _chunks(batches, longest):
            distinct, groups = _numbered(keys)
            words, found = phrases(parts, groups, longest)
            word_hash = _hashes(words)
            group_hash = _hashes(pa.array([lang.encode() for lang, _ in distinct], pa.binary()))
            shards = np.array([shard for _, shard in distinct], dtype=np.int32)
            name = np.concatenate([_names(own, numbers, group_hash, word_hash) for own, numbers, _ in found])
            shard = np.concatenate([shards[own] for own, _, _ in found])
            n = np.concatenate([x[2] for x in found]).astype(np.uint32)
            for number in np.unique(shard).tolist():
                own = np.flatnonzero(shard == number)
                own = own[np.argsort(name[own])]
                bucket = (name[own] >> np.uint64(8 * NAME_BYTES - bucket_bits)).astype(np.int64)
                edge = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
                ends = np.concatenate([edge, [len(own)]])
                columns = [pa.array(bucket[edge]), pa.array(np.full(len(edge), number, dtype=np.int32)), _packed(_bytes(name[own]), ends), _packed(n[own], ends)]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "shard", "names", "counts"])

    return docs.select("text", "lang", "shard").mapInArrow(run, "bucket long, shard int, names binary, counts binary")


def _bytes(name: np.ndarray) -> np.ndarray:
    """Names in ``NAME_BYTES`` bytes each."""
    return name.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :NAME_BYTES]


def _unpacked(rows: list[bytes]) -> np.ndarray:
    held = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(-1, NAME_BYTES)
    out = np.zeros((len(held), 8), dtype=np.uint8)
    out[:, :NAME_BYTES] = held
    return out.view("<u8").ravel()


def _packed(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = (ends * (values.nbytes // max(len(values), 1))).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def candidates(docs: DataFrame, lowered: dict[int, int], longest: int, bucket_bits: int) -> np.ndarray:
    """The filter of the names that reach the lowered support of some shard."""

    def run(rows: pa.Table) -> pa.Table:
        frequent_ = []
        for number, least in lowered.items():
            own = rows.filter(pc.equal(rows["shard"], number))
            if own.num_rows:
                name = _unpacked(own["names"].to_pylist())
                n = np.frombuffer(b"".join(own["counts"].to_pylist()), dtype=np.uint32).astype(np.int64)
                order = np.argsort(name)
                name = name[order]
                edge = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
                frequent_.append(name[edge][np.add.reduceat(n[order], edge) >= least])
        place = _places(np.unique(np.concatenate(frequent_)))
        region, which = np.unique(place >> REGION_BITS, return_inverse=True)
        bits = np.zeros((len(region), 1 << REGION_BITS), dtype=bool)
        bits[which, place & ((1 << REGION_BITS) - 1)] = True
        return pa.Table.from_arrays([pa.array(region), pa.array([b.tobytes() for b in np.packbits(bits, axis=1, bitorder="little")], pa.binary())], names=["region", "bits"])

    out = np.zeros(1 << (FILTER_BITS - 3), dtype=np.uint8)
    counted = local_counts(docs, longest, bucket_bits).groupBy("bucket").applyInArrow(run, "region long, bits binary")
    size = 1 << (REGION_BITS - 3)
    for row in counted.groupBy("region").agg(F.bitmap_or_agg("bits").alias("bits")).toLocalIterator():  # one row a region
        out[row["region"] * size : (row["region"] + 1) * size] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def _places(name: np.ndarray) -> np.ndarray:
    """Bits of the filter that stand for names, all in the region of the name's highest bits."""
    region = (name >> np.uint64(8 * NAME_BYTES - FILTER_BITS + REGION_BITS)).astype(np.int64) << REGION_BITS
    low = np.uint64((1 << REGION_BITS) - 1)
    return np.concatenate([region + ((name >> np.uint64(13 * k)) & low).astype(np.int64) for k in range(3)])


def _passes(filter_: np.ndarray, name: np.ndarray) -> np.ndarray:
    return bloom.test(filter_, _places(name)).reshape(3, -1).all(axis=0)


def global_counts(docs: DataFrame, filter_, longest: int) -> DataFrame:
    """(lang, size, phrase, n) of the phrases that pass the filter, combined per chunk; size 0 has the number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for parts, keys in _chunks(batches, longest):
            distinct, groups = _numbered(keys)
            words, found = phrases(parts, groups, longest)
            word_hash = _hashes(words)
            langs = pa.array([lang for (lang,) in distinct], pa.string())
            group_hash = _hashes(langs.cast(pa.binary()))
            totals = np.bincount(found[0][0], weights=found[0][2], minlength=len(distinct)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([langs, pa.array([0] * len(distinct), pa.int32()), pa.array([""] * len(distinct)), pa.array(totals)], ["lang", "size", "phrase", "n"])
            for size, (own, numbers, n) in enumerate(found, 1):
                ok = _passes(filter_.value, _names(own, numbers, group_hash, word_hash))
                texts = [words.take(pa.array(w[ok])) for w in numbers]
                text = texts[0] if size == 1 else pc.binary_join_element_wise(*texts, pa.scalar(b" ", pa.binary()))
                columns = [langs.take(pa.array(own[ok])), pa.array(np.full(int(ok.sum()), size, dtype=np.int32)), text.cast(pa.string()), pa.array(n[ok])]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, size int, phrase string, n long")


def frequent(docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST) -> DataFrame:
    """(lang, size, phrase, n) of all words and phrases of ``docs`` (text, lang, shard) with the support, by SON; size 0 has the words of a language."""
    shares = {r["shard"]: r["n"] for r in docs.groupBy("shard").agg(F.sum(F.octet_length("text") + 1).alias("n")).collect()}  # SHARDS rows
    everything = sum(shares.values())
    lowered = {shard: -(-support * n // everything) for shard, n in shares.items()}
    bucket_bits = max(everything // BUCKET_BYTES, 1).bit_length()
    filter_ = docs.sparkSession.sparkContext.broadcast(candidates(docs, lowered, longest, bucket_bits))
    counted = global_counts(docs, filter_, longest).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return stored(counted.filter((F.col("n") >= support) | (F.col("size") == 0)), "phrases")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of every phrase of two or more words, by its lowest-scoring cut."""
    whole = counts.filter("size > 1").withColumnRenamed("n", "a")
    cut = whole.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumns({"left": F.expr("substring_index(phrase, ' ', k)"), "right": F.expr("substring_index(phrase, ' ', k - size)")})
    known = counts.filter("size > 0")
    left = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    # whole numbers of at most 38 digits: 10**6 * a * a on one side, l * r on the other
    score = F.expr("(1000000 * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(18,0)) * cast(r as decimal(18,0)))")
    joined = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score.cast("long"))
    lowest = joined.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("lowest"))
    return lowest.select("lang", "phrase", "size", "a", "lowest.l", "lowest.r", "lowest.score")


def mine(
    docs: DataFrame, support: int = SUPPORT, longest: int = LONGEST, top: int = TOP, share_percent: int = SHARE_PERCENT,
    doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
) -> DataFrame:
    """The ``top`` collocations of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase goes if a longer one of at least ``share_percent`` of its frequency holds it. It is enough to look at phrases one word
    longer: a part is at least as frequent as the whole.
    """
    rows = docs.select(
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
        F.coalesce(docs[lang].cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.pmod(F.xxhash64(docs[doc_id]), F.lit(SHARDS)).cast("int").alias("shard"),
    )
    counts = frequent(rows, support, longest)
    longer = counts.filter("size > 2").select(
        "lang", F.explode(F.expr("array(substring_index(phrase, ' ', size - 1), substring_index(phrase, ' ', 1 - size))")).alias("phrase"), F.col("n").alias("most")
    )
    longer = longer.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    left = scored(counts).join(longer, ["lang", "phrase"], "left").filter(F.col("most").isNull() | (100 * F.col("most") < share_percent * F.col("a")))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    near = left
    for salts in SALTS:
        salt = F.pmod(F.xxhash64("phrase"), F.lit(salts))
        near = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*order))).filter(F.col("rank") <= top)
    best = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    words = counts.filter("size = 0").select("lang", "n")  # one row per language
    return best.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(table(spark, sf_dir, "documents"))


SQL = f"""
WITH pieces AS (
    SELECT COALESCE(lang, '{UNKNOWN}') AS lang, unnest(string_split_regex(
        translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), lists AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), grams AS (
    SELECT lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
    FROM lists, (VALUES (1), (2), (3)) AS sizes(size)
), f AS MATERIALIZED (
    SELECT lang, size, phrase, COUNT(*) AS a FROM grams GROUP BY ALL
), n AS (
    SELECT lang, CAST(SUM(a) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS MATERIALIZED (
    SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size >= 2 AND a >= {SUPPORT}
), cuts AS (
    SELECT lang, size, phrase, a, k, array_to_string(w[1:k], ' ') AS x, array_to_string(w[k + 1:], ' ') AS y
    FROM candidates, (VALUES (1), (2)) AS ks(k) WHERE k < size
), scores AS (
    SELECT c.*, l.a AS l, r.a AS r, CAST((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a) AS BIGINT) AS score
    FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = c.x JOIN f r ON r.lang = c.lang AND r.phrase = c.y
), lowest AS (
    SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
    SELECT lang, part, MAX(a) AS most FROM (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM candidates WHERE size = 3) GROUP BY ALL
), left_over AS (
    SELECT s.* FROM lowest s LEFT JOIN longer o ON o.lang = s.lang AND o.part = s.phrase WHERE o.most IS NULL OR 100 * o.most < {SHARE_PERCENT} * s.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM left_over
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {TOP}
"""
