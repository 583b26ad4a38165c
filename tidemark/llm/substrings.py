"""Operator 11: remove words inside repeated windows of ``LENGTH`` words, by FM-indexes over shards of the corpus.

A word goes if a window of ``LENGTH`` words that covers it also starts earlier: in a smaller document, or earlier in the same one.

- Routing. Shards hold what can match, not what was read together: every window is filed under its anchor, the ``GRAM`` words of
  least hash in it, and neighbouring windows with one anchor are a stretch. Equal windows have equal anchors at equal places, so a
  window is looked for in one shard only, instead of streaming each document past all of them. Anchors seen once are dropped
  by a Bloom filter of fixed size; its false positives change nothing.
- Indexing. Equal stretches are stored once, with their earliest place. The stretches of a shard (about ``SHARD_WORDS`` words, by
  hash of the anchor) are the text of an FM-index: words numbered exactly, suffixes ordered, transform in a wavelet tree.
- Searching. The stretches are streamed back through their index: backward search from every window's end gives the matching statistics,
  the words before it that occur elsewhere too. Where they reach ``LENGTH`` the interval is reported, and the earliest
  place among its rows decides. Words are compared, not hashes. Copies of a stretch other than the earliest go as a whole.
- Hot anchors. An anchor with more than ``HOT`` distinct stretches (a common passage in changing surroundings) would make its shard
  grow with the data. Its stretches are cut into single windows, and equal windows are grouped by their words instead.

Defined cases: null text has no words. Texts below ``LENGTH`` words lose nothing. Null ids come before all others. Rows of one id are
documents of their own, ordered by the MD5 of their text; rows equal in both are one document and keep the same words. Empty tables
give an empty result. ``remove`` adds one struct column and leaves the others as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bloom
from tidemark.llm.common import fresh, stored, table
from tidemark.llm.fm_index import END, FMIndex
from tidemark.llm.hashing import CHUNK_BYTES, WHITE, chunks, mix, word_hashes
from tidemark.llm.suffixes import sliding_least

LENGTH, GRAM = 20, 4
SHARD_WORDS, HOT = 250_000, 1024
BEFORE_ALL = -(1 << 63)
#: Bits of a number of a word in a text, or in the texts that a task reads together.
OFFSET_BITS = 32
OFFSET = np.uint64(OFFSET_BITS)


class Stretches:
    """Stretches of some texts: number of the text, hash of the anchor, first and last window, as word numbers of the joined texts."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> None:
        self.texts = [b" ".join(t.split()) for t in texts]
        data = np.frombuffer(b"\n".join(self.texts) + b"\n", dtype=np.uint8)
        starts, hashes, at = [], [], 0
        while at < len(data):  # a long text is hashed in parts, cut between words
            more = np.flatnonzero(WHITE[data[at + CHUNK_BYTES : at + 2 * CHUNK_BYTES]])
            stop = at + CHUNK_BYTES + int(more[0]) if len(more) else len(data)
            start, found = word_hashes(data[at:stop])
            starts.append(start + at)
            hashes.append(found)
            at = stop
        self.start, word = np.concatenate(starts), np.concatenate(hashes)
        sizes = np.array([t.count(b" ") + 1 if t else 0 for t in self.texts], dtype=np.int64)
        self.data, self.length = data, length
        self.ends = np.cumsum(sizes)
        self.begins = self.ends - sizes
        none = np.zeros(0, dtype=np.int64)
        self.text = self.anchor = self.first = self.last = none
        if not (sizes >= length).any():
            return
        name = word[gram - 1 :]
        for k in range(gram - 2, -1, -1):
            name = mix(name + word[k : k + len(name)])
        # least by the upper half of the hash, then leftmost: the same choice in equal windows, whatever they are read with
        place = sliding_least((name >> OFFSET << OFFSET) | np.arange(len(name), dtype=np.uint64), length - gram + 1) & ((np.uint64(1) << OFFSET) - np.uint64(1))
        inside = np.zeros(len(word) + 1, dtype=np.int64)
        long = sizes >= length
        np.add.at(inside, self.begins[long], 1)
        np.add.at(inside, self.ends[long] - length + 1, -1)
        window = np.flatnonzero(np.cumsum(inside[: len(place)]) > 0)
        place = place[window].astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        self.first, self.last = window[edge], window[np.concatenate([edge[1:], [len(window)]]) - 1]
        self.anchor = name[place[edge]].view(np.int64)
        self.text = np.searchsorted(self.ends, self.first, side="right")

    def only(self, ok: np.ndarray) -> None:
        self.text, self.anchor, self.first, self.last = (x[ok] for x in (self.text, self.anchor, self.first, self.last))

    def words(self) -> list[bytes]:
        """The words of each stretch, joined by one space."""
        begin = self.start[self.first]
        after = np.concatenate([self.start, [len(self.data)]])[self.last + self.length]
        whole = self.data.tobytes()
        return [whole[a:b].rstrip() for a, b in zip(begin.tolist(), after.tolist())]


def _anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                anchor, n = np.unique(Stretches(texts).anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n)], ["anchor", "n"])

    return docs.select("text").mapInArrow(run, "anchor long, n long")


def _shared(docs: DataFrame, seen) -> DataFrame:
    """Stretches whose anchor passes the filter: anchor, words, and where they are: document, text digest and first window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, prints = batch.column(1), batch.column(2)
            for number, texts in chunks(batch.column(0)):
                found = Stretches(texts)
                found.only(bloom.passes(seen.value, found.anchor))
                rows = pa.array(number + found.text)
                begin = found.first - found.begins[found.text]
                yield pa.RecordBatch.from_arrays([pa.array(found.anchor), pa.array(found.words(), pa.binary()), docs_.take(rows), prints.take(rows), pa.array(begin)], ["anchor", "words", "doc", "print", "begin"])

    return docs.select("text", "doc", "print").mapInArrow(run, "anchor long, words binary, doc long, print binary, begin long")


def numbered(passages: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A text of exact word numbers with ``END`` after each passage, where each passage starts in it, and its words."""
    data = np.frombuffer(b"\n".join(passages) + b"\n", dtype=np.uint8)
    breaks = np.flatnonzero((data == 32) | (data == 10))
    begin = np.concatenate([[0], breaks[:-1] + 1])
    offsets = np.concatenate([[0], np.cumsum(breaks - begin)]).astype(np.int32)
    values = data[(data != 32) & (data != 10)]
    words = pa.BinaryArray.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(values)]).dictionary_encode().indices.to_numpy()
    sizes = np.array([p.count(b" ") + 1 for p in passages], dtype=np.int64)
    text = np.zeros(len(words) + len(passages), dtype=np.int64)
    place = np.arange(len(words)) + np.repeat(np.arange(len(passages)), sizes)
    text[place] = words + END + 1
    return text, np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]), sizes


def repeated(passages: list[bytes], places: list[tuple], length: int = LENGTH) -> np.ndarray:
    """Per passage the windows, as bits, that occur at an earlier place in one of the passages. ``places``: (document, ..., first window)."""
    text, begin, sizes = numbered(passages)
    index = FMIndex(text, length + 1)
    documents = {d: n for n, d in enumerate(sorted({p[:-1] for p in places}))}
    base = np.array([(documents[p[:-1]] << OFFSET_BITS) + p[-1] for p in places], dtype=np.int64)
    windows = sizes - length + 1
    passage = np.repeat(np.arange(len(passages)), windows)
    number = np.arange(len(passage)) - np.repeat(np.cumsum(windows) - windows, windows)
    own = base[passage] + number
    place = np.repeat(base - begin, sizes + 1) + np.arange(len(text))  # of the word at each place of the text
    matched, low, high = index.matching_statistics(begin[passage] + number + length, length)
    some = np.flatnonzero(matched >= length)
    later = some[index.least(place, low[some], high[some]) < own[some]]
    bits = np.zeros(len(passages), dtype=np.int64)
    np.bitwise_or.at(bits, passage[later], np.int64(1) << number[later])
    return bits


FOUND = "doc long, print binary, begin long, bits long"


def _by_index(rows: DataFrame, shards: int) -> DataFrame:
    """The repeated windows of each stretch, by the index of its shard."""

    def run(table_: pa.Table) -> pa.Table:
        names = ("doc", "print", "begin")
        places = list(zip(*(table_[c].to_pylist() for c in names)))
        bits = repeated(table_["words"].to_pylist(), places)
        return pa.Table.from_arrays([*(table_[c] for c in names), pa.array(bits)], names=[*names, "bits"])

    return rows.groupBy(F.pmod("anchor", F.lit(shards)).alias("shard")).applyInArrow(run, FOUND)


def _by_group(rows: DataFrame) -> DataFrame:
    """The same for hot anchors, window by window."""
    word = F.split(F.col("words").cast("string"), " ")
    number = F.sequence(F.lit(0), F.size(word) - LENGTH)
    window = F.transform(number, lambda k: F.struct(k.alias("k"), F.array_join(F.slice(word, k + 1, LENGTH), " ").alias("window")))
    cut = rows.select("doc", "print", "begin", F.explode(window).alias("x")).select("doc", "print", "begin", "x.k", "x.window")
    cut = stored(cut.withColumn("place", F.struct("doc", "print", (F.col("begin") + F.col("k")).alias("at"))), "windows")
    least = cut.groupBy("window").agg(F.min("place").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    marked = cut.join(least, "window", "left")
    bit = F.when(F.col("place") > F.col("least"), F.expr("shiftleft(1L, k)")).otherwise(F.lit(0).cast("long"))
    return marked.groupBy("doc", "print", "begin").agg(F.bit_or(bit).alias("bits"))


def entries(docs: DataFrame, seen) -> DataFrame:
    """The earliest copies of all stretches that pass the filter (document, text digest, first window), with their repeated windows as bits."""
    place = F.min(F.struct("doc", "print", "begin")).alias("place")
    library = stored(_shared(docs, seen).groupBy("anchor", "words").agg(place).select("anchor", "words", "place.*"), "stretches")
    hot = library.groupBy("anchor").count().filter(F.col("count") > HOT).select("anchor")
    words = library.agg(F.sum(F.octet_length("words") - F.octet_length(F.replace(F.col("words").cast("string"), F.lit(" "), F.lit(""))) + 1)).first()[0] or 0
    shards = -(-words // SHARD_WORDS) or 1
    cold = _by_index(library.join(hot, "anchor", "left_anti"), shards)
    return stored(cold.unionByName(_by_group(library.join(hot, "anchor", "left_semi"))), "repeats")


KEPT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])


def _remover(seen):
    """Cuts a text by the entries of its row. A stretch that passes the filter and has no entry repeats an earlier one as a whole."""

    @F.arrow_udf(KEPT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, begins, bits in batches:
            rows = []
            for number, chunk in chunks(texts):
                found = Stretches(chunk)
                found.only(bloom.passes(seen.value, found.anchor))
                bounds = np.searchsorted(found.text, np.arange(len(chunk) + 1))
                for n, data in enumerate(found.texts):
                    words = data.split(b" ") if data else []
                    own = slice(bounds[n], bounds[n + 1])
                    first, last = found.first[own] - found.begins[n], found.last[own] - found.begins[n]
                    known = dict(zip(begins[number + n].as_py() or (), bits[number + n].as_py() or ()))
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    for a, b in zip(first.tolist(), last.tolist()):
                        marks = known.get(a)
                        if marks is None:
                            gone[a] += 1
                            gone[b + LENGTH] -= 1
                        else:
                            for k in range(b - a + 1 if marks else 0):
                                if marks >> k & 1:
                                    gone[a + k] += 1
                                    gone[a + k + LENGTH] -= 1
                    keep = np.cumsum(gone[:-1]) == 0
                    kept = words if keep.all() else list(compress(words, keep.tolist()))
                    rows.append({"n_words": len(words), "n_removed": len(words) - len(kept), "kept": b" ".join(kept).decode()})
            yield pa.array(rows, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))

    return cut


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "cleaned") -> DataFrame:
    """``docs`` with a struct column ``into``: n_words, n_removed, and the kept words joined by one space."""
    context = docs.sparkSession.sparkContext
    doc, print_, begins, bits = (fresh(docs, n) for n in ("doc_key", "text_print", "stretch_begins", "stretch_bits"))
    content = docs[text].cast("string")
    keyed = docs.withColumns({doc: F.coalesce(docs[doc_id].cast("long"), F.lit(BEFORE_ALL)), print_: F.unhex(F.md5(F.coalesce(content, F.lit("")).cast("binary")))})
    texts = keyed.select(content.alias("text"), F.col(doc).alias("doc"), F.col(print_).alias("print"))
    often = _anchors(texts).groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    seen = context.broadcast(bloom.of_keys(often, "anchor"))
    lists = entries(texts, seen).groupBy(F.col("doc").alias(doc), F.col("print").alias(print_)).agg(F.collect_list(F.struct("begin", "bits")).alias(begins))
    joined = keyed.join(lists, [doc, print_], "left")
    x = F.col(begins)
    return joined.withColumn(into, _remover(seen)(content, x["begin"], x["bits"])).select(*docs.columns, into)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    x = F.col("cleaned")
    return cleaned.select("doc_id", x["n_words"].alias("n_words"), x["n_removed"].alias("n_removed"), F.sha2(x["kept"].cast("binary"), 256).alias("kept_sha256"))
