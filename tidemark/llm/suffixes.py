"""Operator 10: remove repeated byte strings of ``LENGTH`` bytes, by sorting suffixes with comparisons through prefix hashes.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a smaller document, or earlier in the same text.

- Routing. A sort of all suffixes of a corpus in one order moves many times its bytes. Every window of ``LENGTH`` bytes is filed under
  its anchor, the ``GRAM`` bytes of least hash in it; neighbouring windows with one anchor are a stretch. Equal windows have
  equal anchors at equal places, so suffixes are sorted per anchor. Anchors seen once are dropped by a Bloom filter of fixed size,
  whose false positives change nothing. Equal stretches are kept once, with their earliest place; their bytes tell them apart.
- Sorting. The suffixes that start in the stretches of one anchor are sorted by a mergesort, all anchors of a shard at a time. Two
  suffixes are compared by binary search for their common extension, which equal hashes of prefixes of it show: the hash of any
  range is a difference of prefix polynomials. So a comparison takes a number of steps logarithmic in ``LENGTH``, and looks at one
  byte of each in the end. Runs are merged by binary search of each suffix in the other run.
- Reading off. Neighbours in the order whose common extension is ``LENGTH`` bytes are one class. Their bytes are compared before that
  is believed; where hashes have collided the stretches are compared by their bytes alone. The earliest place of a class stays.
- Hot anchors. The stretches of an anchor with more than ``HOT`` distinct ones are cut into pieces by where their windows have the
  anchor, and a piece is filed under all bytes that its windows must have: longer keys, of which few are hot still. Equal pieces are kept
  once, as stretches are. ``SPANS`` goes on to single windows, which are grouped by their bytes, so that no shard grows with the data.
- Disk. Tables that only one step needs go with it, as do the shuffled rows of a table that is stored.
- Copies of a stretch that are not the earliest go as a whole: the last pass finds the stretches of a text anew and takes those
  without an entry for copies.

Defined cases: null text is empty. Texts under ``LENGTH`` bytes lose nothing. Null ids come before all others. Rows of one id are
documents of their own, ordered by the MD5 of their text; rows equal in both are one document and keep the same bytes. Empty tables
give an empty result. ``remove`` adds one struct column and leaves the others as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import bloom
from tidemark.llm.common import fresh, scratch, stored, table
from tidemark.llm.hashing import SEED, chunks, mix, prefix_sums, ranges

LENGTH, GRAM = 100, 24
#: Windows that can share an anchor.
WIDE = LENGTH - GRAM + 1
#: Bytes of stretches whose suffixes are sorted together, and distinct stretches of an anchor that are.
SHARD_BYTES, HOT = 1 << 20, 1024
#: Neighbouring places of the anchor that the windows of a piece have, from cut to cut; at 1 a piece is one window.
SPANS = (39, 10, 1)
BEFORE_ALL = -(1 << 63)
#: Bits of a place in a text, or in the texts that a task reads together.
PLACE_BITS = np.uint64(32)
#: Neighbours whose bytes are compared at a time.
VERIFIED = 20_000


def sliding_least(values: np.ndarray, wide: int) -> np.ndarray:
    """Least of ``wide`` neighbours from every place on: minima from block starts and block ends meet."""
    n = len(values) - wide + 1
    padded = np.full(-(-len(values) // wide) * wide, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, wide)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[wide - 1 : wide - 1 + n])


def stretches(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Anchors with their windows: text number, anchor hash, first and last window, place of the anchor, start of the text (places in the joined texts)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    if not (sizes >= LENGTH).any():
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none, none, none
    sums = prefix_sums(data)
    places = np.arange(len(data) - GRAM + 1)
    grams = ranges(sums, places, places + GRAM)
    # least by the upper half of the hash, then leftmost: the same choice in equal windows, whatever they are read with
    anchor = sliding_least((grams >> PLACE_BITS << PLACE_BITS) | places.astype(np.uint64), WIDE) & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))
    inside = np.zeros(len(data) + 1, dtype=np.int64)
    long = sizes >= LENGTH
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - LENGTH + 1, -1)
    window = np.flatnonzero(np.cumsum(inside[: len(anchor)]) > 0)
    anchor = anchor[window].astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    last = np.concatenate([first[1:], [len(window)]]) - 1
    begin, stop, at = window[first], window[last], anchor[first]
    text = np.searchsorted(ends, at, side="right")
    return text, mix(grams[at] ^ SEED).view(np.int64), begin, stop, at, starts[text]


def _anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in chunks(batch.column(0)):
                anchor, n = np.unique(stretches(texts)[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pa.array(n, pa.int64())], ["anchor", "n"])

    return docs.select("text").mapInArrow(run, "anchor long, n long")


def _shared(docs: DataFrame, seen) -> DataFrame:
    """Stretches whose anchor passes the filter: anchor, its place in the stretch, bytes, and where they are: document, text digest and first window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, texts in chunks(batch.column(0)):
                found = stretches(texts)
                text, anchor, begin, stop, at, start = (x[bloom.passes(seen.value, found[1])] for x in found)
                spans = zip(text.tolist(), (begin - start).tolist(), (stop - start).tolist())
                data = pa.array([texts[t][b : e + LENGTH] for t, b, e in spans], pa.binary())
                rows = pa.array(number + text, pa.int64())
                columns = [pa.array(anchor, pa.int64()), pa.array(at - begin, pa.int64()), data, batch.column(1).take(rows), batch.column(2).take(rows), pa.array(begin - start, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "at", "bytes", "doc", "print", "begin"])

    return docs.select("text", "doc", "print").mapInArrow(run, "anchor long, at long, bytes binary, doc long, print binary, begin long")


class Suffixes:
    """Suffixes of joined passages, compared by their first ``LENGTH`` bytes."""

    def __init__(self, passages: list[bytes]) -> None:
        self.data = np.frombuffer(b"".join(passages), dtype=np.uint8)
        self.sums = prefix_sums(self.data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes, by binary search: the longest prefix with equal hashes."""
        low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), LENGTH, dtype=np.int64)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = ranges(self.sums, a, a + middle) == ranges(self.sums, b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether suffixes a sort before suffixes b, and whether they are equal."""
        n = self.common(a, b)
        equal = n == LENGTH
        at = np.where(equal, 0, n)
        return ~equal & (self.data[a + at] < self.data[b + at]), equal

    def verified(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether neighbours a, b are in order, and whether they are equal, by their bytes."""
        rows = np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)
        ordered, equal = np.ones(len(a), dtype=bool), np.ones(len(a), dtype=bool)
        for i in range(0, len(a), VERIFIED):
            x, y = rows[a[i : i + VERIFIED]], rows[b[i : i + VERIFIED]]
            differs = x != y
            at = differs.argmax(axis=1)
            n = np.arange(len(x))
            equal[i : i + VERIFIED] = ~differs[n, at]
            ordered[i : i + VERIFIED] = x[n, at] <= y[n, at]
        return ordered, equal

    def sort(self, suffix: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Suffixes in order within each group (groups ascend): runs of 1, 2, 4, ... are merged, all groups at a time."""
        out = suffix.copy()
        edge = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.concatenate([edge, [len(group)]]))
        start, length = np.repeat(edge, size), np.repeat(size, size)
        inner = np.arange(len(group)) - start
        width = 1
        while (some := np.flatnonzero(length > width)).size:
            pair = start[some] + inner[some] // (2 * width) * (2 * width)  # where the two runs begin
            middle = np.minimum(pair + width, start[some] + length[some])
            end = np.minimum(pair + 2 * width, start[some] + length[some])
            left = some < middle
            # each finds its place in the other run; equal ones of the left run come first
            low, high = np.where(left, middle, pair), np.where(left, end, middle)
            base = low.copy()
            while (open_ := np.flatnonzero(low < high)).size:
                probe = (low[open_] + high[open_]) >> 1
                smaller, equal = self.before(out[probe], out[some[open_]])
                after = smaller | equal & ~left[open_]
                low[open_], high[open_] = np.where(after, probe + 1, low[open_]), np.where(after, high[open_], probe)
            merged = out.copy()
            merged[some + (low - base) - np.where(left, 0, middle - pair)] = out[some]
            out, width = merged, 2 * width
        return out


def repeated(passages: list[bytes], anchors: np.ndarray, offsets: np.ndarray, places: list[tuple]) -> list[int]:
    """Per passage the windows, as bits of a number, that occur at an earlier place in one of the passages of its anchor.

    ``offsets``: where the anchor lies in a passage, ``places``: (document, ..., first window). Equal windows have their anchor at
    one place, so the suffixes of an anchor are sorted apart for every place that it has in them.
    """
    sizes = np.array([len(p) for p in passages], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    documents = {d: n for n, d in enumerate(sorted({p[:-1] for p in places}))}
    base = np.array([(documents[p[:-1]] << int(PLACE_BITS)) + p[-1] for p in places], dtype=np.int64)
    bits = [0] * len(passages)
    anchor = np.unique(anchors, return_inverse=True)[1]
    rivals = np.flatnonzero(np.bincount(anchor)[anchor] > 1)
    if not len(rivals):
        return bits
    windows = sizes[rivals] - LENGTH + 1
    passage = np.repeat(rivals, windows)
    number = np.arange(len(passage)) - np.repeat(np.cumsum(windows) - windows, windows)
    group = anchor[passage] * (WIDE + 1) + offsets[passage] - number
    order = np.argsort(group, kind="stable")
    group, suffix = group[order], (first[passage] + number)[order]
    suffixes = Suffixes(passages)
    suffix = suffixes.sort(suffix, group)

    passage = np.searchsorted(first, suffix, side="right") - 1
    number = suffix - first[passage]
    code = base[passage] + number
    inside = np.concatenate([[False], group[1:] == group[:-1]])
    near = np.flatnonzero(inside)
    ordered, equal = suffixes.verified(suffix[near - 1], suffix[near])
    same = np.zeros(len(suffix), dtype=bool)
    same[near] = equal
    edge = np.flatnonzero(~same)
    least = np.repeat(np.minimum.reduceat(code, edge), np.diff(np.concatenate([edge, [len(code)]])))
    for wrong in np.unique(group[near[~ordered]]).tolist():  # hashes have collided: by bytes alone
        own = np.flatnonzero(group == wrong)
        earliest: dict[bytes, int] = {}
        texts = [suffixes.data[p : p + LENGTH].tobytes() for p in suffix[own].tolist()]
        for text, c in zip(texts, code[own].tolist()):
            earliest[text] = min(earliest.get(text, c), c)
        least[own] = [earliest[t] for t in texts]
    for p, k in zip(passage[least < code].tolist(), number[least < code].tolist()):
        bits[p] |= 1 << k
    return bits


HALF = (1 << 63) - 1
#: Stretches or pieces of them: ``begin`` is the first window of the stretch, ``skip`` windows before that of the piece.
PIECE = ("anchor", "at", "bytes", "doc", "print", "begin", "skip")
FOUND = "doc long, print binary, begin long, bits long, more long"
#: Files of a table of hot anchors.
FILES = 8


def _by_sort(rows: DataFrame, several: DataFrame) -> DataFrame:
    """The repeated windows of each stretch, from the sorted suffixes of its shard: the first 63 and the others.

    ``several``: anchors with the bytes of their stretches.
    """
    size = several.agg(F.sum("size")).first()[0] or 0

    def run(table_: pa.Table) -> pa.Table:
        doc, print_, begin, skip = (table_[c].to_pylist() for c in ("doc", "print", "begin", "skip"))
        places = [(d, p, b + k) for d, p, b, k in zip(doc, print_, begin, skip)]
        found = repeated(table_["bytes"].to_pylist(), table_["anchor"].to_numpy(), table_["at"].to_numpy(), places)
        found = [bits << k for bits, k in zip(found, skip)]
        halves = [pa.array([b & HALF for b in found], pa.int64()), pa.array([b >> 63 for b in found], pa.int64())]
        names = ("doc", "print", "begin")
        return pa.Table.from_arrays([*(table_[c] for c in names), *halves], names=[*names, "bits", "more"])

    shard = F.pmod("anchor", F.lit(-(-size // SHARD_BYTES) or 1)).alias("shard")
    return rows.select(*PIECE).groupBy(shard).applyInArrow(run, FOUND)


def _counted(rows: DataFrame) -> DataFrame:
    """Anchors with several distinct stretches: how many, and their bytes."""
    return rows.groupBy("anchor").agg(F.count("*").alias("n"), F.sum(F.length("bytes")).alias("size")).filter("n > 1")


def _pieces(rows: DataFrame, span: int) -> DataFrame:
    """Pieces of stretches whose windows have the anchor at ``span`` neighbouring places, filed under a hash of the bytes that each of these windows has."""
    # a window with the anchor at place p is number at - p of the stretch
    least = F.col("at") - F.length("bytes") + LENGTH
    parts = F.explode(F.sequence(F.floor(least / span), F.floor(F.col("at") / span))).alias("part")
    cut = rows.select(*PIECE, least.alias("least"), parts)
    low, high = F.col("part") * span, F.col("part") * span + span - 1
    cut = cut.withColumns({"low": low, "high": F.least(high, F.lit(WIDE - 1)), "from": F.greatest("least", low), "to": F.least("at", high)})
    key = F.expr(f"substring(bytes, cast(at - low + 1 as int), cast(low - high + {LENGTH} as int))")
    piece = F.expr(f"substring(bytes, cast(at - to + 1 as int), cast(to - from + {LENGTH} as int))")
    first = F.col("at") - F.col("to")
    return cut.select(F.xxhash64("part", key).alias("anchor"), F.col("to").alias("at"), piece.alias("bytes"), "doc", "print", "begin", (F.col("skip") + first).alias("skip"))


def _whole(skip: Column, windows: Column) -> tuple[Column, Column]:
    """The bits of so many windows after the skipped ones, in two halves."""

    def below(n: Column) -> Column:
        return F.call_function("shiftright", F.lit(HALF), (63 - n).cast("int"))

    def half(n: Column) -> tuple[Column, Column]:
        return below(F.least(n, F.lit(63))), below(F.greatest(n - 63, F.lit(0)))

    (low, more), (low_end, more_end) = half(skip), half(skip + windows)
    return low.bitwiseXOR(low_end).alias("bits"), more.bitwiseXOR(more_end).alias("more")


def _by_pieces(hot: DataFrame, store: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The same for stretches of hot anchors, cut into pieces until few share a key."""
    none = F.lit(0).cast("long")
    found = hot.select("doc", "print", "begin", none.alias("bits"), none.alias("more"))
    for span in SPANS:
        cut = store(_pieces(hot, span), "pieces")
        place = F.struct("doc", "print", (F.col("begin") + F.col("skip")).alias("window"), "begin", "skip")
        first = cut.groupBy("anchor", "at", "bytes").agg(F.min(place).alias("least"), F.count("*").alias("copies"))
        first = store(first.select("anchor", "at", "bytes", "least.*", "copies"), "firsts")
        # a later copy repeats the first one as a whole
        named = [F.col(c).alias(f"{c}_") for c in ("doc", "print", "window")]
        later = cut.join(first.filter("copies > 1").select("anchor", "at", "bytes", *named), ["anchor", "at", "bytes"])
        later = later.filter(F.struct("doc", "print", F.col("begin") + F.col("skip")) > F.struct("doc_", "print_", "window_"))
        found = found.unionByName(later.select("doc", "print", "begin", *_whole(F.col("skip"), F.length("bytes") - LENGTH + 1)))
        several = store(_counted(first), "anchors")
        few = several if span == 1 else several.filter(F.col("n") <= HOT)  # of single windows only those with one hash
        found = found.unionByName(_by_sort(first.join(few.select("anchor"), "anchor"), few))
        most = several.filter(F.col("n") > HOT).select("anchor")
        if span == 1 or most.isEmpty():
            break
        hot = first.join(store(most.coalesce(FILES), "hot"), "anchor", "left_semi")
    return found.groupBy("doc", "print", "begin").agg(F.bit_or("bits").alias("bits"), F.bit_or("more").alias("more"))


def _rivals(library: DataFrame, shared, wanted: bool) -> DataFrame:
    """The stretches whose anchor passes the filter of anchors with several distinct ones, or else the places of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bloom.passes(shared.value, batch.column(0).to_numpy()) == wanted))

    columns = library.select(*PIECE) if wanted else library.select("anchor", "doc", "print", "begin")
    return columns.mapInArrow(run, columns.schema)


def entries(docs: DataFrame, seen) -> DataFrame:
    """The earliest copies of all stretches that pass the filter (document, text digest, first window), with their repeated windows as bits.

    A stretch that is the only distinct one of its anchor has no rival: it repeats nothing, and its bytes need not be moved again.
    """
    context = docs.sparkSession.sparkContext
    none = F.lit(0).cast("long")
    with scratch(docs.sparkSession) as store:
        place = F.min(F.struct("doc", "print", "begin")).alias("place")
        library = _shared(docs, seen).groupBy("anchor", "at", "bytes").agg(place)
        library = store(library.select("anchor", "at", "bytes", "place.*", none.alias("skip")), "stretches")
        several = store(_counted(library), "anchors")
        shared = context.broadcast(bloom.of_keys(several, "anchor"))
        hot = store(several.filter(F.col("n") > HOT).select("anchor").coalesce(FILES), "hot")
        rivals = _rivals(library, shared, True)
        alone = _rivals(library, shared, False).select("doc", "print", "begin", none.alias("bits"), none.alias("more"))
        found = _by_sort(rivals.join(hot, "anchor", "left_anti"), several.filter(F.col("n") <= HOT)).unionByName(alone)
        if not hot.isEmpty():
            found = found.unionByName(_by_pieces(store(rivals.join(hot, "anchor", "left_semi"), "crowded"), store))
        found = stored(found, "repeats")
        shared.destroy()  # what it picked is stored
    return found


def _cut(data: bytes, start: np.ndarray, stop: np.ndarray) -> tuple[int, int, bytes]:
    """Bytes removed, maximal runs removed and the bytes kept, for spans that may overlap."""
    if not len(start):
        return 0, 0, data
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(stop[order])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]]))
    begin, end = start[new], reach[np.concatenate([new[1:], [len(start)]]) - 1]
    pieces = [data[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(data)])]
    return int((end - begin).sum()), len(begin), b"".join(pieces)


KEPT = T.StructType(
    [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]
)


def _remover(seen):
    """Cuts a text by the entries of its row. A stretch that passes the filter and has no entry repeats an earlier one as a whole."""

    @F.arrow_udf(KEPT)
    def cut(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, begins, lows, highs in batches:
            rows = []
            for number, chunk in chunks(texts):
                found = stretches(chunk)
                text, _, begin, stop, _, start = (x[bloom.passes(seen.value, found[1])] for x in found)
                bounds = np.searchsorted(text, np.arange(len(chunk) + 1))
                for n, data in enumerate(chunk):
                    own = slice(bounds[n], bounds[n + 1])
                    known = {b: low | high << 63 for b, low, high in zip(*(x[number + n].as_py() or () for x in (begins, lows, highs)))}
                    gone = []
                    for a, z in zip((begin - start)[own].tolist(), (stop - start)[own].tolist()):
                        marks = known.get(a)
                        if marks is None:
                            gone.append((a, z + LENGTH))
                        elif marks:
                            gone += [(a + k, a + k + LENGTH) for k in range(z - a + 1) if marks >> k & 1]
                    spans = np.array(gone, dtype=np.int64).reshape(-1, 2)
                    n_removed, n_spans, kept = _cut(data, spans[:, 0], spans[:, 1])
                    rows.append({"n_bytes": len(data), "n_removed": n_removed, "n_spans": n_spans, "kept": kept})
            yield pa.array(rows, pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())]))

    return cut


@F.arrow_udf(T.StringType())
def readable(kept: pa.Array) -> pa.Array:
    """Kept bytes as text, without characters that were cut apart."""
    return pa.array([None if x.as_py() is None else x.as_py().decode("utf-8", "ignore") for x in kept], pa.string())


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", into: str = "cleaned") -> DataFrame:
    """``docs`` with a struct column ``into``: n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes."""
    context = docs.sparkSession.sparkContext
    doc, print_, known = (fresh(docs, n) for n in ("doc_key", "text_print", "entries"))
    content = docs[text].cast("string")
    keyed = docs.withColumns({doc: F.coalesce(docs[doc_id].cast("long"), F.lit(BEFORE_ALL)), print_: F.unhex(F.md5(F.coalesce(content, F.lit("")).cast("binary")))})
    texts = keyed.select(content.alias("text"), F.col(doc).alias("doc"), F.col(print_).alias("print"))
    with scratch(docs.sparkSession) as store:
        often = store(_anchors(texts).groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1").select("anchor"), "often")
        seen = context.broadcast(bloom.of_keys(often, "anchor"))
    lists = entries(texts, seen).groupBy(F.col("doc").alias(doc), F.col("print").alias(print_)).agg(F.collect_list(F.struct("begin", "bits", "more")).alias(known))
    joined = keyed.join(lists, [doc, print_], "left")
    x = F.col(known)
    return joined.withColumn(into, _remover(seen)(content, x["begin"], x["bits"], x["more"])).select(*docs.columns, into)


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    x = F.col("cleaned")
    return cleaned.select("doc_id", *(x[c].alias(c) for c in ("n_bytes", "n_removed", "n_spans")), F.sha2(x["kept"], 256).alias("kept_sha256"))
