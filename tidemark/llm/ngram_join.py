"""Operator 9: Jaccard self-join of documents on word n-grams by vertical partitioning.

The global order of n-grams is that of their 64-bit hashes. It is cut into fragments, and a document's set with it.

- Candidates. Two sets of similarity t or more differ in at most D n-grams, and D follows from their sizes. Cut into more than
  D fragments, at least one fragment that is not empty is the same in both, provided one of them has more than D such
  fragments. So every set is filed under a key per fragment (a hash of the n-grams in it), with a number of fragments that
  depends on its class of sizes, and again with the number of the class below if a partner may lie there. The rare sets with
  too few fragments in use are also filed under their first n-grams in the global order, of which two similar sets share one.
  A document that has fewer keys in common with others than with any similar set is left out, and of its keys only the rarest
  are compared, as many as a shared one must be among: keys of passages in very many documents rarely are.
- Partial overlaps. The sets of candidates are cut into ``PARTS`` fragments; overlaps are counted per pair and fragment by
  joins and summed per pair. Memory follows a fragment, not a set.
- Groups of near copies. Equal sets are one node from the start. Under a key, nodes are first compared with one centre, and each node
  with one of the centres of its keys, so a group of g near copies costs g pairs; linked nodes form components, and only nodes that share a key but no component yet
  are compared further, with other centres and finally each with each, unless their sizes or the common bits of two short bit
  sketches already rule them out. A pair that shares many keys is made under the busiest alone, as far as the ``FIRST`` busiest keys of
  both tell. No pair that could join components is left out.

The keys that more than one row has pass through a Bloom filter of fixed size, and so do the nodes whose sets are needed: a
false positive costs time and changes nothing. Equal 64-bit hashes count as equal n-grams.

Defined cases: null or empty text has an empty set, links with nothing and is its own component. Fewer words than ``N`` are one
n-gram. Rows without an id take part; a component's id is its smallest id, null if it has none. Rows that repeat an id are rows
like others. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm import bloom
from tidemark.llm.common import keep, stored, table
from tidemark.llm.components import components, tasks_for
from tidemark.llm.hashing import SEED, chunks, mix, word_hashes

N, PERCENT, PARTS = 4, 85, 8
#: Sizes in one class differ by less than this factor.
CLASS = 1.6
#: Rounds with one centre per key before pairs are compared each with each.
CENTRES = 4
SKETCH_BITS = 1024
#: Busiest keys of a node that tell whether a pair is met under an earlier key too.
FIRST = 32
#: Partners of a centre that are compared in one task.
PER_SALT = 1000
#: Nodes that a task remembers to have given, so that copies are sent once.
REMEMBERED = 1 << 20


def sets_of(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of many texts: text number and hash, ordered by both."""
    joined = b"\n".join(t.lower() for t in texts)
    start, words = word_hashes(np.frombuffer(joined, dtype=np.uint8))
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, start, side="right")
    counts = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(counts) - counts
    grams = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
    for k in range(n):
        grams = mix(grams * SEED + words[k : k + len(grams)])
    whole = doc[: len(grams)] == doc[n - 1 :] if len(grams) else np.zeros(0, dtype=bool)
    owners, values = [doc[: len(grams)][whole]], [grams[whole]]
    for size in range(1, n):  # short texts are one n-gram
        of = np.flatnonzero(counts == size)
        value = np.full(len(of), size, dtype=np.uint64)
        for k in range(size):
            value = mix(value * SEED + words[first[of] + k])
        owners.append(of)
        values.append(value)
    doc, grams = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((grams, doc))
    doc, grams = doc[order], grams[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (grams[1:] != grams[:-1])
    return doc[new], grams[new]


def differing(size: int | np.ndarray, percent: int):
    """Most n-grams in which a set of ``size`` and one at least as large can differ: |x| + |y| - 2 |x and y|, |y| <= |x| / t."""
    larger = size * 100 // percent
    return np.floor((100 - percent) * (size + larger) / (100 + percent) + 1e-9).astype(np.int64)


@lru_cache(maxsize=4)
def classes(percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per class of sizes its first size, the differences to allow and the number of fragments."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, int(starts[-1] * CLASS)))
    starts = np.array(starts, dtype=np.int64)
    allowed = differing(starts[1:] - 1, percent)
    return starts[:-1], allowed, np.where(allowed == 0, 1, allowed + 3 + allowed // 4)


def keys_of(grams: np.ndarray, percent: int) -> list[tuple[np.ndarray, int]]:
    """The keys under which one sorted set is filed, and how many of them every similar set must have too: differing n-grams
    can change so many fragments at most, and the others are the same."""
    size = len(grams)
    starts, allowed, fragments = classes(percent)
    own = int(np.searchsorted(starts, size, side="right")) - 1
    out = []
    high = grams >> np.uint64(32)
    mixed = mix(grams ^ SEED)
    for role in (own, own - 1):
        # a partner in the class below has starts[own] - 1 n-grams at most
        if role < 0 or role < own and percent * size > 100 * (starts[own] - 1):
            continue
        at = (high * np.uint64(fragments[role])) >> np.uint64(32)
        new = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        tag = mix(at[new] + np.uint64(role << 40) + np.uint64(1))
        changed = differing(size, percent) if role == own else (100 - percent) * (size + starts[own] - 1) // (100 + percent)
        out.append((mix(np.add.reduceat(mixed, new) ^ tag), max(0, len(new) - int(changed))))
        if len(new) <= allowed[role]:
            prefix = size - -(-percent * size // 100) + 1
            out.append((mix(grams[:prefix] ^ mix(np.array([role + (1 << 60)], dtype=np.uint64))), 0))
    return out


def _nodes(doc: np.ndarray, grams: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text the place of its set in ``grams``, its size, and the hash of the set."""
    sizes = np.bincount(doc, minlength=texts)
    first = np.cumsum(sizes) - sizes
    sums = np.zeros(len(grams) + 1, dtype=np.uint64)
    np.cumsum(mix(grams + SEED), out=sums[1:])
    return first, sizes, mix((sums[first + sizes] - sums[first]) ^ mix(sizes.astype(np.uint64) + np.uint64(7))).astype(np.int64)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _sketch(grams: np.ndarray) -> np.ndarray:
    """A bit for every n-gram, as longs."""
    bits = np.zeros(SKETCH_BITS, dtype=np.uint8)
    bits[(grams % np.uint64(SKETCH_BITS)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.int64)


def _may_be_similar(percent: int):
    """No two similar sets fail this: an overlap is at most the common bits, and the n-grams of one set that share a bit."""

    def ones(longs):
        return F.aggregate(longs, F.lit(0).cast("long"), lambda total, x: total + F.bit_count(x))

    common = ones(F.zip_with("sketch_x", "sketch_y", lambda a, b: a.bitwiseAND(b)))
    shared = F.least(F.col("size_x") - ones(F.col("sketch_x")), F.col("size_y") - ones(F.col("sketch_y")))
    return (100 + percent) * (common + shared) >= percent * (F.col("size_x") + F.col("size_y"))


def _filed(docs: DataFrame, n: int, percent: int, filter_=None) -> DataFrame:
    """doc_id, size, node and the keys of every row, of these only what passes the filter."""

    def run(batches):
        for batch in batches:
            for first, texts in chunks(batch.column(1)):
                doc, grams = sets_of(texts, n)
                start, sizes, node = _nodes(doc, grams, len(texts))
                groups, owner, slot = [], [], []
                for n_, (s, size) in enumerate(zip(start.tolist(), sizes.tolist())):
                    own = keys_of(grams[s : s + size], percent) if size else []
                    groups += own
                    owner += [n_] * len(own)
                    slot += range(len(own))
                flat = _signed(np.concatenate([np.zeros(0, dtype=np.uint64), *(keys for keys, _ in groups)]))
                group = np.repeat(np.arange(len(groups)), [len(keys) for keys, _ in groups])
                owner, slot, limit = (np.array(x, dtype=np.int64) for x in (owner, slot, [0] * len(groups)))
                if filter_ is not None:
                    ok = bloom.passes(filter_.value, flat)
                    enough = np.bincount(group[ok], minlength=len(groups)) >= np.array([need for _, need in groups], dtype=np.int64)
                    ok &= enough[group] if len(group) else ok
                    flat, group = flat[ok], group[ok]
                left = np.bincount(group, minlength=len(groups))
                needs = np.array([need for _, need in groups], dtype=np.int64)
                limit = np.where(needs > 0, left - needs + 1, left)
                lengths = np.bincount(owner[group] if len(group) else group, minlength=len(texts))
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)),
                        pa.array(sizes, pa.int64()),
                        pa.array(node, pa.int64(), mask=sizes == 0),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64())),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(slot[group], pa.int32())),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(limit[group], pa.int32())),
                        pa.array([_sketch(grams[s : s + n_]) if used else None for s, n_, used in zip(start, sizes, lengths)], pa.list_(pa.int64())),
                    ],
                    ["doc_id", "n_shingles", "node", "keys", "sets", "limits", "sketch"],
                )

    return docs.mapInArrow(run, "doc_id long, n_shingles long, node long, keys array<long>, sets array<int>, limits array<int>, sketch array<long>")


def _rarest(filed: DataFrame) -> DataFrame:
    """(key, node): of each set of keys the rarest, so many that two similar documents still share one of them.

    Of the keys of a set at least ``need`` are shared with every similar document. In one order of all keys, here by frequency,
    both have a shared key among all but the last ``need`` - 1 of theirs. Keys of a common passage come last.
    """
    frequency = filed.groupBy("key").agg(F.count("*").alias("df"))
    place = F.row_number().over(Window.partitionBy("node", "set").orderBy("df", "key"))
    ranked = filed.join(frequency, "key").withColumn("place", place)
    return ranked.filter((F.col("place") <= F.col("limit")) & (F.col("df") > 1)).select("key", "node").distinct()


def _parts(docs: DataFrame, n: int, filter_) -> DataFrame:
    """(node, part, size, grams) of the rows whose node passes the filter; a task gives the copies it meets once."""

    def run(batches):
        given: set[int] = set()
        for batch in batches:
            for _, texts in chunks(batch.column(1)):
                doc, grams = sets_of(texts, n)
                start, sizes, node = _nodes(doc, grams, len(texts))
                rows = []
                for d in np.flatnonzero((sizes > 0) & bloom.passes(filter_.value, node)):
                    name = int(node[d])
                    if name in given:
                        continue
                    if len(given) < REMEMBERED:
                        given.add(name)
                    own = grams[start[d] : start[d] + sizes[d]]
                    cuts = np.searchsorted(own >> np.uint64(61), np.arange(PARTS + 1, dtype=np.uint64))
                    rows += [(name, p, int(sizes[d]), _signed(own[cuts[p] : cuts[p + 1]])) for p in range(PARTS)]
                if rows:
                    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], ["node", "part", "size", "grams"])

    return docs.mapInArrow(run, "node long, part int, size long, grams array<long>")


def _linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that are similar: partial overlaps per fragment, summed per pair.

    ``pairs`` names one of the two as centre. The fragments of a centre are dealt once for every ``PER_SALT`` partners it has.
    """
    salts = pairs.groupBy("centre").agg(F.ceil(F.count("*") / PER_SALT).cast("int").alias("salts"))
    partner = F.when(F.col("centre") == F.col("u"), F.col("v")).otherwise(F.col("u"))
    left = pairs.join(salts, "centre").withColumn("node", partner).join(parts, "node")
    left = left.withColumn("salt", F.pmod(F.xxhash64("node"), "salts").cast("int")).drop("node", "salts")
    right = parts.join(salts.withColumnRenamed("centre", "node"), "node").select(
        F.col("node").alias("centre"), "part", F.col("size").alias("size_c"), F.col("grams").alias("grams_c"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt")
    )
    both = left.join(right, ["centre", "part", "salt"])
    overlap = both.select("u", "v", (F.col("size") + F.col("size_c")).alias("sizes"), F.size(F.array_intersect("grams", "grams_c")).alias("o"))
    summed = overlap.groupBy("u", "v", "sizes").agg(F.sum("o").alias("o"))
    return summed.filter(100 * F.col("o") >= percent * (F.col("sizes") - F.col("o"))).select("u", "v")


def _few(kept: DataFrame) -> tuple[DataFrame, int]:
    """A stored table of short rows in as many partitions as its rows need, and their number."""
    rows = kept.count()
    return kept.coalesce(tasks_for(rows)), rows


def _each_with_each(now: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(x, rx, y, ry) of the nodes of two roots that share a key of ``now`` (distinct key, node, root) and may be similar.

    Near copies share many keys. In one order of all keys, those of most nodes first, a pair is made under a key only if none of the keys
    before it is common; of these a node shows ``FIRST`` at most. The first common key always makes the pair.
    """
    busy = now.groupBy("key").agg((-F.count("*")).alias("at"))
    placed = now.join(busy, "key").withColumn("place", F.struct("at", "key"))
    first = placed.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("place")), 1, FIRST).alias("first"))
    before = F.transform(F.filter("first", lambda p: p < F.col("place")), lambda p: p["key"])
    known = placed.join(first, "node").join(sketches, "node").select("key", "node", "root", "size", "sketch", before.alias("before"))
    names = ("node", "root", "size", "sketch", "before")
    left, right = (known.select("key", *(F.col(c).alias(a) for c, a in zip(names, as_))) for as_ in (("x", "rx", "size_x", "sketch_x", "before_x"), ("y", "ry", "size_y", "sketch_y", "before_y")))
    near = (F.col("x") < F.col("y")) & (F.col("rx") != F.col("ry")) & (100 * F.least("size_x", "size_y") >= percent * F.greatest("size_x", "size_y"))
    return left.join(right, "key").filter(near & ~F.arrays_overlap("before_x", "before_y") & _may_be_similar(percent))


def _merged(root: DataFrame | None, links: DataFrame, n_links: int, n_all: int) -> DataFrame:
    """(node, root) after ``n_links`` further links, ``n_all`` in all: only the roots that they touch are joined up anew."""
    if root is None:
        return components(links, n_links)
    ends = links
    for end in ("u", "v"):
        name = root.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        ends = ends.join(name, end, "left").withColumn(end, F.coalesce(f"{end}_root", end)).drop(f"{end}_root")
    moved = components(ends.select("u", "v").coalesce(tasks_for(n_links)), n_links)
    fresh = moved.join(root, "node", "left_anti").select("node", F.col("node").alias("root"))
    to = moved.select(F.col("node").alias("root"), F.col("root").alias("to"))
    named = root.unionByName(fresh).join(to, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
    return keep(named.coalesce(tasks_for(2 * n_all)))


def _roots(filed: DataFrame, sketches: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(node, root) of linked nodes, such that every two similar ones have one root; ``filed``: distinct (key, node, set, limit).

    A turn in which no pair is left to compare, or none of the compared is similar, leaves roots and keys as they are.
    """
    context = docs.sparkSession.sparkContext
    filed = _rarest(filed)
    ends = filed.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    filed = stored(filed.join(ends.select("key"), "key"), "keys")
    chosen = context.broadcast(bloom.of_keys(filed.select("node").distinct(), "node"))
    parts = keep(_parts(docs, n, chosen).repartition("node").dropDuplicates(["node", "part"]))
    chosen.destroy()  # what it picked is stored
    root, done, n_all = None, None, 0
    now = filed.withColumn("root", F.col("node"))
    for turn in range(CENTRES + 1):
        if turn < CENTRES:
            # at first the same centre for the keys of a group, then another one for every key and turn
            by = [F.col("node"), F.lit(turn)] + ([F.col("key")] if turn else [])
            pick = F.min_by(F.struct("node", "root"), F.xxhash64(*by))
            centre = now.groupBy("key").agg(pick.alias("c"))
            other = now.join(centre, "key").select(F.col("c.node").alias("x"), F.col("c.root").alias("rx"), F.col("node").alias("y"), F.col("root").alias("ry"))
        else:
            other = _each_with_each(now, sketches, percent)
        other = other.filter("rx != ry").select("x", "y", F.least("x", "y").alias("u"), F.greatest("x", "y").alias("v"))
        if done is not None:
            other = other.join(done, ["u", "v"], "left_anti")
        if turn < CENTRES:
            # of the centres of its keys a node meets one in a turn: near copies share many keys, and mostly the first is enough
            other = other.groupBy("y").agg(F.min_by(F.struct("x", "u", "v"), F.xxhash64("x", F.lit(turn))).alias("p")).select("p.*")
        pairs, n_pairs = _few(keep(other.groupBy("u", "v").agg(F.min("x").alias("centre"))))
        if not n_pairs:
            continue
        compared = pairs.select("u", "v")
        done = compared if done is None else done.unionByName(compared)
        links, n_links = _few(keep(_linked(pairs, parts, percent)))
        if not n_links:
            continue
        n_all += n_links
        root = _merged(root, links, n_links, n_all)
        now = filed.join(root, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        mixed = now.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a < b").select("key")
        now = keep(now.join(mixed, "key"))
        if now.isEmpty():
            break
    return root if root is not None else docs.sparkSession.createDataFrame([], "node long, root long")


def join(docs: DataFrame, n: int = N, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the least id that links reach)."""
    docs = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    context = docs.sparkSession.sparkContext
    twice = _filed(docs, n, percent).select(F.explode("keys").alias("key")).groupBy("key").count().filter("count > 1")
    shared = context.broadcast(bloom.of_keys(twice, "key"))
    rows = keep(_filed(docs, n, percent, shared))
    shared.destroy()  # what it picked is stored
    each = F.explode(F.arrays_zip(F.col("keys").alias("key"), F.col("sets").alias("set"), F.col("limits").alias("limit"))).alias("k")
    filed = rows.select("node", each).select(F.col("k.key").alias("key"), "node", F.col("k.set").alias("set"), F.col("k.limit").alias("limit")).distinct()
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"))
    sketches = rows.filter("sketch is not null").select("node", F.col("n_shingles").alias("size"), "sketch").dropDuplicates(["node"])
    root = _roots(filed, sketches, docs, n, percent)
    rooted = keep(nodes.join(root, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")))
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(names, "root").select("node", "component_id")
    out = rows.select("doc_id", "n_shingles", "node").join(named, "node", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"))
