"""Operator 7: pack documents into as few sequences of ``CAPACITY`` tokens as possible.

``cut`` tokenises every text, once, and gives one row per piece. The packing is planned on the histogram of piece lengths,
which has at most ``CAPACITY`` entries whatever the input: the configuration linear program (patterns of lengths that fill one
sequence) is solved by multiplicative weights, each pattern priced by a knapsack dynamic programme. In it neighbouring lengths
form groups that count as their longest. The fractional solution is rounded down and its slots are filled with pieces of their
groups; what is left goes by best fit into the gaps and into new sequences, a whole class of equal sequences at a time. The nth piece of a length, counted over all tasks, then finds its place in the plan by arithmetic.

Numbering needs no sort: each task counts its own pieces of a length while it makes them, the counts of the tasks are summed
up to offsets, and both are joined. The rows are stored before that, so a lost executor cannot renumber them.

Defined cases: null text is empty and is its end token alone; repeated rows are packed each for itself; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import keep, table

CAPACITY, END = 1024, 2
#: Most rounds and step of the multiplicative weights, and groups of lengths in the linear program.
ROUNDS, STEP, GROUPS = 3000, 0.1, 128
#: Share of the fractional solution that is used; the rest keeps short pieces for the gaps that rounding leaves.
SHARE = 0.6
#: Bytes that the dictionaries of known parts may take in one worker, with this for an entry besides its text and ids.
CACHED_BYTES, ENTRY_BYTES = 240 << 20, 180
DOUBLE = regex.compile(r" (?:\s|$)")


def byte_letters() -> dict[int, str]:
    """The letters that byte-level vocabularies write for bytes: printable ones for themselves, the others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


class Units:
    """Token ids of texts, from the ids of their parts between single spaces, kept in dictionaries of bounded size.

    The tokenizer's pattern always begins a new piece at a single space before another character, and merges never cross a
    piece, so parts can be encoded apart. Parts with white space at their start stay with the part before. Ids are kept as
    little-endian bytes, so that those of a text are one concatenation.
    """

    def __init__(self, path: str, pattern: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.merge = tokenizer.model.tokenize
        self.added = {t.content: struct.pack("<I", n) for n, t in tokenizer.get_added_tokens_decoder().items()}
        # the library cuts a text at the strings of added tokens first
        self.cuts = regex.compile("|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        self.pieces_of = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.held = 0

    def remember(self, into: dict[str, bytes], text: str, ids: bytes) -> None:
        """Keep the ids of a short text. At half of the bound what is known becomes the older half; parts that come again move on."""
        if len(text) <= 64:
            into[text] = ids
            self.held += len(text) + len(ids) + ENTRY_BYTES

    def bound(self) -> None:
        if self.held > CACHED_BYTES // 2:
            self.known, self.older, self.held = {}, self.known, 0
            self.pieces.clear()

    def merged(self, piece: str) -> bytes:
        tokens = self.merge(piece.encode().decode("latin-1").translate(self.letters))
        return struct.pack(f"<{len(tokens)}I", *(t.id for t in tokens))

    def piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.merged(piece)
            self.remember(self.pieces, piece, ids)
        return ids

    def word(self, word: str) -> bytes:
        """A word after a space; it is known as a part, not once more as a piece."""
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word) or self.merged(" " + word)
            self.remember(self.known, word, ids)
        return ids

    def unit(self, part: str) -> bytes:
        """A part after its space; a Latin word, with or without a mark at its end, needs no pattern."""
        if max(part) < "\u0250":
            if part.isalpha():
                return self.merged(" " + part)
            if part[-1] in ".,;:!?" and part[:-1].isalpha():
                return self.word(part[:-1]) + self.piece(part[-1])
        return self.split(" " + part)

    def split(self, text: str) -> bytes:
        return b"".join(map(self.piece, self.pieces_of(text)))

    def encode(self, text: str) -> np.ndarray:
        out, start = [], 0
        for cut_ in self.cuts.finditer(text):
            out += [self.plain(text[start : cut_.start()]), self.added[cut_.group()]]
            start = cut_.end()
        out.append(self.plain(text[start:] if start else text))
        return np.frombuffer(b"".join(out), dtype="<u4")

    def plain(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        parts = text.split(" ")
        if DOUBLE.search(text):
            joined = parts[:1]
            for part in parts[1:]:
                if not part or part[0].isspace():
                    joined[-1] += " " + part
                else:
                    joined.append(part)
            parts = joined
        rest = parts[1:]
        ids = list(map(self.known.get, rest))
        if None in ids:
            for n, part in enumerate(rest):
                if ids[n] is None:
                    ids[n] = self.older.get(part) or (self.unit(part) if part else self.split(" "))
                    self.remember(self.known, part, ids[n])
        out = self.split(parts[0]) + b"".join(ids)
        self.bound()
        return out


@lru_cache(maxsize=2)
def units(path: str, pattern: str) -> Units:
    return Units(path, pattern)


def cut(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, and its number among the task's pieces of that length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, task, seen = units(path, pattern), TaskContext.get().partitionId(), np.zeros(CAPACITY + 1, dtype=np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for key, body in zip(batch.column(0), batch.column(1)):
                ids = np.append(tokens.encode(body.as_py() or ""), np.array([END], dtype="<u4"))
                start, upto = 0, len(ids) % CAPACITY or CAPACITY
                for piece in range(-(-len(ids) // CAPACITY)):
                    length = upto - start
                    rows.append((key.as_py(), piece, start, length, zlib.crc32(ids[start:upto].tobytes()), task, int(seen[length])))
                    seen[length] += 1
                    start, upto = upto, upto + CAPACITY
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"
    return docs.select(docs[doc_id].cast("long"), docs[text].cast("string")).mapInArrow(run, schema)


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> dict[int, int]:
    """The pattern of greatest value: index into ``lengths`` to copies. ``lengths`` ascend."""
    best = np.zeros(capacity + 1)
    last = np.full(capacity + 1, -1, dtype=np.int64)
    fitting = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        n = fitting[room]
        if n:
            total = best[room - lengths[:n]] + values[:n]
            top = int(total.argmax())
            if total[top] > best[room]:
                best[room], last[room] = total[top], top
    pattern: dict[int, int] = defaultdict(int)
    room = capacity
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[int(last[room])] += 1
            room -= int(lengths[last[room]])
    return dict(pattern)


def grouped(lengths: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Neighbouring lengths in ``GROUPS`` groups of about as many pieces each, so that no rare length slows the weights down."""
    bounds = np.cumsum(counts) * GROUPS // (counts.sum() + 1)
    return [np.flatnonzero(bounds == g) for g in np.unique(bounds)]


def fractional(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], float]]:
    """Patterns and how often each is used, covering ``demand`` of each length: multiplicative weights.

    A length weighs less the more of its demand is covered; each round prices the best pattern under these weights and uses it
    until ``STEP`` of some length's demand is covered. The sum is scaled so that the least covered length is just covered.
    """
    covered = np.zeros(len(lengths))
    used: dict[tuple, float] = defaultdict(float)
    for _ in range(ROUNDS):
        if covered.min() >= 1:
            break
        weights = np.exp(-(covered - covered.min()) / STEP)
        pattern = knapsack(lengths, weights / demand, capacity)
        times = STEP * min(demand[i] / copies for i, copies in pattern.items())
        for i, copies in pattern.items():
            covered[i] += times * copies / demand[i]
        used[tuple(sorted(pattern.items()))] += times
    scale = 1 / max(covered.min(), STEP)
    return sorted(((dict(p), times * scale) for p, times in used.items()), key=lambda x: (-x[1], sorted(x[0].items())))


def filled(pattern: list[int], count: int, stock: list[list[list[int]]]) -> list[tuple[dict[int, int], int]]:
    """``count`` sequences with a piece of each group in ``pattern``, as classes of equal lengths, taken from ``stock``."""
    classes = []
    while count:
        takes: dict[int, int] = defaultdict(int)
        wanted: dict[tuple[int, int], int] = defaultdict(int)
        for group in pattern:  # of each group the longest left, in as many sequences as it lasts for
            at = len(stock[group]) - 1
            while wanted[group, at] + 1 > stock[group][at][1]:
                at -= 1
            wanted[group, at] += 1
            takes[stock[group][at][0]] += 1
        now = min(count, *(stock[g][at][1] // n for (g, at), n in wanted.items() if n))
        for (g, at), n in wanted.items():
            stock[g][at][1] -= n * now
        for group in set(pattern):
            while stock[group] and not stock[group][-1][1]:
                stock[group].pop()
        classes.append((dict(takes), now))
        count -= now
    return classes


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length to copies) and the number of sequences filled with each, using every piece exactly once."""
    classes = [({capacity: 1}, histogram[capacity])] if histogram.get(capacity) else []
    lengths = np.array(sorted(x for x in histogram if x < capacity), dtype=np.int64)
    if not len(lengths):
        return classes
    counts = np.array([histogram[int(x)] for x in lengths], dtype=np.int64)
    groups = grouped(lengths, counts)
    stock = [[[int(lengths[i]), int(counts[i])] for i in g] for g in groups]
    left = [int(counts[g].sum()) for g in groups]
    for pattern, times in fractional(np.array([lengths[g[-1]] for g in groups]), np.array(left, dtype=float), capacity):
        count = min([int(SHARE * times + 1e-9), *(left[g] // copies for g, copies in pattern.items())])
        if count:
            classes += filled([g for g, copies in pattern.items() for _ in range(copies)], count, stock)
            for g, copies in pattern.items():
                left[g] -= copies * count
    gaps: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    for pattern, count in classes:
        gaps[capacity - sum(x * copies for x, copies in pattern.items())].append((pattern, count))
    for length, rest in sorted((tuple(x) for group in stock for x in group), reverse=True):
        while rest:
            gap = min((g for g, waiting in gaps.items() if g >= length and waiting), default=None)
            if gap is None:
                per = capacity // length
                for copies, count in ((per, rest // per), (rest % per, 1)):
                    if copies and count:
                        gaps[capacity - copies * length].append(({length: copies}, count))
                rest = 0
            else:
                pattern, count = gaps[gap].pop()
                now = min(count, rest)
                if now < count:
                    gaps[gap].append((pattern, count - now))
                gaps[gap - length].append((pattern | {length: pattern.get(length, 0) + 1}, now))
                rest -= now
    return [x for g in sorted(gaps) for x in gaps[g]]


def places(classes: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """Per length rows of (first piece, sequences, first sequence, first offset), ascending by first piece."""
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    given: dict[int, int] = defaultdict(int)
    base = 0
    for pattern, count in classes:
        offset = 0
        for length, copies in sorted(pattern.items(), reverse=True):
            rows[length].append((given[length], count, base, offset))
            given[length] += copies * count
            offset += copies * length
        base += count
    return {length: np.array(r, dtype=np.int64) for length, r in rows.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset. ``pieces`` needs length, task and nth, and is read twice: pass a stored table."""
    counts = keep(pieces.groupBy("length", "task").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    by_length = places(plan(histogram, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    numbered = pieces.join(counts.select("length", "task", before.alias("before")), ["length", "task"])
    numbered = numbered.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))

    def run(frames):
        for frame in frames:
            sequence, offset = np.zeros(len(frame), dtype=np.int64), np.zeros(len(frame), dtype=np.int64)
            for length, at in frame.groupby("length").indices.items():
                table_, rank = by_length[length], frame["rank"].to_numpy()[at]
                row = table_[np.searchsorted(table_[:, 0], rank, side="right") - 1]
                nth = rank - row[:, 0]
                sequence[at] = row[:, 2] + nth % row[:, 1]
                offset[at] = row[:, 3] + nth // row[:, 1] * length
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return numbered.mapInPandas(run, schema)


def best_fit(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Tokenise, cut and pack."""
    return pack(keep(cut(docs, path, pattern)))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return best_fit(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
