"""Operator 5: byte-level BPE by tree reduction.

A piece is encoded as a tree: both halves of its bytes are encoded, then joined. A join encodes the bytes of a window of
tokens around the seam anew and keeps the tokens outside. That is proven right once the two pairs of tokens at the edges of
the window are stable, where a pair is stable if encoding its bytes alone gives that pair back: every run of tokens of a right
encoding is the right encoding of its bytes, and a sequence whose neighbours are all stable is the right encoding, since the
first merge across a border would also happen inside that pair alone. Until both edges are stable the window doubles. Decoding
concatenates halves up the tree.

Texts are split into pieces by the tokenizer's pattern and a piece that is a token by itself is that token, as the tokenizer's
library does. Long texts are cut before a single space between two other characters, where a piece always begins, so memory
follows the slice. Encoded pieces, parts and seams are kept in dictionaries of bounded size per worker.

Defined cases: null text is empty and has no tokens; equal texts give equal ids; an empty table gives an empty result; other
columns are ignored. Each row stands alone: nothing is shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import table

LEAF, DIRECT, CACHED, SLICE = 6, 48, 500_000, 1 << 20
CUT = regex.compile(r"\S(?= \S)")


def slices(text: str) -> Iterator[str]:
    """The text in parts that can be split into pieces one by one."""
    start = 0
    while len(text) - start > SLICE:
        found = CUT.search(text, start + SLICE)
        if not found:
            break
        yield text[start : found.end()]
        start = found.end()
    yield text[start:] if start else text


class BytePair:
    def __init__(self, ranks_path: str, pattern: str):
        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        white = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
        self.pieces_of = regex.compile(white).findall
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.parts: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def direct(self, data: bytes) -> tuple[int, ...]:
        """Merge the lowest rank first, the leftmost among equals."""
        ranks = self.ranks
        if len(data) > DIRECT:
            return self._direct_long(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _direct_long(self, data: bytes) -> tuple[int, ...]:
        """The same with a heap of pairs over a linked list."""
        n, ranks = len(data), self.ranks
        part = [data[i : i + 1] for i in range(n)]
        after, before, version = list(range(1, n + 1)), list(range(-1, n - 1)), [0] * n
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (rank := ranks.get(part[i] + part[j])) is not None:
                heapq.heappush(heap, (rank, i, version[i], version[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, own, other = heapq.heappop(heap)
            j = after[i]
            if version[i] != own or j >= n or version[j] != other:
                continue
            part[i] += part[j]
            version[i] += 1
            version[j] = -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        out, i = [], 0
        while i < n:
            out.append(ranks[part[i]])
            i = after[i]
        return tuple(out)

    def stable(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHED:
                self.pairs.clear()
            known = self.pairs[key] = self.direct(self.tokens[left] + self.tokens[right]) == key
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The monoid: the encoding of the bytes of ``left`` followed by those of ``right``."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        wide_left = wide_right = 1
        while True:
            wide_left, wide_right = min(wide_left, len(left)), min(wide_right, len(right))
            window = left[len(left) - wide_left :] + right[:wide_right]
            middle = self.short(b"".join(map(self.tokens.__getitem__, window)))
            left_done = wide_left == len(left) or self.stable(left[-wide_left - 1], middle[0])
            right_done = wide_right == len(right) or self.stable(middle[-1], right[wide_right])
            if left_done and right_done:
                return left[: len(left) - wide_left] + middle + right[wide_right:]
            wide_left *= 1 if left_done else 2
            wide_right *= 1 if right_done else 2

    def short(self, data: bytes) -> tuple[int, ...]:
        """``direct``, remembered for short byte strings."""
        known = self.parts.get(data)
        if known is None:
            known = self.direct(data)
            if len(data) <= 2 * LEAF:
                if len(self.parts) >= CACHED:
                    self.parts.clear()
                self.parts[data] = known
        return known

    def tree(self, data: bytes) -> tuple[int, ...]:
        if len(data) <= LEAF:
            return self.short(data)
        half = len(data) // 2
        return self.join(self.tree(data[:half]), self.tree(data[half:]))

    def piece(self, piece: str) -> tuple[int, ...]:
        data = piece.encode()
        whole = self.ranks.get(data)
        ids = self.tree(data) if whole is None else (whole,)
        if len(data) <= 64:
            if len(self.pieces) >= CACHED:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a text."""
        out: list[np.ndarray] = []
        for part in slices(text):
            ids: list[int] = []
            for piece in self.pieces_of(part):
                ids += self.pieces.get(piece) or self.piece(piece)
            out.append(np.array(ids, dtype="<u4"))
        return np.concatenate(out)

    def decode(self, ids) -> bytes:
        if len(ids) <= 4096:
            return b"".join(map(self.tokens.__getitem__, ids))
        return self.decode(ids[: len(ids) // 2]) + self.decode(ids[len(ids) // 2 :])


@lru_cache(maxsize=2)
def tokenizer(ranks_path: str, pattern: str) -> BytePair:
    return BytePair(ranks_path, pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and the token ids of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks_path, pattern)
        for batch in batches:
            ids = pa.array([bpe.encode(t or "").astype("i4") for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and the bytes that the ids stand for; null ids are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks_path, pattern)
        for batch in batches:
            data = pa.array([bpe.decode(ids or []) for ids in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), data], ["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Encode, decode the ids, and keep digests of both, so that no ids travel between processes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(ranks_path, pattern)
        for batch in batches:
            counts, coded, decoded = [], [], []
            for text in batch.column(1):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                coded.append(hashlib.sha256(ids.tobytes()).hexdigest())
                decoded.append(hashlib.sha256(bpe.decode(ids.tolist())).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(run, schema)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
