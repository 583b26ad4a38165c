"""A compressed FM-index over a text of numbered words, for many searches at a time.

The Burrows-Wheeler transform is kept in a wavelet tree whose shape follows the words' frequencies: a word of frequency f among n
lies at depth ceil(log2(n / f)), so all bit vectors together have about as many bits as the zero-order entropy of the text. A bit
vector is packed, with one count per 64 bits; a rank is one lookup and one population count. Suffixes are ordered by their first
``depth`` words only, which is all that patterns of fewer words can tell apart.
"""

from __future__ import annotations

import numpy as np

#: The end of each passage in a text; no pattern holds it.
END = 0


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes, ordered by at least their first ``depth`` symbols, by prefix doubling."""
    rank, known = text.astype(np.int64), 1
    while known < depth:
        ahead = np.zeros(len(rank), dtype=np.int64)
        ahead[: max(len(rank) - known, 0)] = rank[known:] + 1
        rank = np.unique(rank * (len(rank) + int(text.max(initial=0)) + 2) + ahead, return_inverse=True)[1]
        known *= 2
    return np.argsort(rank, kind="stable")


class Bits:
    """A packed bit vector with ranks."""

    def __init__(self, bits: np.ndarray) -> None:
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, dtype=np.uint32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        block = place >> 6
        rest = self.words[block] & ((np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[block] + np.bitwise_count(rest).astype(np.int64)


class WaveletTree:
    """Ranks of symbols in a sequence; the tree has the shape of a code by frequency."""

    def __init__(self, sequence: np.ndarray, symbols: int) -> None:
        n = len(sequence)
        f = np.maximum(np.bincount(sequence, minlength=symbols), 1)
        total = int(f.sum())
        self.length = np.maximum(np.ceil(np.log2(total / f)).astype(np.int64), 1)
        self.depth = int(self.length.max(initial=1))
        order = np.argsort(self.length, kind="stable")
        steps = np.int64(1) << (self.depth - self.length[order])
        self.code = np.zeros(symbols, dtype=np.int64)
        self.code[order] = np.cumsum(steps) - steps
        assert int(steps.sum()) <= 1 << self.depth
        self.levels: list[Bits] = []
        #: Per level and symbol: where its node starts, and the ones before that.
        self.start = np.zeros((self.depth, symbols), dtype=np.int32)
        self.skipped = np.zeros((self.depth, symbols), dtype=np.int32)
        now = sequence
        for level in range(self.depth):
            code = self.code[now]
            bit = (code >> (self.depth - level - 1)) & 1
            bits = Bits(bit.astype(np.uint8))
            self.levels.append(bits)
            node = code >> (self.depth - level)
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]])) if len(now) else np.zeros(0, dtype=np.int64)
            at = np.searchsorted(node[first], self.code >> (self.depth - level))
            begin = first[np.minimum(at, len(first) - 1)] if len(first) else np.zeros(symbols, dtype=np.int64)
            self.start[level] = begin
            self.skipped[level] = bits.ones(begin)
            # zeros of each node before its ones, both in order; symbols whose code ends here leave
            sizes = np.diff(np.concatenate([first, [len(now)]]))
            ones = np.concatenate([[0], np.cumsum(bit)])
            base = np.repeat(first, sizes)
            ones_in = ones[:-1] - ones[base] if len(now) else ones[:0]
            zeros = np.repeat(sizes - (ones[first + sizes] - ones[first]), sizes) if len(now) else ones[:0]
            place = np.arange(len(now))
            to = np.where(bit == 1, base + zeros + ones_in, place - ones_in)
            after = np.empty_like(now)
            after[to] = now
            now = after[self.length[after] > level + 1]

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        out = place.astype(np.int64)
        some = np.arange(len(out))
        for level, bits in enumerate(self.levels):
            some = some[self.length[symbol[some]] > level]
            if not len(some):
                break
            own = symbol[some]
            inner = out[some]
            ones = bits.ones(self.start[level][own] + inner) - self.skipped[level][own]
            bit = (self.code[own] >> (self.depth - level - 1)) & 1
            out[some] = np.where(bit == 1, ones, inner - ones)
        return out


class FMIndex:
    """Passages of numbered words (from 1), each followed by ``END``, to be searched backwards for patterns below ``depth`` words."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.text = text.astype(np.int64)
        symbols = int(self.text.max(initial=0)) + 1
        self.order = suffix_order(self.text, depth)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=symbols))])
        self.tree = WaveletTree(self.text[self.order - 1], symbols)

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of each symbol followed by the pattern that has the rows [low, high)."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + both[: len(symbol)], self.first[symbol] + both[len(symbol) :]

    def matching_statistics(self, end: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every place after a word of the text: how many words before it in its passage (at most ``most``) also occur elsewhere in
        the same order, and the rows of that match."""
        length = np.zeros(len(end), dtype=np.int64)
        low, high = np.zeros(len(end), dtype=np.int64), np.full(len(end), len(self.text), dtype=np.int64)
        some = np.arange(len(end))
        for step in range(1, most + 1):
            symbol = self.text[end[some] - step]
            some, symbol = some[symbol != END], symbol[symbol != END]
            if step == 1:
                new_low, new_high = self.first[symbol], self.first[symbol + 1]
            else:
                new_low, new_high = self.extend(symbol, low[some], high[some])
            more = new_high - new_low > 1
            some = some[more]
            low[some], high[some], length[some] = new_low[more], new_high[more], step
            if not len(some):
                break
        return length, low, high

    def least(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least value of the places in each range of rows; ranges are equal or apart."""
        if not len(low):
            return values[:0]
        begin, inverse = np.unique(low, return_inverse=True)
        end = np.zeros(len(begin), dtype=np.int64)
        end[inverse] = high
        row = np.concatenate([values[self.order], values[:1]])
        return np.minimum.reduceat(row, np.stack([begin, end], axis=1).ravel())[::2][inverse]
