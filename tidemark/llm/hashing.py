"""64-bit hashes of byte ranges from prefix sums: polynomials over random letters modulo 2**64, then mixed."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: A task hashes about so many bytes at a time; a longer text is hashed by itself.
CHUNK_BYTES = 1 << 20
SEED = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), wrapping."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


LETTERS = mix(np.arange(1, 257, dtype=np.uint64) * SEED)


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    up, down = np.full(size, BASE, dtype=np.uint64), np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _fitting(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(21, int(n).bit_length()))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums of letter * base**place before every place of an array of bytes."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(LETTERS[data] * _fitting(len(data))[0][: len(data)], out=sums[1:])
    return sums


def ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes in [start, end); equal bytes give equal hashes wherever they are."""
    return mix((sums[end] - sums[start]) * _fitting(len(sums))[1][start] + (end - start).astype(np.uint64) * SEED)


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Number of the first text, and texts as UTF-8, about ``most`` bytes at a time; null is empty."""
    first, out, size = 0, [], 0
    for n, value in enumerate(texts):
        out.append((value.as_py() or "").encode())
        size += len(out[-1])
        if size >= most:
            yield first, out
            first, out, size = n + 1, [], 0
    if out:
        yield first, out


WHITE = np.zeros(256, dtype=bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word in an array of bytes."""
    inside = ~WHITE[data]
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return start, ranges(prefix_sums(data), start, end)
