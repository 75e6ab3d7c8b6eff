"""Vectorised work on the bytes of many texts at once (numpy, inside tasks).

Texts come as Arrow string columns; a block is a slice of rows whose bytes
stand in one array. Blocks are bounded by ``BLOCK_BYTES`` (a longer text is a
block of its own), so a task's memory does not grow with its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21

U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    x *= U(0xD6E8FEB86659FD93)
    x ^= x >> U(32)
    return x


@dataclass
class Block:
    """Rows ``lo`` to ``hi`` of the column; ``offsets`` count from the block's first byte."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Split an Arrow string column into blocks; null texts are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, off, raw = texts.buffers()
    if n == 0:
        return
    offsets = np.frombuffer(off, dtype=kind)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Block(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


class RollingHash:
    """Hashes of any byte ranges of a block, from prefix sums modulo 2**64."""

    def __init__(self, seed: int):
        self.table = mix64(np.arange(256, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 2 + 1))
        self.base = int(mix64(np.array([seed + 77], dtype=U))[0]) | 5
        self._up = self._down = np.ones(1, dtype=U)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = max(n, BLOCK_BYTES + 1024)
            up, down = np.full(size, self.base, dtype=U), np.full(size, pow(self.base, -1, 1 << 64), dtype=U)
            up[0] = down[0] = 1
            up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
            if size > 4 * BLOCK_BYTES:  # a very long text: not kept
                return up[:n], down[:n]
            self._up, self._down = up, down
        return self._up[:n], self._down[:n]

    def prefix(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(data)
        up, down = self._powers(n + 1)
        sums = np.zeros(n + 1, dtype=U)
        np.cumsum(self.table[data] * up[:n], out=sums[1:])
        return sums, down

    @staticmethod
    def ranges(prefix: tuple[np.ndarray, np.ndarray], start: np.ndarray, end: np.ndarray) -> np.ndarray:
        sums, down = prefix
        return mix64((sums[end] - sums[start]) * down[start])


@dataclass
class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a block: byte ranges, and per text the first word and count."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    count: np.ndarray


def words(block: Block) -> Words:
    data, off = block.data, block.offsets
    n = len(data)
    solid = np.empty(n + 2, dtype=bool)
    solid[0] = solid[-1] = False
    solid[1:-1] = ~_SPACE[data]
    begins = solid[1:-1] & ~solid[:-2]
    ends = solid[1:-1] & ~solid[2:]
    inner = off[1:-1]
    inner = inner[(inner > 0) & (inner < n)]  # texts end words
    begins[inner] = solid[1:-1][inner]
    ends[inner - 1] = solid[1:-1][inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, off[:-1])
    count = np.searchsorted(start, off[1:]) - first
    return Words(start, end, first, count)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hashes of every ``n`` neighbours (also across texts: callers mask those)."""
    if len(hashes) < n:
        return np.zeros(0, dtype=U)
    size = len(hashes) - n + 1
    out = hashes[:size].copy()
    for k in range(1, n):
        out = mix64(out * U(0x9FB21C651E98DF25) + hashes[k:k + size])
    return out
