"""Words and word hashes of whole texts, computed on the bytes of an Arrow column without making Python strings.

A word is a maximal run of characters other than space and TAB to CR. Its hash is a polynomial over its bytes modulo
2**64 with an odd base, followed by a bit mixer, so equal words hash alike in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from zonecraft.llm.common import texts_of

BASE = np.uint64(0x9E6C63D0676A9A99)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
BLOCK_BYTES = 1 << 20
HASHED = 1 << 17
WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit bit mixer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 2 * HASHED)
        for key, base in (("up", BASE), ("down", BASE_INVERSE)):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _powers[key] = np.multiply.accumulate(factors)
    return _powers["up"][:n], _powers["down"][:n]


@dataclass
class Words:
    """Words of a run of texts: byte positions in ``data`` and, per text, where its words begin in the lists."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray  # one more than texts
    offsets: np.ndarray  # byte offsets of the texts in data, one more than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self, lower: bool = False) -> np.ndarray:
        found = np.empty(len(self.starts), np.uint64)
        a = 0
        while a < len(found):  # words of some bytes at a time, which stay in the processor's cache
            first = self.starts[a]
            b = max(int(np.searchsorted(self.ends, first + HASHED, "right")), a + 1)
            data = self.data[first : self.ends[b - 1]]
            starts, ends = self.starts[a:b] - first, self.ends[a:b] - first
            up, down = powers(len(data) + 1)
            total = np.empty(len(data) + 1, np.uint64)
            total[0] = 0
            np.cumsum(BYTE_CODE[LOWER[data] if lower else data] * up[: len(data)], out=total[1:])
            raw = (total[ends] - total[starts]) * down[starts]
            found[a:b] = mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            a = b
        return found


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Runs of rows of about ``size`` bytes (a longer text is a run of its own): first row, end row and their words."""
    column = texts_of(column)
    buffers = column.buffers()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32, len(column) + 1 + column.offset)
    offsets = offsets[column.offset :].astype(np.int64)
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        own = offsets[first : last + 1]
        yield first, last, split(raw[own[0] : own[-1]], own - own[0])
        first = last


def split(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~WHITE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:]
    finishes[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(begins)
    return Words(data, starts, np.flatnonzero(finishes) + 1, np.searchsorted(starts, offsets), offsets)


def windows(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``width`` words that starts at a word, and whether the run stays in that word's text.

    The list is as long as ``hashes``; entries that are not inside a text have no meaning.
    """
    n = len(hashes)
    total = np.zeros(n, np.uint64)
    for j in range(min(width, n)):
        total[: n - j] = total[: n - j] * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[j:] if j else hashes
    return mix(total), fits(bounds, n, width)


def fits(bounds: np.ndarray, n: int, width: int) -> np.ndarray:
    inside = np.zeros(n, bool)
    if n:
        text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        inside = np.arange(n) + width <= bounds[text + 1]
    return inside
