"""Words, shingles and hashes of Arrow text columns, as numpy arrays over their bytes.

Texts are taken some megabytes at a time, so memory follows the longest text and not the batch.
A null text is an empty one. Hashes are 64 bits wide and the same in every task and session.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 18

_random = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_PLACE = _random.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64; at least n of them."""
    return _powers(base, 1 << max(10, (n - 1).bit_length()))


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of about ``limit`` bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """The row of each item, from the offsets of rows."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


class ByteHash:
    """Hashes of any runs of some bytes; A-Z like a-z if folded."""

    def __init__(self, data: np.ndarray, fold: bool = False):
        n = len(data)
        self._total = np.zeros(n + 1, np.uint64)
        np.cumsum((_FOLDED if fold else _BYTE)[data] * powers(_BASE, n + 1)[:n], out=self._total[1:])
        self._back = powers(_UNBASE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._total[end] - self._total[start]) * self._back[start])


class Words:
    """Words of some texts: ``start`` and ``end`` bytes, ``hash``, and ``offsets`` of rows among them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = BLANK, fold: bool = True):
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~separator[data]
        broken = np.zeros(n + 1, bool)  # between bytes i - 1 and i a text ends
        broken[offsets] = True
        self.start = np.flatnonzero(inside[1:-1] & ~(inside[:-2] & ~broken[:-1]))
        self.end = np.flatnonzero(inside[1:-1] & ~(inside[2:] & ~broken[1:])) + 1
        self.offsets = np.searchsorted(self.start, offsets)
        self.part = ByteHash(data, fold)
        self.hash = self.part(self.start, self.end)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of k words in a row, and the offsets of rows; fewer words are one shingle."""
        counts = np.diff(self.offsets)
        full = np.maximum(counts - k + 1, 0)
        offsets = np.concatenate([[0], np.cumsum(np.where(counts, np.maximum(full, 1), 0))])
        out = np.zeros(offsets[-1], np.uint64)
        if len(self.hash) >= k:
            joint = self.hash[: len(self.hash) - k + 1] * _PLACE[0]
            for i in range(1, k):
                joint = joint + self.hash[i : len(self.hash) - k + 1 + i] * _PLACE[i]
            at = np.arange(full.sum()) - np.repeat(np.cumsum(full) - full, full)
            out[np.repeat(offsets[:-1], full) + at] = joint[np.repeat(self.offsets[:-1], full) + at]
        for row in np.flatnonzero((counts > 0) & (counts < k)):
            own = self.hash[self.offsets[row] : self.offsets[row + 1]]
            out[offsets[row]] = (own * _PLACE[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
        return mixed(out), offsets


def distinct(values: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Sorted distinct values of each row."""
    return [np.unique(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:])]
