"""Exact counts of byte grams, in tables as large as there are grams, a bounded slice at a time.

A gram is one number: nine bits for a symbol plus one, the last symbol lowest, up to four before it.
The probability of a symbol is made of counts of grams that end alike, so grams are dealt into slices
by the two symbols before the last: all that one symbol needs beyond grams of two symbols, of which
there are at most 258 * 258 in every slice, is in one slice.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.kernels import mixed

BITS = 9
#: Grams of a slice, about: what a task holds at a time.
SLICE = 4_000_000

_TWO = (1 << 2 * BITS) - 1


class Table:
    """Rows of numbers by key, exactly; zeros for keys that are not there. Open addressing."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys = np.append(keys.astype(np.int64), 0)
        self.values = np.concatenate([values, np.zeros((1, values.shape[1]))]).astype(np.float32)
        self.log = max(4, int(2 * len(keys)).bit_length())
        self.place = np.full(1 << self.log, -1, np.int32)
        left = np.arange(len(keys))
        at = self._start(keys)
        while len(left):
            free = self.place[at] < 0
            self.place[at[free]] = left[free]
            lost = self.place[at] != left
            left, at = left[lost], (at[lost] + 1) & (len(self.place) - 1)

    def _start(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.astype(np.uint64) + np.uint64(1)) >> np.uint64(64 - self.log)).astype(np.int64)

    def __getitem__(self, keys: np.ndarray) -> np.ndarray:
        """The rows of some keys."""
        found, left, at = np.full(len(keys), -1), np.arange(len(keys)), self._start(keys)
        while len(left):
            row = self.place[at]
            same = (row >= 0) & (self.keys[row] == keys[left])
            found[left[same]] = row[same]
            on = (row >= 0) & ~same
            left, at = left[on], (at[on] + 1) & (len(self.place) - 1)
        return self.values[found]

    def __len__(self) -> int:
        return len(self.keys) - 1


def table_of(rows: DataFrame, key: str) -> Table:
    """A table of a frame whose other columns are numbers; rows of one slice."""
    found = rows.toArrow()
    names = [c for c in rows.columns if c != key]
    return Table(found[key].to_numpy(), np.stack([found[c].to_numpy().astype(np.float64) for c in names], 1))


def class_of(context: Column) -> Column:
    """The two symbols that decide the slice, from the symbols before the last as a number."""
    return context.bitwiseAND(F.lit(_TWO))


def in_slice(context: Column, i: int, n: int) -> Column:
    """Whether the grams after a context are in slice i of n; those of at most one symbol are in all."""
    own = F.pmod(F.xxhash64(class_of(context)), F.lit(n)) == i
    return own | (context < (1 << BITS)) if n > 1 else F.lit(True)


def slice_numbers(spark, n: int) -> Table | None:
    """The slice of each two symbols, as ``in_slice`` deals them; None where there is one slice."""
    if n == 1:
        return None
    every = spark.range(_TWO + 1).select("id", F.pmod(F.xxhash64("id"), F.lit(n)).alias("slice"))
    return table_of(every, "id")


def ours(context: np.ndarray, i: int, numbers: Table | None) -> np.ndarray:
    """Whether slice i gives the probability after each context."""
    if numbers is None:
        return np.ones(len(context), bool)
    return numbers[context & _TWO][:, 0] == i
