"""Bloom filters of a key column, kept as a small table beside the rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A key sets four bits in each of four words of a block; blocks hold eight keys on average.
WORDS, BITS, KEYS_PER_BLOCK = 4, 4, 8

FILTER = T.StructType(
    [T.StructField("size", T.IntegerType()), T.StructField("block", T.LongType())]
    + [T.StructField(f"word_{i}", T.LongType()) for i in range(WORDS)]
)


def canonical(key: Column) -> Column:
    """Text of a key: whole numbers as they are written without padding, other text as it is.

    Two keys that are equal as numbers or as text have the same, so a filter never misses one.
    """
    text = key.cast("string")
    return F.coalesce(text.try_cast("bigint").cast("string"), text)


def comparable(kind: T.DataType) -> bool:
    """Whether keys of a type are equal to texts only if their canonical texts are."""
    return isinstance(kind, (T.IntegralType, T.StringType))


def _words(key: Column) -> list[Column]:
    hashes = [F.xxhash64(key, F.lit(i)) for i in range(WORDS // 2)]
    words = []
    for word in range(WORDS):
        at = [F.shiftrightunsigned(hashes[word // 2], 6 * (BITS * (word % 2) + i)).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS)]
        bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), place) for place in at]
        mask = bits[0]
        for bit in bits[1:]:
            mask = mask.bitwiseOR(bit)
        words.append(mask.alias(f"word_{word}"))
    return words


def _block(key: Column, size: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.call_function("shiftleft", F.lit(1).cast("bigint"), size))


def key_filter(df: DataFrame, column: str, rows: int) -> DataFrame:
    """The filter of a column with so many rows, a line per block: about four bytes a row.

    There are 2^size blocks. One line a row is grouped, after the words of a block are joined in each
    task, so copies of a key cost nothing.
    """
    size = F.lit(max(0, math.ceil(math.log2(max(1, rows) / KEYS_PER_BLOCK))))
    keys = df.select(canonical(F.col(column)).alias("key")).filter("key IS NOT NULL")
    lines = keys.select(size.alias("size"), _block(F.col("key"), size).alias("block"), *_words(F.col("key")))
    return lines.groupBy("size", "block").agg(*(F.bit_or(f"word_{i}").alias(f"word_{i}") for i in range(WORDS)))


def may_hold(filters: DataFrame, df: DataFrame, column: str) -> DataFrame:
    """The rows of filters, with whatever columns they have besides, of blocks that may hold a key of ``df``.

    A key that was put into a filter is always found; one that was not is found by about one in a
    million.
    """
    sizes = [row[0] for row in filters.select("size").distinct().collect()]  # at most 63
    keys = df.select(canonical(F.col(column)).alias("key")).filter("key IS NOT NULL").distinct()
    asked = keys.select("key", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("size"))
    masks = [word.alias(f"mask_{i}") for i, word in enumerate(_words(F.col("key")))]
    asked = asked.select("size", _block(F.col("key"), F.col("size")).alias("block"), *masks)
    found = filters.join(asked, ["size", "block"])
    for i in range(WORDS):
        found = found.filter(F.col(f"word_{i}").bitwiseAND(F.col(f"mask_{i}")) == F.col(f"mask_{i}"))
    return found.select(filters.columns)
