"""Longest-processing-time scheduling of groups of equal texts into shards of near equal bytes.

Groups that must stay together are taken from the largest down, each to the shard with the least
so far, the first of equal ones, through a heap. That is done exactly, for all groups: those of one
size are as good as each other, so the heap takes sizes with their number of groups. Of many groups
of a size, each shard gets as many as it would get one by one, which follows from the loads; which
of them are its own follows from their order. Of a corpus of B bytes there are at most sqrt(2 B)
different sizes; they pass the driver one by one, and what goes back is a row a size.

A shard can be larger than the others only by a group that is larger than an even shard: groups are
never split.

Cases: a null text counts as no bytes, and null texts are a group; an empty text is a group of its
own; every row has one byte more, so that rows without text are dealt evenly too; repeated rows are
rows of one group; ties of size go by hash and digest of the text; an empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.base import keep, small

SHARDS = 16
#: Buckets per shard, or size of groups, in which rows are numbered.
BUCKETS = 256


def shares(loads: list[int], size: int, n: int) -> list[int]:
    """How many of n groups of a size go to each shard, each to the least loaded, the first of equal ones.

    The i-th group of a shard comes when the shard holds its load and i groups, so the n groups are
    those with the n least such sums.
    """

    def below(least: int) -> list[int]:
        return [max(0, -((load - least) // size)) for load in loads]

    lo, hi = min(loads), max(loads) + n * size + 1
    while lo < hi:  # the largest sum up to which no more than n groups come
        middle = (lo + hi + 1) // 2
        lo, hi = (middle, hi) if sum(below(middle)) <= n else (lo, middle - 1)
    counts = below(lo)
    left = n - sum(counts)
    for shard, load in enumerate(loads):
        if left and load + counts[shard] * size == lo:
            counts[shard] += 1
            left -= 1
    return counts


def least_loaded(classes: Iterable[tuple[int, int]], shards: int) -> Iterator[tuple[int, list[int]]]:
    """Of each (size, number of groups), the largest size first, how many groups go to each shard."""
    heap = [(0, shard) for shard in range(shards)]
    for size, n in classes:
        counts = [0] * shards
        if n <= 4 * shards:
            for _ in range(n):
                load, shard = heap[0]
                heapq.heapreplace(heap, (load + size, shard))
                counts[shard] += 1
        else:
            loads = [load for load, _ in sorted(heap, key=lambda item: item[1])]
            counts = shares(loads, size, n)
            heap = [(load + size * k, shard) for shard, (load, k) in enumerate(zip(loads, counts))]
            heapq.heapify(heap)
        yield size, counts


def place(sizes: DataFrame, shards: int = SHARDS, buckets: int = BUCKETS) -> DataFrame:
    """Shard of each group, from rows (key, size): adds ``shard`` to the rows."""
    spark = sizes.sparkSession
    groups = keep(sizes.groupBy("key").agg(F.sum("size").alias("bytes")))
    classes = groups.groupBy("bytes").agg(F.count("*").alias("n")).orderBy(F.col("bytes").desc())
    dealt = list(least_loaded(((row["bytes"], row["n"]) for row in classes.toLocalIterator()), shards))
    ends = [list(itertools.accumulate(counts)) for _, counts in dealt]
    columns = [pa.array([size for size, _ in dealt], pa.int64()), pa.array(ends, pa.list_(pa.int64()))]
    placed = spark.createDataFrame(pa.Table.from_arrays(columns, ["bytes", "ends"]))
    # Groups of a size are numbered by buckets of a hash, so that a common size is not one task's work.
    bucketed = groups.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    counted = bucketed.groupBy("bytes", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("bytes").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("bytes", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    nth = F.row_number().over(Window.partitionBy("bytes", "bucket").orderBy("key")) - 1
    ranked = bucketed.withColumn("nth", nth).join(starts, ["bytes", "bucket"]).join(small(placed, len(dealt)), "bytes")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("start") + F.col("nth"))).alias("shard")
    # A text with many copies is a hot key on the left of an inner join, which Spark splits.
    return sizes.join(keep(ranked.select("key", shard)), "key")


def number(rows: DataFrame, order: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Adds ``slot``: 0, 1, ... within each shard, by buckets of a hash and then by ``order``.

    Only the bucket sizes of all shards meet in one place; rows are numbered within buckets.
    """
    dealt = rows.withColumn("__bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy("shard", "__bucket").agg(F.count("*").alias("__rows"))
    before = Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "__bucket", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("shard", "__bucket").orderBy(*order)
    # starts has at most shards * buckets rows.
    return (
        dealt.withColumn("__rank", F.row_number().over(within) - 1)
        .join(F.broadcast(starts), ["shard", "__bucket"])
        .withColumn("slot", F.col("__start") + F.col("__rank"))
        .drop("__bucket", "__rank", "__start")
    )


def shards(docs: DataFrame, count: int = SHARDS, buckets: int = BUCKETS) -> DataFrame:
    """Shard and slot of every document, equal texts together and bytes per shard near equal."""
    rows = keep(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.crc32("text").alias("text_crc32"),
            F.coalesce(F.md5("text"), F.lit("null")).alias("key"),
        )
    )
    placed = place(rows, count, buckets)
    return number(placed, ["doc_id", "key"], buckets).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
