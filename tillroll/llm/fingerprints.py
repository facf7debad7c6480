"""Bottom-k sketches of word shingles: one number set per text, mergeable over its parts.

A sketch is the ``k`` smallest distinct 48-bit hashes of the text's shingles of five words, A-Z in
lower case; as a fingerprint, they are written in ascending order as 12 hex digits each. The sketch
of a union is the bottom k of the sketches together, so parts of a text may be sketched apart.

Cases: a text of one to four words is one shingle; a null text, an empty one or one of blanks only
has the empty sketch (fingerprint ''), like 1 to another empty one and 0 to all others; equal texts
have equal sketches; very long texts are hashed whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.base import map_batches, small
from tillroll.llm.kernels import Words, chunks, distinct

K = 128
SHINGLE = 5
DIGITS = 12
_BITS = 4 * DIGITS


def sketches(texts: pa.Array, k: int = K) -> list[np.ndarray]:
    """The sketch of each text, ascending."""
    out = []
    for _, _, data, offsets in chunks(texts):
        values, rows = Words(data, offsets).shingles(SHINGLE)
        out += [own[:k] for own in distinct(values >> np.uint64(64 - _BITS), rows)]
    return out


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex(" ", 8).replace(" 0000", "")[4:]


def likeness(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated resemblance: the share of both among the bottom k of the union."""
    both = np.concatenate([a, b])
    both.sort()
    again = both[1:] == both[:-1]
    union = np.delete(both, np.flatnonzero(again) + 1)[:k]
    if not len(union):
        return 1.0
    return int(np.count_nonzero(both[1:][again] <= union[-1])) / len(union)


def _numbers(fingerprint: Column) -> Column:
    """A fingerprint as an array of hex strings, which sort as their numbers do."""
    return F.regexp_extract_all(fingerprint, F.lit(f"[0-9a-f]{{{DIGITS}}}"), F.lit(0))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The fingerprint of two parts together."""
    return F.array_join(F.slice(F.array_sort(F.array_union(_numbers(a), _numbers(b))), 1, k), "")


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all shingles of two fingerprints."""
    union = F.slice(F.array_sort(F.array_union(_numbers(a), _numbers(b))), 1, k)
    both = F.size(F.array_intersect(union, F.array_intersect(_numbers(a), _numbers(b))))
    return F.when(F.size(union) == 0, 1.0).otherwise(both / F.size(union))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    numbers = _numbers(a)
    last = F.conv(F.element_at(numbers, -1), 16, 10).cast("double") + 1
    return F.when(F.size(numbers) < k, F.size(numbers).cast("double")).otherwise((k - 1) * float(2**_BITS) / last)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    alike = resemblance(a, b, k)
    common = alike / (1 + alike) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.length(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_count(a, k)))


def fingerprints(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id and fingerprint of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(written, sketches(batch.column(1), k)), pa.string())],
                ["doc_id", "fingerprint"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, run, "doc_id long, fingerprint string")


def in_order(docs: DataFrame, per_task: int = 4) -> DataFrame:
    """Rows dealt by ranges of doc_id and sorted, each range followed by the row that comes next.

    Columns: range, is_next, doc_id, text. Null ids come first, equal ids are in the order of their
    texts, and after the last row comes the first. The driver sees one cut and one first id of each
    range, ``per_task`` ranges to a shuffle partition; a row is held against as many cuts as twice
    the root of their number, and the first of a range finds the range before by a join.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        F.col("doc_id").cast("long"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("place"),
    )
    n = tasks * per_task
    found = keyed.approxQuantile("place", [i / n for i in range(1, n)], 0.2 / n) if n > 1 else []
    cuts = sorted({min(max(int(x), -(2**63)), 2**63 - 1) for x in found})
    ranged = keyed.withColumn("range", number_of(F.col("place"), cuts))
    firsts = sorted((r["range"], r["first"]) for r in ranged.groupBy("range").agg(F.min("place").alias("first")).collect())
    ranges = [r for r, _ in firsts]
    before = [(first, ranges[i - 1]) for i, (_, first) in enumerate(firsts)]
    known = spark.createDataFrame(before, "place long, copies int")
    here = F.struct(F.col("range"), F.lit(False).alias("is_next"))
    there = F.struct(F.col("copies").alias("range"), F.lit(True).alias("is_next"))
    dealt = F.when(F.col("copies").isNull(), F.array(here)).otherwise(F.array(here, there))
    return (
        ranged.join(small(known, len(before)), "place", "left")
        .withColumn("to", F.explode(dealt))
        .select("to.range", "to.is_next", "place", "doc_id", "text")
        .repartition(tasks, "range")
        .sortWithinPartitions("range", "is_next", "place", "text")
        .drop("place")
    )


def number_of(place: Column, cuts: list[int]) -> Column:
    """How many of the ascending cuts are at or below a place: first by blocks of them, then in one."""
    if not cuts:
        return F.lit(0)
    size = max(1, math.isqrt(len(cuts)))
    blocks = [cuts[i : i + size] for i in range(0, len(cuts), size)]
    # One text each, which is made an array once, when the plan is.
    listed = F.split(F.lit(";".join(",".join(map(str, block)) for block in blocks)), ";")
    block = F.transform(listed, lambda part: F.split(part, ",").cast("array<bigint>"))
    heads = F.split(F.lit(",".join(str(part[0]) for part in blocks)), ",").cast("array<bigint>")
    at = F.size(F.filter(heads, lambda head: head <= place))
    inside = F.size(F.filter(F.get(block, at - 1), lambda cut: cut <= place))
    return F.when(at == 0, 0).otherwise((at - 1) * size + inside).cast("int")


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def edited(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every document and of its text with the second half from the next document."""

    def compare(ids: list, texts: list[str], follows: list[bool]) -> pa.RecordBatch:
        """Row i against row i + 1, for the rows that are not copies."""
        at = [i for i in range(len(texts) - 1) if not follows[i]]
        other = [texts[i][: len(texts[i]) - len(texts[i]) // 2] + texts[i + 1][: len(texts[i]) // 2] for i in at]
        plain = sketches(pa.array(texts, pa.large_string()), k)
        changed = sketches(pa.array(other, pa.large_string()), k)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([ids[i] for i in at], pa.int64()),
                pa.array([len(texts[i]) for i in at], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in other], pa.string()),
                pa.array([written(plain[i]) for i in at], pa.string()),
                pa.array([written(x) for x in changed], pa.string()),
                pa.array([likeness(plain[i], x, k) for i, x in zip(at, changed)], pa.float64()),
                pa.array([likeness(plain[i], plain[i + 1], k) for i in at], pa.float64()),
            ],
            [f.split()[0] for f in EDITED.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, follows = [], [], []
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                ids += part.column(2).to_pylist()
                texts += part.column(3).to_pylist()
                follows += part.column(1).to_pylist()
                yield compare(ids, texts, follows)
                ids, texts, follows = ids[-1:], texts[-1:], follows[-1:]

    return map_batches(in_order(docs), run, EDITED)
