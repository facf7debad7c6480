"""Surrogate keys."""

from __future__ import annotations

import collections
import glob

import pytest
from helpers import physical_plan
from pyspark.sql import functions as F

from tillroll.operators import add_key, dense_key, unique_key
from tillroll.operators.copies import count_copies, repeat_copies
from tillroll.operators.passes import key_parts


def keyed(df, **options):
    return {(r["k"], *tuple(r)[1:]) for r in dense_key(df, "k", **options).collect()}


@pytest.fixture
def pairs(spark):
    return spark.range(3000).select(
        (F.col("id") % 97).alias("a"), F.col("id").cast("string").alias("b")
    )


def test_dense_keys_are_one_to_n(pairs):
    keys = sorted(r[0] for r in dense_key(pairs, "k", unique=True).select("k").collect())
    assert keys == list(range(1, 3001))


def test_dense_keys_do_not_follow_the_partitions(spark, pairs):
    want = keyed(pairs, unique=True, buckets=16)
    for parts in (1, 7):
        assert keyed(pairs.repartition(parts, "b"), unique=True, buckets=16) == want
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        assert keyed(pairs.orderBy(F.desc("b")), unique=True, buckets=16) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_dense_key_equals_a_global_row_number(spark, pairs):
    got = dense_key(pairs, "k", unique=True, buckets=8, bucket=F.col("a")).collect()
    want = sorted(got, key=lambda r: (r["a"] % 8, r["a"], r["b"]))
    assert [r["k"] for r in want] == list(range(1, 3001))


def test_natural_key_narrower_than_the_row(pairs):
    wide = pairs.withColumn("c", F.col("a") * 2)
    got = dense_key(wide, "k", order=["b"], unique=True, buckets=16)
    assert {(r.k, r.b) for r in got.collect()} == {
        (r.k, r.b) for r in dense_key(wide.select("b"), "k", unique=True, buckets=16).collect()
    }


def test_copies_get_a_key_each(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 500).alias("v"),
        F.lit(None).cast("string").alias("n"),
    )
    first = dense_key(df, "k", buckets=32)
    rows = first.collect()
    assert sorted(r.k for r in rows) == list(range(1, 30_001))
    assert collections.Counter(r.v for r in rows)[-1] == 10_000
    again = dense_key(df.repartition(5), "k", buckets=32)
    assert first.exceptAll(again).isEmpty() and again.exceptAll(first).isEmpty()


def test_copies_are_spread_in_parts_of_bounded_size(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, -1).otherwise(F.col("id")).alias("v"))
    parts = count_copies(df, "part", "size", copies_per_part=64)
    hot = [r for r in parts.collect() if r.v == -1]
    assert len(hot) == 15 and max(r["size"] for r in hot) == 64
    back = repeat_copies(parts, "size", "step").select("v")
    assert back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_a_hot_group_of_copies_is_written_by_many_tasks(spark):
    """Copies meet in parts of 10,000, wherever the buckets come from."""
    hot = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 2 == 0, F.lit(5)).otherwise(F.col("id")).alias("v")
    )
    for bucket in (None, F.col("v") * 31):
        tasks = dense_key(hot, "k", bucket=bucket).filter("v = 5")
        spread = tasks.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(spread) > 4 and max(r["count"] for r in spread) < 100_000


def test_few_copies_give_the_same_keys_with_one_shuffle_of_rows_less(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 400).alias("v"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).alias("n"),
    )
    for bucket in (None, F.coalesce("v", F.lit(5))):
        counted = dense_key(df, "k", buckets=16, bucket=bucket)
        plain = dense_key(df.repartition(3), "k", buckets=16, bucket=bucket, few_copies=True)
        assert collections.Counter(counted.collect()) == collections.Counter(plain.collect())
    plans = [
        physical_plan(dense_key(df, "k", few_copies=few)).split("BroadcastExchange")[0]
        for few in (False, True)
    ]
    assert [p.count("Exchange hashpartitioning") for p in plans] == [2, 1]
    assert dense_key(df.filter("v < 0"), "k", few_copies=True).count() == 0


@pytest.mark.parametrize("few", [False, True])
def test_rows_numbered_in_parts_have_the_same_keys(spark, folder, few):
    """Also where copies of a row need several parts of their own."""
    hot = 0 if few else 25_000
    df = spark.range(30_000).select(
        F.when(F.col("id") >= hot, F.col("id") % 400).otherwise(-1).alias("v"),
        F.when(F.col("id") % 2 == 0, F.lit("x")).alias("n"),
    )
    want = collections.Counter(dense_key(df, "k", buckets=32).collect())
    parts = (df.filter(F.pmod("v", F.lit(3)) == i) for i in range(3))
    found = collections.Counter()
    for part in key_parts(parts, "k", "dense", folder, 5, buckets=32, few_copies=few):
        found.update(part.collect())
    assert found == want and max(r.k for r in found) == 30_000
    assert not glob.glob(f"{folder}/dealt/__slice=*")
    with pytest.raises(ValueError):
        next(key_parts(iter([df]), "k", "other", folder, 2))
    with pytest.raises(ValueError):
        next(key_parts(iter([df]), "k", "dense", folder, 2, buckets=0))


def test_unique_key(spark):
    df = unique_key(spark.range(0, 1000, 1, 7), "k")
    assert df.columns == ["k", "id"]
    assert df.select("k").distinct().count() == 1000


def test_bad_arguments(pairs):
    with pytest.raises(ValueError):
        dense_key(pairs, "k", buckets=0)
    with pytest.raises(ValueError):
        dense_key(pairs, "k", order=["a"])
    with pytest.raises(ValueError):
        add_key(pairs, "k", "other", unique=True)


def test_empty_frame(spark, pairs):
    assert dense_key(pairs.filter("a < 0"), "k", unique=True).count() == 0
    assert dense_key(pairs.filter("a < 0"), "k").count() == 0
