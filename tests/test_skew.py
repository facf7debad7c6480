"""One key on a third of the rows or more: right rows, and Spark splits the hot task."""

from __future__ import annotations

import pytest
from helpers import D, OTHER, assert_same_rows, physical_plan, settings
from pyspark.sql import functions as F

from tillroll.operators import left_join, left_join_batch, left_join_repeated
from tillroll.plans import transaction_fact
from tillroll.plans.targets import registration_dim
from tillroll.session import tune

# Thresholds at which the small fixtures count as skewed; more shuffle partitions than cores so
# that the median partition is small.
SMALL = {
    "spark__sql__autoBroadcastJoinThreshold": -1,
    "spark__sql__adaptive__autoBroadcastJoinThreshold": -1,
    "spark__sql__shuffle__partitions": 20,
    "spark__sql__adaptive__coalescePartitions__enabled": "false",
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": 2,
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture
def small(spark):
    tune(spark)
    with settings(spark, **SMALL):
        yield spark


def plain(left, right, left_key, right_key, right_date):
    joined = left.join(right, left[left_key] == right[right_key], "left")
    return joined.filter((F.col(right_date) == F.lit(D)) | F.col(right_date).isNull())


def dated(column, every):
    return F.when(F.col("id") % every == 0, F.lit(OTHER)).otherwise(F.lit(D)).alias(column)


def hot(share, key):
    """A key that is -7 on ``share`` of the rows."""
    return F.when(F.rand(3) < share, F.lit(-7)).otherwise(key).cast("bigint")


def skewed(df):
    """Run a frame and look whether a join was split."""
    df.collect()
    return "skew=true" in physical_plan(df)


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_batch_join(small, hot_side):
    shares = {"left": (0.4, 0.0), "right": (0.0, 0.4)}[hot_side]
    left = small.range(0, 12_000, 1, 8).select(
        hot(shares[0], F.col("id") % 9000).alias("a"), F.col("id").alias("x")
    )
    if hot_side == "right":
        left = left.union(small.range(1).selectExpr("-7L", "-1L"))
    right = small.range(0, 12_000, 1, 8).select(
        hot(shares[1], F.col("id") * 2).alias("b"), F.col("id").alias("y"), dated("d", 3)
    )
    if hot_side == "left":
        right = right.union(small.createDataFrame([(-7, -1, D)], right.schema))
    got, want = left_join_batch(left, right, "a", "b", "d", D), plain(left, right, "a", "b", "d")
    assert_same_rows(got, want.select(got.columns))
    assert skewed(got)
    if hot_side == "right":
        assert not skewed(want)


def test_hot_key_in_the_history_of_a_batch(small):
    """Nearly all of it on other dates, so only the search for keys without a match meets it."""
    left = small.range(0, 8000, 1, 8).select((F.col("id") - 7).alias("a"), F.col("id").alias("x"))
    many = small.range(0, 40_000, 1, 8)
    day = F.when(F.col("id") % 1000 == 0, F.lit(D)).otherwise(F.lit(OTHER)).alias("d")
    right = many.select(hot(0.5, F.col("id") + 4000).alias("b"), F.col("id").alias("y"), day)
    got = left_join_batch(left, right, "a", "b", "d", D)
    assert_same_rows(got, plain(left, right, "a", "b", "d").select(got.columns))


def test_keys_of_the_history_that_no_transaction_has_are_not_shuffled(spark):
    """With few transactions, the history is reduced to their keys where it is read."""
    left = spark.range(0, 50).select((F.col("id") * 1000).alias("a"), F.col("id").alias("x"))
    right = spark.range(0, 40_000, 1, 8).select(
        F.col("id").alias("b"), F.col("id").alias("y"), dated("d", 3)
    )
    got = left_join_batch(left, right, "a", "b", "d", D)
    assert_same_rows(got, plain(left, right, "a", "b", "d").select(got.columns))
    got.collect()
    plan = physical_plan(got)
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    # from the history's key column up to its first exchange
    history = [part for part in final.split("Exchange hashpartitioning(__key")[1:]]
    semi = [part for part in history if "LeftSemi" in part and "Range (0, 40000" in part]
    assert semi and all("BroadcastHashJoin" in part[: part.index("LeftSemi")] for part in semi)
    assert all("LeftSemi" in part or "Range (0, 40000" not in part for part in history)


def test_hot_left_key_that_is_nowhere_on_the_right(small):
    left = small.range(0, 12_000, 1, 8).select(
        hot(0.4, F.col("id")).alias("a"), F.col("id").alias("x")
    )
    right = small.range(0, 12_000, 1, 8).select(
        (F.col("id") * 2).alias("b"), F.col("id").alias("y"), dated("d", 3)
    )
    got = left_join_batch(left, right, "a", "b", "d", D)
    assert_same_rows(got, plain(left, right, "a", "b", "d").select(got.columns))
    assert skewed(got)


@pytest.mark.parametrize("hot_side", ["left", "right"])
def test_left_join(small, hot_side):
    many = small.range(0, 12_000, 1, 8).select(hot(0.4, F.col("id")).alias("k"), "id")
    few = small.range(-20, 9000, 1, 8).select((F.col("id") * 2 + 1).alias("k"), "id")
    left, right = (many, few) if hot_side == "left" else (few, many)
    left, right = left.toDF("a", "x"), right.toDF("b", "y")
    got = left_join(left, right, "a", "b")
    assert_same_rows(got, left.join(right, left.a == right.b, "left"))
    assert skewed(got)


def test_null_keys_on_a_third_of_both_sides(small):
    nulls = F.when(F.col("id") % 3 > 0, F.col("id"))
    left = small.range(6000).select(nulls.alias("a"), F.col("id").alias("x"))
    right = small.range(6000).select(nulls.alias("b"), F.col("id").alias("y"), dated("d", 5))
    got = left_join_batch(left, right, "a", "b", "d", D)
    assert_same_rows(got, plain(left, right, "a", "b", "d").select(got.columns))


@pytest.mark.parametrize("hot_key", [-7, None])
def test_repeated_join_with_a_hot_left_key(small, hot_key):
    key = F.when(F.rand(5) < 0.4, F.lit(hot_key)).otherwise(F.col("id") % 5000).cast("bigint")
    left = small.range(0, 12_000, 1, 8).select(key.alias("a"), F.col("id").alias("x"))
    right = small.range(0, 6000, 1, 8).select((F.col("id") % 4000 - 7).alias("b"))
    got = left_join_repeated(left, right, "a", "b")
    assert_same_rows(got, left.join(right, left.a == right.b, "left"))
    assert skewed(got)


def test_repeated_join_with_a_hot_right_key(small):
    left = small.range(200).select((F.col("id") - 7).alias("a"))
    right = small.range(30_000).select(hot(0.4, F.col("id") % 900).alias("b"))
    got = left_join_repeated(left, right, "a", "b")
    assert_same_rows(got, left.join(right, left.a == right.b, "left"))


def test_registrations_with_a_hot_consumer(small):
    consumers = small.range(0, 12_000, 1, 8).select(
        hot(0.4, F.col("id")).cast("string").alias("REGIS_CNSM_ID"),
        *(F.lit("1").alias(c) for c in ("REGIS_CTY_CODE", "REGIS_LTY_ID", "REGIS_DATE")),
        *(F.lit("x").alias(c) for c in ("REGIS_CHANNEL", "REGIS_GENDER", "REGIS_CITY")),
        F.col("id").cast("string").alias("REGIS_ID"),
        F.lit(D).alias("ins_dt"),
    )
    addresses = small.range(-10, 8000, 1, 8).select(
        F.col("id").cast("string").alias("consumer_id"),
        F.lit("s").alias("street"),
        F.lit("c").alias("city"),
        F.lit("t").alias("state"),
    )
    dim = registration_dim(consumers, addresses, key="unique")
    want = consumers.join(addresses, consumers.REGIS_CNSM_ID == addresses.consumer_id, "left_semi")
    assert dim.count() == want.distinct().count()
    assert skewed(dim)


def test_fact_with_hot_keys_agrees_with_the_plain_form(small):
    i, text = F.col("id"), F.col("id").cast("string")
    sb = small.range(0, 3000, 1, 8).select(
        F.when(i % 3 > 0, i).alias("App_Transaction_Id"),
        F.lit("2021-07-25 10:11:12").cast("timestamp").alias("ACTIVITY_TIMESTAMP"),
        F.lit(1).alias("TRANSACTION_POINT_VALUE"),
        F.lit(1.0).alias("TRANSACTION_RETAIL_VALUE"),
        F.lit("r").alias("TRANSACTION_EXTERNAL_REFERENCE"),
        dated("ins_dt", 10),
    )
    plain_columns = ("BASE_POINT_VALUE", "MOBILE_UID", "MOBILE_OS", "RECEIPT_STATUS")
    ol = small.range(0, 6000, 1, 8).select(
        F.when(i % 3 == 0, F.lit("1")).otherwise(text).alias("SBLP_TRANSACTION_ID"),
        F.when(i % 2 == 0, F.lit("hot")).otherwise((i % 50).cast("string")).alias("LOYALTY_ID"),
        F.lit("a,b").alias("PRODUCTS"),
        *(F.lit("5").alias(c) for c in plain_columns),
        text.alias("MSG_CODE"),
        dated("ins_dt", 4),
    )
    reg = small.range(90).select(F.when(i % 3 == 0, F.lit("hot")).otherwise(text).alias("CNSM_ID"))
    got = transaction_fact(sb, ol, reg, D, key="dense").select(
        "TXN_ID", "RTL_TXN_EXT_CHAR_5", "CNSM_ID"
    )
    receipt_key = F.col("SBLP_TRANSACTION_ID").try_cast("bigint")
    want = (
        plain(
            sb.filter(F.col("ins_dt") == F.lit(D)).drop("ins_dt"),
            ol.withColumn("k", receipt_key).withColumnRenamed("ins_dt", "d"),
            "App_Transaction_Id",
            "k",
            "d",
        )
        .join(reg, F.col("LOYALTY_ID") == F.col("CNSM_ID"), "left")
        .select(
            F.col("App_Transaction_Id").cast("string").alias("TXN_ID"),
            F.col("MSG_CODE").cast("bigint").alias("RTL_TXN_EXT_CHAR_5"),
            "CNSM_ID",
        )
    )
    assert_same_rows(got, want)
