"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillroll.operators.copies import count_copies, repeat_copies

_BUCKET, _PART, _SIZE, _END, _OFFSET, _STEP = (
    "__bucket", "__part", "__size", "__end", "__offset", "__step"
)

# Fixed, not taken from the session: another value gives other keys.
DEFAULT_BUCKETS = 4096
MAX_BUCKETS = 1_000_000


def unique_key(df: DataFrame, name: str) -> DataFrame:
    """A 64-bit key that is unique within this run. No shuffle; values follow the partitions."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")


def dense_key(
    df: DataFrame,
    name: str,
    order: Sequence[str] | None = None,
    unique: bool = False,
    buckets: int = DEFAULT_BUCKETS,
    bucket: Column | None = None,
    few_copies: bool = False,
) -> DataFrame:
    """Keys 1..N that depend only on the rows, not on how they are partitioned.

    Rows are spread over ``buckets`` by hash, numbered within their bucket, and shifted by the
    rows in all earlier buckets. Only one count per bucket is gathered and broadcast, at most
    ``MAX_BUCKETS`` rows. ``bucket``, an integer expression over the ``order`` columns, takes
    the place of the hash; it has to spread the rows as evenly.

    ``order`` names the natural key, all columns by default. Set ``unique`` if no two rows
    share it, as after ``distinct()``. Otherwise ``order`` must be all columns: equal rows are
    counted before the shuffle and spread over the buckets in parts of bounded size, so a group
    of copies of any size does not meet in one task. Where the caller has found that no row is there
    more than ``COPIES_PER_PART`` times, ``few_copies`` gives the same keys without that count: rows
    are shuffled once instead of twice.

    ``df`` is evaluated twice and has to give the same rows both times.
    """
    if not 1 <= buckets <= MAX_BUCKETS:
        raise ValueError(f"buckets must lie between 1 and {MAX_BUCKETS}")
    columns = df.columns
    order = list(order or columns)
    if not unique:
        if {c.lower() for c in order} != {c.lower() for c in columns}:
            raise ValueError("rows that may repeat are ordered by all columns")
        number = _dense_key_few_copies if few_copies else _dense_key_with_copies
        return number(df, name, columns, buckets, bucket)

    placed = df.withColumn(_BUCKET, bucket_of(order, buckets, bucket))
    numbered = placed.withColumn(
        _END, F.row_number().over(W.partitionBy(_BUCKET).orderBy(*order)).cast("bigint")
    )
    before = F.broadcast(offsets(placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_SIZE))))
    return numbered.join(before, _BUCKET, "left").select(
        (F.col(_OFFSET) + F.col(_END)).alias(name), *columns
    )


def _dense_key_with_copies(
    df: DataFrame, name: str, columns: list[str], buckets: int, bucket: Column | None
) -> DataFrame:
    spread = None if bucket is None else bucket + F.col(_PART)
    parts = count_copies(df, _PART, _SIZE).withColumn(
        _BUCKET, bucket_of([*columns, _PART], buckets, spread)
    )
    running = (
        W.partitionBy(_BUCKET)
        .orderBy(*columns, _PART)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    # A number of partitions that is asked for is kept, where Spark would merge those whose rows
    # are few only because copies are still counted.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbered = parts.repartition(tasks, _BUCKET).withColumn(_END, F.sum(_SIZE).over(running))
    before = F.broadcast(offsets(parts.groupBy(_BUCKET).agg(F.sum(_SIZE).alias(_SIZE))))
    placed = numbered.join(before, _BUCKET, "left")
    return repeat_copies(placed, _SIZE, _STEP).select(
        (F.col(_OFFSET) + F.col(_END) - F.col(_SIZE) + F.col(_STEP)).alias(name), *columns
    )


def _dense_key_few_copies(
    df: DataFrame, name: str, columns: list[str], buckets: int, bucket: Column | None
) -> DataFrame:
    # The first part of the copies, which here are all; counted in the shuffle that numbers them.
    placing = bucket_of([*columns, F.lit(0).cast("bigint")], buckets, bucket)
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartition(tasks, placing).withColumn(_BUCKET, placing)
    in_order = W.partitionBy(_BUCKET).orderBy(*columns)
    numbered = placed.withColumn(_END, F.row_number().over(in_order).cast("bigint"))
    before = F.broadcast(offsets(placed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias(_SIZE))))
    return numbered.join(before, _BUCKET, "left").select(
        (F.col(_OFFSET) + F.col(_END)).alias(name), *columns
    )


def bucket_of(
    order: Sequence[str | Column], buckets: int, bucket: Column | None = None
) -> Column:
    """The bucket in which a row is numbered: by its hash, or as ``bucket`` says."""
    spread = F.xxhash64(*order) if bucket is None else bucket
    return F.pmod(spread.cast("bigint"), F.lit(buckets).cast("bigint"))


def offsets(sizes: DataFrame) -> DataFrame:
    """Rows in all earlier buckets. One small row per bucket, so one task is enough."""
    earlier = W.orderBy(_BUCKET).rowsBetween(W.unboundedPreceding, -1)
    return sizes.select(
        _BUCKET, F.coalesce(F.sum(_SIZE).over(earlier), F.lit(0).cast("bigint")).alias(_OFFSET)
    )


def add_key(
    df: DataFrame,
    name: str,
    kind: str,
    unique: bool,
    buckets: int = DEFAULT_BUCKETS,
    few_copies: bool = False,
) -> DataFrame:
    """Put a surrogate key first: ``"dense"`` (repeatable) or ``"unique"`` (no shuffle)."""
    if kind == "dense":
        return dense_key(df, name, unique=unique, buckets=buckets, few_copies=few_copies)
    if kind == "unique":
        return unique_key(df, name)
    raise ValueError(f"unknown kind of key: {kind!r}")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Values of ``key`` on more than one row, with their row count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)
