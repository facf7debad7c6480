"""Rows made and numbered in passes, each over a part of them.

A query holds all it has shuffled until it ends, so three wide shuffles in one take the disk of all
three. Done in passes, a part of the rows is shuffled at a time and what a pass gives is stored. That
it holds less asks for a session that removes the shuffle files of each query (``session.tidy``).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.operators import keys
from tillroll.operators.copies import count_copies, repeat_copies
from tillroll.session import folder_exists, remove_folder, settings

_SLICE, _BUCKET, _PART, _SIZE = "__slice", "__bucket", "__part", "__size"
_END, _OFFSET, _STEP = "__end", "__offset", "__step"

#: Rows that are read once. Without dictionaries they are written in two thirds of the time.
STORED = {"compression": "zstd", "parquet.enable.dictionary": "false"}

#: A task keeps a file open for each slice, where Spark would sort its rows by slice.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def can_deal(left: T.DataType, right: T.DataType) -> bool:
    """Whether equal keys of these types are dealt alike by ``pass_of``."""
    if isinstance(left, T.IntegralType):
        return isinstance(right, T.IntegralType)
    return left == right == T.StringType()


def pass_of(key: Column, kind: T.DataType, passes: int) -> Column:
    """The pass of a key, the same on both sides of a join; keys that are NULL have one too."""
    same = key.cast("bigint") if isinstance(kind, T.IntegralType) else key
    return F.pmod(F.xxhash64(same), F.lit(passes))


def key_parts(
    parts: Iterable[DataFrame],
    name: str,
    kind: str,
    folder: str,
    passes: int,
    buckets: int = keys.DEFAULT_BUCKETS,
    few_copies: bool = False,
) -> Iterator[DataFrame]:
    """``add_key`` to the rows of all parts, which may repeat; dense keys are the same.

    Frames come one by one, and each has to be used before the next is asked for. Stored rows lie in
    ``folder``, which the caller removes. Each part is evaluated once; copies of a row have to be in
    one part.
    """
    if kind == "unique":
        yield keys.unique_key(store_parts(parts, f"{folder}/rows"), name)
    elif kind == "dense":
        yield from _dense_parts(parts, name, folder, passes, buckets, few_copies)
    else:
        raise ValueError(f"unknown kind of key: {kind!r}")


def store_parts(parts: Iterable[DataFrame], path: str) -> DataFrame:
    """The rows of all parts, of one schema, written to a folder and read from it."""
    for part in parts:
        part.write.mode("append").options(**STORED).parquet(path)
    return part.sparkSession.read.schema(part.schema).parquet(path)


def _dense_parts(
    parts: Iterable[DataFrame], name: str, folder: str, passes: int, buckets: int, few_copies: bool
) -> Iterator[DataFrame]:
    if not 1 <= buckets <= keys.MAX_BUCKETS:
        raise ValueError(f"buckets must lie between 1 and {keys.MAX_BUCKETS}")
    place, number = (_place, _number) if few_copies else (_place_counted, _number_counted)
    for part in parts:
        placed = place(part, buckets).withColumn(_SLICE, F.pmod(_BUCKET, F.lit(passes)).cast("int"))
        with settings(part.sparkSession, {WRITERS: str(passes)}):
            writer = placed.write.mode("append").options(**STORED).partitionBy(_SLICE)
            writer.parquet(f"{folder}/dealt")
    spark, schema, columns = part.sparkSession, placed.drop(_SLICE).schema, part.columns
    slices = [f"{folder}/dealt/{_SLICE}={i}" for i in range(passes)]
    slices = [path for path in slices if folder_exists(spark, path)]
    if not slices:
        yield spark.createDataFrame([], T.StructType([T.StructField(name, T.LongType()), *part.schema]))
        return
    rows = F.count(F.lit(1)) if few_copies else F.sum(_SIZE)
    sizes = spark.read.schema(schema).parquet(*slices).groupBy(_BUCKET).agg(rows.alias(_SIZE))
    before = F.broadcast(store_parts([keys.offsets(sizes)], f"{folder}/offsets"))
    for path in slices:
        yield number(spark.read.schema(schema).parquet(path), before, name, columns)
        remove_folder(spark, path)


def _place(df: DataFrame, buckets: int) -> DataFrame:
    # The first part of the copies, which here are all.
    return df.withColumn(_BUCKET, keys.bucket_of([*df.columns, F.lit(0).cast("bigint")], buckets))


def _place_counted(df: DataFrame, buckets: int) -> DataFrame:
    counted = count_copies(df, _PART, _SIZE)
    return counted.withColumn(_BUCKET, keys.bucket_of([*df.columns, _PART], buckets))


def _in_buckets(df: DataFrame) -> DataFrame:
    # A number of partitions that is asked for is kept, where Spark would merge small ones.
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), _BUCKET)


def _number(df: DataFrame, before: DataFrame, name: str, columns: list[str]) -> DataFrame:
    in_order = W.partitionBy(_BUCKET).orderBy(*columns)
    numbered = _in_buckets(df).withColumn(_END, F.row_number().over(in_order).cast("bigint"))
    return numbered.join(before, _BUCKET, "left").select(
        (F.col(_OFFSET) + F.col(_END)).alias(name), *columns
    )


def _number_counted(df: DataFrame, before: DataFrame, name: str, columns: list[str]) -> DataFrame:
    in_order = W.partitionBy(_BUCKET).orderBy(*columns, _PART)
    running = in_order.rowsBetween(W.unboundedPreceding, W.currentRow)
    numbered = _in_buckets(df).withColumn(_END, F.sum(_SIZE).over(running))
    placed = numbered.join(before, _BUCKET, "left")
    return repeat_copies(placed, _SIZE, _STEP).select(
        (F.col(_OFFSET) + F.col(_END) - F.col(_SIZE) + F.col(_STEP)).alias(name), *columns
    )
