"""Registration of queries and access to the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import shared_folder, tidy, tune

Query = Callable[[SparkSession, str], DataFrame]

#: Text takes three to four times the disk of the tables it is made from, packed lightly less than one.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its key, with the SQL that gives the same rows."""

    def add(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)

        QUERIES[name] = tuned
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_text(df: DataFrame) -> DataFrame:
    """Every column as a string, the form in which delimited files carry them."""
    return df.select(*(F.col(f.name).cast("string").alias(f.name) for f in df.schema))


def write_delimited(df: DataFrame, spark: SparkSession, label: str) -> str:
    """Put a frame down as '|'-delimited files with headers, as an upstream system would, packed."""
    path = shared_folder(spark, label)
    with tidy(spark):
        writer = as_text(df).write.option("header", True).option("delimiter", "|")
        writer.options(**PACKED).csv(path)
    return path


def write_documents(df: DataFrame, spark: SparkSession, label: str) -> str:
    """Put a frame down as JSON documents, one per line, packed."""
    path = shared_folder(spark, label)
    with tidy(spark):
        df.write.options(**PACKED).json(path)
    return path
