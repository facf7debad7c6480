"""What the corpus operators share: kept intermediates, and the registry of their queries."""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import one_process, shared_folder, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: A frame is broadcast by hint only after its rows were counted and found to be at most so many.
BROADCAST_ROWS = 100_000

BATCH_ROWS = 2_000

#: Space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: Digits, letters, and all beyond ASCII. The separators are listed one by one: a class of single
#: characters is one look-up to the regex engine, one of ranges a chain of calls.
TERM = "[^" + "".join(rf"\x{c:02X}" for c in range(128) if not chr(c).isalnum()) + "]+"


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


def keep(df: DataFrame) -> DataFrame:
    """``checkpoint()`` a frame that is small beside the corpus, in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not one_process(df.sparkSession):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            base = tempfile.mkdtemp(prefix="tillroll-")
        context.setCheckpointDir(base)
    return df.checkpoint()


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as parquet below the shared folder and read it back, lineage cut."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` over rows that hold texts, in batches of at most BATCH_ROWS.

    The size of batches is a setting of the session and is read when the frame is run, so it is left
    set. A batch of the default size takes its bytes several times over in each Python worker.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df.mapInArrow(run, schema)


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A kept frame with a broadcast hint if it has at most BROADCAST_ROWS rows, else as it is.

    ``rows`` is its row count, where the caller has it.
    """
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fold_case(text: Column) -> Column:
    """A-Z in lower case, all other characters as they are.

    ``translate`` looks up each character; on whole texts it takes ten times as long as ``lower``.
    """
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text: Column) -> Column:
    """The words of a text as they are written; none for null."""
    found = F.regexp_extract_all(text, F.lit(TERM), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def n_terms(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(TERM)), F.lit(0)).cast("long")


def in_slices(frame: DataFrame, rows: int) -> list[DataFrame]:
    """A kept frame of so many rows in parts by hash, small enough to be broadcast."""
    parts = 1 + 2 * (rows // BROADCAST_ROWS) if rows > BROADCAST_ROWS else 1
    if parts == 1:
        return [F.broadcast(frame)]
    return [F.broadcast(frame.filter(F.pmod(F.xxhash64(*frame.columns), F.lit(parts)) == i)) for i in range(parts)]


def joined(frame: DataFrame, other: DataFrame, on: str, columns: list[str]) -> DataFrame:
    """Inner join with a kept frame of any size, broadcast slice by slice; ``columns`` of the result."""
    parts = [frame.join(part, on).select(columns) for part in in_slices(other, other.count())]
    return reduce(DataFrame.unionByName, parts)


def term_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(term, n): occurrences of the lower-case terms of a vocabulary in all documents, kept."""
    occurring = docs.select(F.explode(terms(F.col("text"))).alias("word")).select(F.lower("word").alias("term"))
    return keep(joined(occurring, vocabulary, "term", ["term"]).groupBy("term").agg(F.count("*").alias("n")))
