"""Date-partitioned parquet staging, published date by date when it is complete.

The files of a load lie in ``<batch column>=<date>/__load=<load>``, beside those of earlier loads of
the date. A note in the log of the path says which load is the date's, so a staging that fails leaves
the date as it was, also when it is run again over rows that are there; ``read_staged`` reads by that
log. The load before stays too, so frames read from it stay readable until the next one.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.loads import KEYS, LOAD, LoadLog, load_folder
from tillroll.operators.key_filter import key_filter
from tillroll.session import drop_other_folders, find_folders, remove_folder

KEEP = 2


@dataclass(frozen=True)
class Written:
    """A load of one date whose files are complete, and which nobody reads yet."""

    path: str
    batch_column: str
    date: str
    load: str
    rows: int
    columns: str
    key: str | None = None

    def facts(self) -> dict[str, object]:
        return {"load": self.load, "rows": self.rows, "columns": self.columns, "key": self.key}


def write_batch(
    df: DataFrame,
    path: str,
    batch_date: str | datetime.date,
    batch_column: str = "ins_dt",
    max_records_per_file: int = 0,
    key: str | None = None,
) -> Written:
    """Write ``df`` as a load of one date, whatever dates it held before, to be published later.

    With a ``key`` column a filter of its values is written beside, by which readers tell whether
    the date may hold some keys without reading it.
    """
    spark, day, load = df.sparkSession, datetime.date.fromisoformat(str(batch_date)), uuid.uuid4().hex
    rows = df.drop(batch_column)
    folder = load_folder(path, batch_column, str(day), load)
    rows.write.option("maxRecordsPerFile", max_records_per_file).parquet(folder)
    n = spark.read.schema(rows.schema).parquet(folder).count()  # from the footers
    written = Written(path.rstrip("/"), batch_column, str(day), load, n, rows.schema.simpleString(), key)
    if key is not None:
        kept = key_filter(spark.read.schema(rows.schema).parquet(folder), key, n)
        kept.write.parquet(load_folder(f"{written.path}/{KEYS}", batch_column, str(day), load))
    return written


def publish(spark: SparkSession, written: Written, others: bool = True) -> None:
    """Make a load the one of its date; without ``others``, the one date there is."""
    log = LoadLog(spark, written.path)
    log.add(written.date, written.load, written.facts())
    kept = {f"{LOAD}={load}" for load in log.trim(written.date, KEEP)}
    for base in (written.path, f"{written.path}/{KEYS}"):
        drop_other_folders(spark, f"{base}/{written.batch_column}={written.date}", f"{LOAD}=", kept)
    if not others:
        _drop_dates(spark, written.path, written.batch_column, log.loads().keys() - {written.date})


def _drop_dates(spark: SparkSession, path: str, batch_column: str, dates: Iterable[str]) -> None:
    log = LoadLog(spark, path)
    for date in dates:
        log.drop(date)
        for base in (path, f"{path}/{KEYS}"):
            remove_folder(spark, f"{base}/{batch_column}={date}")


def stage_batch(
    df: DataFrame,
    path: str,
    batch_date: str | datetime.date,
    batch_column: str = "ins_dt",
    max_records_per_file: int = 0,
) -> None:
    """Replace one load date of staged parquet by ``df``, whatever dates it held before.

    A batch that has become empty leaves an empty date, where a dynamic overwrite would leave the
    old rows. If it fails, the date is as it was.
    """
    publish(df.sparkSession, write_batch(df, path, batch_date, batch_column, max_records_per_file))


def stage(
    df: DataFrame,
    path: str,
    batch_column: str = "ins_dt",
    mode: str = "dynamic",
    many_dates: bool = False,
    max_records_per_file: int = 0,
) -> None:
    """Overwrite staged parquet, one directory per load date.

    ``mode="dynamic"`` replaces only the dates present in ``df``, so a date can be staged again
    without losing the others; ``"static"`` replaces all dates. Dates are published one by one when
    all are written; with ``"static"`` the others go last.

    A frame of one date is written by its tasks without a shuffle. One over ``many_dates`` would
    leave a file per task and date: it is rebalanced by date first, where Spark splits a date
    that is too large for one task, which a plain ``repartition`` by date would not.
    """
    if mode not in ("dynamic", "static"):
        raise ValueError(f"unknown overwrite mode: {mode!r}")
    spark, path, load = df.sparkSession, path.rstrip("/"), uuid.uuid4().hex
    laid_out = df.hint("rebalance", F.col(batch_column)) if many_dates else df
    (
        laid_out.withColumn(LOAD, F.lit(load))
        .write.mode("append")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(batch_column, LOAD)
        .parquet(path)
    )
    columns, log = df.drop(batch_column).schema, LoadLog(spark, path)
    dates = [folder.split("=", 1)[1] for folder, _ in find_folders(spark, path, f"{batch_column}=*/{LOAD}={load}")]
    for date in dates:
        n = spark.read.schema(columns).parquet(load_folder(path, batch_column, date, load)).count()
        publish(spark, Written(path, batch_column, date, load, n, columns.simpleString()))
    if mode == "static":
        _drop_dates(spark, path, batch_column, log.loads().keys() - set(dates))
