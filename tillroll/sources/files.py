"""File sources: delimited text, nested documents, staged parquet."""

from __future__ import annotations

import datetime
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.loads import KEYS, LOAD, load_folder, staged_loads
from tillroll.operators.key_filter import FILTER, comparable, may_hold
from tillroll.session import find_folders


def text_schema(names: Sequence[str]) -> T.StructType:
    """Every column a string: delimited text is typed later, by named casts."""
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


CORRUPT = "_corrupt_record"


def _lenience(malformed: str, schema: T.StructType | None) -> tuple[dict[str, str], T.StructType | None]:
    """Reader options, and the schema with the column that records are kept in."""
    if malformed == "fail":
        return {"mode": "FAILFAST"}, schema
    if malformed != "keep":
        raise ValueError(f"malformed is 'fail' or 'keep', not {malformed!r}")
    if schema is None:
        raise ValueError("keeping malformed records needs a schema")
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}, kept


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | None = None,
    delimiter: str = "|",
    header: bool = True,
    malformed: str = "fail",
) -> DataFrame:
    """Delimited files under a path, a glob or a list of paths, read in splits.

    With a header and a schema, a file whose header names other columns is an error rather
    than silently read by position. Without a schema the first header names the columns and
    all are strings; types are never inferred, which would read the data twice.

    A line with too few or too many fields is an error. With ``malformed="keep"`` its fields are
    read as far as they go, and the line as it is stands in ``_corrupt_record``, NULL for others.
    """
    options, read_as = _lenience(malformed, schema)
    # Otherwise a line is judged by those of its fields that a query asks for.
    reader = spark.read.options(**options, columnPruning="false")
    reader = reader.option("delimiter", delimiter).option("header", header)
    if read_as is not None:
        # A header is compared with the schema; the column for malformed lines is in no header.
        reader = reader.schema(read_as).option("enforceSchema", not header or malformed == "keep")
    return reader.csv(path)


def read_documents(
    spark: SparkSession, path: str | list[str], schema: T.StructType, malformed: str = "fail"
) -> DataFrame:
    """An exported document collection, one JSON document per line, with nested structs.

    A line that is no document is an error, or with ``malformed="keep"`` a row of NULLs with the
    line in ``_corrupt_record``. Fields that a document lacks are NULL.
    """
    options, read_as = _lenience(malformed, schema)
    return spark.read.options(**options).schema(read_as).json(path)


def read_staged(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    batch_column: str = "ins_dt",
    dates: Collection[str | datetime.date] | None = None,
) -> DataFrame:
    """Staged parquet with its load-date partition: of each date the load that was published last.

    ``dates`` names the dates to read, others are not even listed. With a schema the load date is a
    date even where a path holds no dated partition yet, and no footer is read to find the types.
    A path without loads, staged by something else, is read as it is.
    """
    current = staged_loads(spark, path, batch_column)
    if schema is not None and batch_column.lower() not in {name.lower() for name in schema.names}:
        schema = T.StructType([*schema.fields, T.StructField(batch_column, T.DateType())])
    if current is None:
        plain = spark.read.parquet(path) if schema is None else spark.read.schema(schema).parquet(path)
        return plain if dates is None else plain.filter(F.col(batch_column).isin([str(d) for d in dates]))
    wanted = None if dates is None else {str(d) for d in dates}
    folders = [
        load_folder(path, batch_column, date, load.load)
        for date, load in sorted(current.items())
        if wanted is None or date in wanted
    ]
    if not folders:
        if schema is None:
            raise LookupError(f"{path} holds none of the dates asked for")
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())]))
    return reader.parquet(*folders).drop(LOAD)


def dates_with_keys(
    spark: SparkSession, path: str, df: DataFrame, column: str, batch_column: str = "ins_dt"
) -> list[str] | None:
    """The staged dates that may hold a key of ``df``, by the filters written with them; None for all.

    Dates staged without a filter are among them. False positives cost reads, never rows. The filters
    are small beside the key column, and only lines of the keys' blocks are joined.
    """
    if not comparable(df.schema[column].dataType):
        return None
    path = path.rstrip("/")
    current = staged_loads(spark, path, batch_column) or {}
    kept = set(find_folders(spark, f"{path}/{KEYS}", f"{batch_column}=*/{LOAD}=*"))
    filtered = sorted(d for d, load in current.items() if (f"{batch_column}={d}", f"{LOAD}={load.load}") in kept)
    if not filtered:
        return None
    folders = [load_folder(f"{path}/{KEYS}", batch_column, date, current[date].load) for date in filtered]
    schema = T.StructType([*FILTER.fields, T.StructField(batch_column, T.StringType()), T.StructField(LOAD, T.StringType())])
    filters = spark.read.option("basePath", f"{path}/{KEYS}").schema(schema).parquet(*folders)
    found = {row[0] for row in may_hold(filters, df, column).select(batch_column).distinct().collect()}
    return sorted(found | (current.keys() - set(filtered)))
