"""Column operations shared by staging and the targets."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.casts import date_literal


def with_batch_date(
    df: DataFrame, batch_date: str | datetime.date | None = None, name: str = "ins_dt"
) -> DataFrame:
    """Add the load date; today unless a batch date is given."""
    day = F.current_date() if batch_date is None else date_literal(batch_date)
    return df.withColumn(name, day)


def flatten_struct(df: DataFrame, struct: str, fields: Sequence[str]) -> DataFrame:
    """Move struct fields to the top level and drop the struct.

    A frame that no longer has the struct is returned unchanged, so a frame that was
    flattened before it was staged can be flattened again after it is read back.
    """
    present = any(
        f.name.lower() == struct.lower() and isinstance(f.dataType, T.StructType)
        for f in df.schema
    )
    if not present:
        return df
    return df.withColumns({f: F.col(f"{struct}.{f}") for f in fields}).drop(struct)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; names that are not there are ignored."""
    return df.drop(*names)


def item_count(items: str | Column, pattern: str = ",", missing: int | None = None) -> Column:
    """Number of entries in a separated list, trailing empty ones included.

    A NULL list counts as NULL, or as ``missing`` if given (-1 is the pre-ANSI answer).
    """
    count = F.array_size(F.split(items, pattern))
    return count if missing is None else F.coalesce(count, F.lit(missing))


def time_parts(timestamp: str | Column) -> dict[str, Column]:
    """Hour, minute and second of a timestamp, in the session time zone."""
    return {"hour": F.hour(timestamp), "minute": F.minute(timestamp), "second": F.second(timestamp)}


def null_or_marker(marker: str | None, null_type: str) -> Column:
    """A typed NULL, or the text a warehouse loader reads as NULL."""
    return F.lit(None).cast(null_type) if marker is None else F.lit(marker)
