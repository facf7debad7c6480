"""Explicit casts in place of the implicit ones that raise under ANSI mode."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


INTEGERS = ("tinyint", "smallint", "int", "integer", "bigint")


def null_on_error(column: str | Column, to: str | T.DataType) -> Column:
    """Cast, giving NULL where the value does not fit or text does not parse.

    A cast that fails costs far more than one that works, even if the error is swallowed. The
    common kinds of text that is no integer (empty, a word, a decimal) are therefore told by
    comparisons and not cast to one at all.
    """
    text = F.col(column) if isinstance(column, str) else column
    name = to.lower() if isinstance(to, str) else to.simpleString()
    cast = text.try_cast(to)
    return F.when(_may_be_integer(text), cast) if name in INTEGERS else cast


def _may_be_integer(column: Column) -> Column:
    """False only for text that is surely no integer.

    Digits, signs, blanks and control characters sort before ``:``, but for DEL, which a cast
    strips from the ends as well. The type is known to the optimizer, which drops its test.
    """
    text = column.cast("string")
    start = (text < ":") | (text >= "\x7f")
    return (F.typeof(column) != "string") | ((text != "") & start & ~text.contains("."))


def date_literal(day: str | datetime.date) -> Column:
    """A constant date, so that a comparison with a partition column prunes partitions."""
    return F.lit(day).cast("date")


def align_keys(
    left: DataFrame, left_key: str, right: DataFrame, right_key: str
) -> tuple[Column, Column]:
    """Both join keys in one type: the text side is cast to the other side's type.

    Text that does not parse becomes NULL and matches nothing, instead of failing the job.
    """
    left_type = left.select(left_key).schema[0].dataType
    right_type = right.select(right_key).schema[0].dataType
    left_col, right_col = F.col(left_key), F.col(right_key)
    if isinstance(left_type, T.StringType) and not isinstance(right_type, T.StringType):
        left_col = null_on_error(left_col, right_type)
    elif isinstance(right_type, T.StringType) and not isinstance(left_type, T.StringType):
        right_col = null_on_error(right_col, left_type)
    return left_col, right_col
