"""Equal rows carried as one row and a count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COPIES_PER_PART = 10_000


def count_copies(
    df: DataFrame, part: str, size: str, copies_per_part: int = COPIES_PER_PART
) -> DataFrame:
    """Each distinct row with its number of copies, in numbered parts of bounded size.

    Copies are counted before the shuffle, so however many there are, each task sends one row;
    the parts keep any later repetition short and let it be spread over tasks.
    """
    total = F.count(F.lit(1))
    parts = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(size) - 1) / copies_per_part))
    return (
        df.groupBy(*df.columns)
        .agg(total.alias(size))
        .withColumn(part, F.explode(parts))
        .withColumn(
            size,
            F.least(
                F.lit(copies_per_part).cast("bigint"), F.col(size) - F.col(part) * copies_per_part
            ),
        )
    )


def repeat_copies(df: DataFrame, size: str, step: str) -> DataFrame:
    """Each row as often as its ``size`` says, once where it is NULL; ``step`` counts from 1."""
    one = F.lit(1).cast("bigint")
    return df.withColumn(step, F.explode(F.sequence(one, F.coalesce(F.col(size), one))))
