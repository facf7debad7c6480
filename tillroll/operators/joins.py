"""Left joins that stand a hot key: against any table, one batch of a history, repeated rows.

Spark splits a hot key at run time only in a sort-merge join whose two inputs come straight
from a shuffle, on either side of an inner join but only on the left of a left join. The joins
here are put so that the side that may be hot is one it can split.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.casts import align_keys, date_literal
from tillroll.operators.copies import count_copies, repeat_copies

_KEY, _HASH, _PART, _SIZE, _STEP = "__key", "__hash", "__part", "__size", "__step"


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    where: Column | None = None,
) -> DataFrame:
    """``left LEFT JOIN right [WHERE where]`` that stands a hot key on either side.

    ``where`` is a condition on the right columns that holds where they are all NULL. As it
    comes after the join, a left row whose matches all fail it is dropped, and one without any
    match is kept with NULLs.

    It is done as one inner join. A left key that is nowhere in ``right`` is given a single
    empty partner, next to the right rows that pass. To find these keys ``right`` is read once
    more for its key column alone, reduced to the left keys before it is de-duplicated, so that a
    few left keys cost no shuffle of all right ones; the other columns are read for rows that pass
    only. Left rows without a key match nothing and are added at the end.

    Against a dimension, with few rows to a key, a plain left join does with less. Both frames
    are read more than once, so they should be tables or cheap to derive from one, and have to
    give the same rows each time.
    """
    _check_names(left, right)
    left_col, right_col = align_keys(left, left_key, right, right_key)
    passing = right if where is None else right.filter(where)
    wanted = left.select(left_col.alias(_KEY)).filter(F.col(_KEY).isNotNull()).distinct()
    keys = right.select(right_col.alias(_KEY)).filter(F.col(_KEY).isNotNull())
    seen = keys.join(wanted, _KEY, "left_semi").distinct()
    unseen = wanted.join(seen, _KEY, "left_anti")
    partners = passing.withColumn(_KEY, right_col).unionByName(unseen, allowMissingColumns=True)
    found = left.join(partners, left_col == F.col(_KEY), "inner").drop(_KEY)
    return found.unionByName(left.filter(left_col.isNull()), allowMissingColumns=True)


def left_join_batch(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    right_date: str,
    batch_date: str | datetime.date,
) -> DataFrame:
    """``left LEFT JOIN right WHERE right_date = batch_date OR right_date IS NULL``.

    A left row whose matches all carry other dates is dropped. Where ``right`` is partitioned
    by its date, other dates are read for the key column alone.
    """
    of_batch = (F.col(right_date) == date_literal(batch_date)) | F.col(right_date).isNull()
    return left_join(left, right, left_key, right_key, of_batch)


def left_join_repeated(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str
) -> DataFrame:
    """Left join with a frame whose rows may repeat; the result repeats as often.

    ``right`` is counted before it is shuffled, so a key with many equal rows arrives as a few
    rows with a count. It is counted by key and hash of the key, the same groups, because rows
    counted by the key alone would be joined where they are, not straight from a shuffle.
    """
    _check_names(left, right)
    counted = count_copies(right.withColumn(_HASH, F.xxhash64(right_key)), _PART, _SIZE)
    left_col, right_col = align_keys(left, left_key, counted, right_key)
    joined = left.join(counted, left_col == right_col, "left")
    return repeat_copies(joined, _SIZE, _STEP).drop(_HASH, _PART, _SIZE, _STEP)


def _check_names(left: DataFrame, right: DataFrame) -> None:
    shared = {c.lower() for c in left.columns} & {c.lower() for c in right.columns}
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}; rename one of them")
