"""First rows of a frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def preview(df: DataFrame, n: int = 20, order_by: list[str | Column] | None = None) -> DataFrame:
    """The first ``n`` rows; the same ones on every run only if ``order_by`` is unique.

    With an order each task keeps its own top ``n``, so no full sort takes place.
    """
    return (df.orderBy(*order_by) if order_by else df).limit(n)
