"""Final ordering with explicit NULL placement, capped ordered selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def asc(c: str) -> Column:
    """Ascending with NULLs last (the reference engine's default; Spark's is NULLs first)."""
    return F.col(c).asc_nulls_last()


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_last()


def order_by(df: DataFrame, cols: list[str | Column]) -> DataFrame:
    """O1: final ORDER BY; plain names mean ascending, NULLs last. Skip it when writing tables."""
    return df.orderBy(*[asc(c) if isinstance(c, str) else c for c in cols])


def first_n(df: DataFrame, order: list[str | Column], n: int | None) -> DataFrame:
    """Order then cap; None is no cap, 0 or less keeps nothing. A cap plans as TakeOrderedAndProject."""
    out = order_by(df, order)
    return out if n is None else out.limit(max(n, 0))
