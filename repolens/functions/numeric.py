"""F8: decimal rounding that rounds the binary double, not its shortest decimal text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_half_away(c: Column | str, digits: int = 2) -> Column:
    """``round(x, d)`` as ``round(x * 10^d) / 10^d`` on doubles.

    Spark's ``round`` works on the decimal text of the double (1.005 -> 1.01),
    the reference rounds the scaled binary value (1.005 -> 1.0). Scaling first
    reproduces the latter; ties go away from zero in both.
    """
    col = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.round(col * F.lit(scale), 0) / F.lit(scale)
