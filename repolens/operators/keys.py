"""Null-safe equi-join on a list of key columns (NULL keys match each other)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
                   broadcast_right: bool = False) -> DataFrame:
    """Join on ``left.k <=> right.k`` for every key; the right copies of the keys are dropped.

    ``broadcast_right`` is for sides bounded by construction; otherwise the planner chooses by bytes, and
    adaptive execution turns a side that proves small into a broadcast at run time.
    """
    tmp = {k: f"__r_{k}" for k in keys}
    r = right.select(*[F.col(c).alias(tmp[c]) if c in tmp else F.col(c) for c in right.columns])
    if broadcast_right:
        r = F.broadcast(r)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[t]) for k, t in tmp.items()])
    return left.join(r, cond, how).drop(*tmp.values())
