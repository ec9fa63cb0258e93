"""Grouped counts, top-k groups, exact quantiles, row and key counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .keys import join_null_safe
from .ranking import LOCAL, PART, range_sorted


def count_by(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    """A1-A3: ``count(*)`` per key tuple (NULL is a group); partial-aggregated map-side."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def top_k_groups(df: DataFrame, key: str, k: int, out: str = "n") -> DataFrame:
    """A3 + O2: the ``k`` keys with most rows; ties broken by key ascending (NULLs last).

    Planned as partial count -> TakeOrderedAndProject: every task keeps its own
    best ``k`` and only ``k`` rows per task reach the final merge.
    """
    return (count_by(df, [key], out)
            .orderBy(F.col(out).desc(), F.col(key).asc_nulls_last())
            .limit(k))


def exact_quantile_by(df: DataFrame, keys: list[str], value: str, q: float = 0.5,
                      out: str = "quantile", bounded_keys: bool = False, keep_empty_keys: bool = False,
                      tiebreak: list[str] | None = None, weight: str | None = None) -> DataFrame:
    """A4: exact continuous quantile per key, NULL values ignored (``quantile_cont``).

    Position ``(n - 1) * q`` between the sorted values at ``floor`` and ``ceil``, interpolated as
    ``lo * (1 - d) + hi * d``. A row stands for ``weight`` equal values (1 without it), so equal values
    may be counted together before. No group is ever gathered in one place: rows are range-sorted on
    (key, value) with NULLs last, so a hot key spans many partitions; a small segment table says which
    segment holds each of the two positions, and only those segments' running counts are made. A key
    whose values are all NULL yields a NULL row when ``keep_empty_keys`` (SQL ``GROUP BY`` semantics),
    else no row. ``tiebreak`` columns split runs of equal values across partitions (results unchanged).
    """
    tb = list(tiebreak or [])
    w = F.col(weight) if weight else F.lit(1)
    s = range_sorted(df.select(*keys, value, *tb, w.cast("long").alias("_w")), keys, [value], tb)
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    seg = s.groupBy(*keys, PART).agg(F.sum("_w").alias("_cnt"),
                                     F.sum(F.when(F.col(value).isNotNull(), F.col("_w")).otherwise(0)).alias("_nn"))
    seg = seg.select("*", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
                     F.sum("_nn").over(Window.partitionBy(*keys)).alias("_n_vals"))
    pos = (F.col("_n_vals") - 1).cast("double") * F.lit(float(q))
    ends = F.array(F.struct(F.lit("_lo").alias("which"), F.floor(pos).cast("long").alias("p")),
                   F.struct(F.lit("_hi").alias("which"), F.ceil(pos).cast("long").alias("p")))
    per_end = (seg.where(F.col("_n_vals") > 0)
                  .select(*keys, PART, "_off", "_cnt", (pos - F.floor(pos)).alias("_d"), F.explode(ends).alias("_end")))
    inside = (F.col("_end.p") >= F.col("_off")) & (F.col("_end.p") < F.col("_off") + F.col("_cnt"))
    targets = per_end.where(inside).select(*keys, PART, (F.col("_end.p") - F.col("_off")).alias("_at"),
                                           F.col("_end.which").alias("_which"), "_d")
    # two target rows per key: broadcast only when the keys are bounded by construction
    held = join_null_safe(s, targets, keys + [PART], "inner", broadcast_right=bounded_keys)
    upto = F.sum("_w").over(Window.partitionBy(*keys, PART, "_which").orderBy(LOCAL)
                            .rowsBetween(Window.unboundedPreceding, 0))
    chosen = held.withColumn("_upto", upto).where((F.col("_at") < F.col("_upto")) & (F.col("_at") >= F.col("_upto") - F.col("_w")))
    agg = chosen.groupBy(*keys).agg(
        F.max(F.when(F.col("_which") == "_lo", F.col(value))).alias("_vlo"),
        F.max(F.when(F.col("_which") == "_hi", F.col(value))).alias("_vhi"),
        F.max("_d").alias("_d"))
    result = agg.select(*keys, (F.col("_vlo") * (F.lit(1.0) - F.col("_d")) + F.col("_vhi") * F.col("_d")).alias(out))
    if keep_empty_keys:
        empty = (seg.where(F.col("_n_vals") == 0).select(*keys).distinct()
                    .select(*keys, F.lit(None).cast("double").alias(out)))
        result = result.unionByName(empty)
    return result


def approx_quantile_by(df: DataFrame, keys: list[str], value: str, q: float = 0.5, out: str = "quantile",
                       accuracy: int = 10000) -> DataFrame:
    """A4, opt-in: ``percentile_approx`` per key - a sketch of bounded size per group, merged
    map-side, so no sort is needed. Rank error is at most ``n / accuracy``; the result is one of
    the observed values (no interpolation). NULL values are ignored; an all-NULL key gives NULL.
    """
    return df.groupBy(*keys).agg(F.percentile_approx(value, q, accuracy).alias(out))


def row_count(df: DataFrame, name: str, name_col: str = "table_name", out: str = "row_count") -> DataFrame:
    """One-row ``(name, count(*))`` aggregate; union several for a run summary."""
    return df.agg(F.count(F.lit(1)).alias(out)).select(F.lit(name).alias(name_col), F.col(out))


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct set of key tuples (partial-aggregated)."""
    return df.select(*keys).distinct()
