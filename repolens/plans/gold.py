"""M3-M8: gold metrics, written once per family and parameterised.

* monthly counts          (M3 feature PRs by close month, M6 releases by publish month)
* focus vs top-k by month (M4 PRs, M7 releases)
* median days between consecutive events for the focus and the top k (M5 PRs, M8 releases)

The PR families filter ``lower(feat_classifier) = 'feature'``; the release
families count every release (the reference's "feature_releases" do too).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import round_half_away
from ..functions.timefmt import days_between, month_start, to_timestamp_strict
from ..operators.aggregates import approx_quantile_by, count_by, exact_quantile_by
from ..operators.filters import equals_folded
from ..operators.joins import apply_cohort, cohort
from ..operators.ordering import asc
from ..operators.windows import lag_within
from ..session import ensure_checkpoint_dir

# The reference's comparison settings.
DEFAULT_FOCUS = "input-output-hk/lace"
DEFAULT_FOCUS_LABEL = "lace"
DEFAULT_K = 10
DEFAULT_MEMBER_LABEL = "top_10"
FEATURE_CLASS = "feature"


def _base(df: DataFrame, key: str, ts_col: str, class_col: str | None, class_value: str | None,
          carry: str | None = None) -> DataFrame:
    if class_col is not None:
        df = equals_folded(df, class_col, class_value or FEATURE_CLASS)
    return df.select(key, to_timestamp_strict(ts_col).alias(ts_col), *([carry] if carry in df.columns else []))


def _approx_median(rows: DataFrame, key: str, ts_col: str, id_col: str, accuracy: int) -> DataFrame:
    ranked = lag_within(rows, [key], ts_col, out="_prev", bounded_keys=True, tiebreak=[id_col] if id_col in rows.columns else [])
    gaps = ranked.where(F.col("_prev").isNotNull()).select(key, days_between(ts_col, "_prev").alias("_days"))
    return approx_quantile_by(gaps, [key], "_days", 0.5, out="_median", accuracy=accuracy)


def monthly_counts(df: DataFrame, key: str = "repository", ts_col: str = "closed_at",
                   month_col: str = "month", count_col: str = "feature_pr_count",
                   class_col: str | None = "feat_classifier", class_value: str | None = FEATURE_CLASS,
                   order: list[str] | None = None) -> DataFrame:
    """M3 / M6: rows per (key, month of ``ts_col``); a NULL timestamp is its own (NULL) month."""
    base = _base(df, key, ts_col, class_col, class_value)
    out = count_by(base.select(key, month_start(ts_col).alias(month_col)), [key, month_col], count_col)
    if order:
        out = out.orderBy(*[asc(c) for c in order])
    return out


def focus_vs_top_k(df: DataFrame, key: str = "repository", ts_col: str = "closed_at",
                   month_col: str = "pr_month", count_col: str = "feature_pr_count",
                   group_col: str = "repo_group", class_col: str | None = "feat_classifier",
                   class_value: str | None = FEATURE_CLASS, focus: str | None = DEFAULT_FOCUS,
                   focus_label: str = DEFAULT_FOCUS_LABEL, k: int = DEFAULT_K,
                   member_label: str = DEFAULT_MEMBER_LABEL, order: list[str] | None = None) -> DataFrame:
    """M4 / M7: monthly counts for the focus key and the k busiest keys, labelled by group.

    Ranking counts every row of the base (open PRs included); ties at rank k go
    to the smaller key.
    """
    base = _base(df, key, ts_col, class_col, class_value)
    # One pass over the rows: counts per (key, month). The ranking sums a key's months (NULL month
    # included) and the result is the cohort's share of the same counts. The aggregate (keys x months,
    # far smaller than the rows) is checkpointed so both uses read it instead of scanning the rows
    # twice; the join's inferred filters would otherwise keep Spark from reusing one exchange.
    ensure_checkpoint_dir(df.sparkSession)
    monthly = count_by(base.select(key, month_start(ts_col).alias(month_col)), [key, month_col],
                       count_col).checkpoint(eager=True)
    totals = monthly.groupBy(key).agg(F.sum(count_col).alias("_n"))
    top = totals.orderBy(F.col("_n").desc(), F.col(key).asc_nulls_last()).limit(k)
    members = cohort(top, key, focus, focus_label, member_label)
    out = apply_cohort(monthly, members, key, group_col).select(key, group_col, month_col, count_col)
    if order:
        out = out.orderBy(*[asc(c) for c in order])
    return out


def median_gap(df: DataFrame, key: str = "repository", ts_col: str = "closed_at",
               out_col: str = "median_days_between_feature_prs", class_col: str | None = "feat_classifier",
               class_value: str | None = FEATURE_CLASS, focus: str | None = DEFAULT_FOCUS,
               focus_label: str = DEFAULT_FOCUS_LABEL, k: int = DEFAULT_K,
               member_label: str = DEFAULT_MEMBER_LABEL, digits: int = 2, order: bool = False,
               id_col: str = "id", approx_accuracy: int | None = None) -> DataFrame:
    """M5 / M8: median of the day gaps between consecutive timestamps of each cohort key.

    ``lag`` orders NULLs last, so the first NULL timestamp after the last real
    one still forms a pair whose gap is NULL; a key whose gaps are all NULL
    keeps a row with a NULL median, a key with a single row has none.

    Runs of equal times and of equal gaps are counted, not carried, so copies cost
    one row. ``approx_accuracy`` (opt-in) replaces the exact median with a sketch
    over all gaps (rank error at most n / accuracy); it reads the rows once more,
    and the record id (``id_col``) splits runs of equal times there.
    """
    # One read of the rows: counts of equal (key, time), combined map-side. The ranking sums them and the
    # gaps come from the same checkpointed table; a time that n rows share has n - 1 gaps of nothing.
    ensure_checkpoint_dir(df.sparkSession)
    base = _base(df, key, ts_col, class_col, class_value)
    times = count_by(base, [key, ts_col], "_n").checkpoint(eager=True)
    top = times.groupBy(key).agg(F.sum("_n").alias("_n")).orderBy(F.col("_n").desc(), F.col(key).asc_nulls_last()).limit(k)
    members = cohort(top, key, focus, focus_label, member_label)
    if approx_accuracy:
        med = _approx_median(apply_cohort(_base(df, key, ts_col, class_col, class_value, id_col), members, key),
                             key, ts_col, id_col, approx_accuracy)
        return med.select(key, round_half_away("_median", digits).alias(out_col))
    ranked = lag_within(apply_cohort(times, members, key), [key], ts_col, out="_prev", bounded_keys=True)
    moved = ranked.where(F.col("_prev").isNotNull()).select(key, days_between(ts_col, "_prev").alias("_days"), F.lit(1).cast("long").alias("_n"))
    still = ranked.where(F.col(ts_col).isNotNull() & (F.col("_n") > 1)).select(key, F.lit(0.0).alias("_days"), F.col("_n") - 1)
    gaps = moved.union(still).groupBy(key, "_days").agg(F.sum("_n").alias("_n"))
    med = exact_quantile_by(gaps, [key], "_days", 0.5, out="_median", bounded_keys=True, keep_empty_keys=True, weight="_n")
    out = med.select(key, round_half_away("_median", digits).alias(out_col))
    if order:
        out = out.orderBy(asc(out_col))
    return out
