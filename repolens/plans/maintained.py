"""M3-M8 kept up to date per load: monthly counts and median gaps from changed rows alone.

The upsert hands out the rows of the keys it changed, before (-1) and after (+1). What follows reads those
and a small state (:mod:`..sinks.ledger`), never the whole table:

* ``months``  signed counts per (key, month): M3, M6, and with the ranking by their sums M4, M7;
* ``times``   signed counts per (key, time), in folders by month;
* ``bounds``  first and last time per (key, month), the newest version counts;
* ``gaps``    signed counts per (key, days between neighbours): a multiset, the median is an order statistic of it.

A time that comes or goes changes at most the gap it splits or leaves. For a changed month its times are
read; any other month of the key is only its first and last time. The step between those two is no real
gap, but it stands in the old and in the new sequence alike and cancels. Neighbours come from the skew-proof
lag, so a key with a third of all changes is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from ..functions.numeric import round_half_away
from ..functions.timefmt import days_between, month_start, to_timestamp_strict
from ..operators.aggregates import exact_quantile_by
from ..operators.filters import equals_folded
from ..operators.joins import apply_cohort, cohort
from ..operators.windows import lag_within
from ..session import ensure_checkpoint_dir
from ..sinks import ledger
from .gold import DEFAULT_FOCUS, DEFAULT_FOCUS_LABEL, DEFAULT_K, DEFAULT_MEMBER_LABEL, FEATURE_CLASS


def _schema(*fields) -> StructType:
    return StructType([StructField(n, t()) for n, t in (("key", StringType), *fields)])


MONTHS = _schema(("month", TimestampNTZType), ("n", LongType))
TIMES = _schema(("t", TimestampNTZType), ("n", LongType), ("range", StringType))
BOUNDS = _schema(("range", StringType), ("lo", TimestampNTZType), ("hi", TimestampNTZType), ("version", LongType))
GAPS = _schema(("days", DoubleType), ("n", LongType))


def event_changes(changed: DataFrame, key: str = "repository", ts_col: str = "closed_at", class_col: str | None = "feat_classifier",
                  class_value: str = FEATURE_CLASS, sign: str = "_change") -> DataFrame:
    """(key, t, n): signed counts of a model's changed rows (before -1, after +1); what is the same on both sides cancels."""
    rows = changed if class_col is None else equals_folded(changed, class_col, class_value)
    return ledger.net(rows.select(F.col(key).alias("key"), to_timestamp_strict(ts_col).alias("t"), F.col(sign).cast("long").alias("n")), ["key", "t"])


def _range(t: str):
    return F.date_format(t, "yyyy-MM")


def _current_bounds(bounds: DataFrame) -> DataFrame:
    """The newest first and last time per (key, range), without ranges that became empty."""
    newest = bounds.groupBy("key", "range").agg(F.max(F.struct("version", "lo", "hi")).alias("b"))
    return newest.select("key", "range", "b.lo", "b.hi", "b.version").where(F.col("lo").isNotNull())


def _gaps(points: DataFrame, n: str, sign: int) -> DataFrame:
    """Signed (key, days, n) of the gaps between the times that ``n`` of ``points`` counts; equal times are 0 apart."""
    mine = points.where(F.col(n) > 0).select("key", "t", F.col(n).alias("n"))
    ranked = lag_within(mine, ["key"], "t", out="prev")
    moved = ranked.where(F.col("prev").isNotNull()).select("key", days_between("t", "prev").alias("days"), F.lit(sign).cast("long").alias("n"))
    still = mine.where("n > 1").select("key", F.lit(0.0).alias("days"), (F.lit(sign) * (F.col("n") - 1)).cast("long"))
    return moved.union(still)


def apply_load(spark: SparkSession, root: str, changes: DataFrame, version: int, gaps: bool = True) -> bool:
    """Bring the state at ``root`` up to date by one load's signed events (key, t, n); False if it was applied before.

    Keys must not be NULL; a NULL time is an event without one (it counts in its NULL month). Removing more
    events of a time than there are is an error. Loads are applied one after the other.
    """
    if ledger.is_committed(spark, root, version):
        return False
    ensure_checkpoint_dir(spark)
    new = ledger.net(changes.where(F.col("key").isNotNull()), ["key", "t"]).withColumn("range", _range("t")).checkpoint(eager=True)
    ledger.stage(ledger.net(new.select("key", month_start("t").alias("month"), "n"), ["key", "month"]), root, "months", version)
    if gaps:
        timed = new.where(F.col("t").isNotNull())
        touched = timed.select("key", "range").distinct()
        ranges = [r["range"] for r in timed.select("range").distinct().collect()]  # months of the load
        old = (ledger.read(spark, root, "times", TIMES).where(F.col("range").isin(ranges))  # prunes the other folders
               .join(touched, ["key", "range"], "left_semi").groupBy("key", "t", "range").agg(F.sum("n").alias("old")).where("old > 0"))
        rest = (_current_bounds(ledger.read(spark, root, "bounds", BOUNDS)).join(touched.select("key").distinct(), "key", "left_semi")
                .join(touched, ["key", "range"], "left_anti"))
        ends = rest.select("key", F.explode(F.array("lo", "hi")).alias("t"), F.lit(None).cast("string").alias("range"), F.lit(1).cast("long").alias("old"))
        none = F.lit(0).cast("long")
        both = (old.select("key", "t", "range", "old", none.alias("d")).unionByName(ends.withColumn("d", none))
                .unionByName(timed.select("key", "t", "range", none.alias("old"), F.col("n").alias("d"))))
        after = F.sum("old") + F.sum("d")
        points = both.groupBy("key", "t", "range").agg(
            F.sum("old").alias("old"), F.when(after < 0, F.raise_error(F.lit("a load removes events that are not there"))).otherwise(after).alias("now")).checkpoint(eager=True)
        ledger.stage(ledger.net(_gaps(points, "now", 1).unionByName(_gaps(points, "old", -1)), ["key", "days"]), root, "gaps", version)
        edge = lambda f: f(F.when(F.col("now") > 0, F.col("t")))
        ledger.stage(points.where(F.col("range").isNotNull()).groupBy("key", "range")
                     .agg(edge(F.min).alias("lo"), edge(F.max).alias("hi")).withColumn("version", F.lit(version).cast("long")), root, "bounds", version)
        ledger.stage(timed.select("key", "t", "n", "range").hint("rebalance", "range"), root, "times", version, ["range"])
    ledger.commit(spark, root, version)
    return True


def compact_state(spark: SparkSession, root: str, gaps: bool = True) -> list[str]:
    """Replace all loads' folders by their sums; returns the old folders, for a retention job."""
    tables = {"months": (MONTHS, lambda r: ledger.net(r, ["key", "month"]), None)}
    if gaps:
        tables |= {"gaps": (GAPS, lambda r: ledger.net(r, ["key", "days"]), None), "bounds": (BOUNDS, _current_bounds, None),
                   "times": (TIMES, lambda r: ledger.net(r, ["key", "t", "range"]).select("key", "t", "n", "range").hint("rebalance", "range"), ["range"])}
    return ledger.compact(spark, root, tables)


def kept_counts(spark: SparkSession, root: str, key: str = "repository", month_col: str = "month", count_col: str = "feature_pr_count") -> DataFrame:
    """M3 / M6 from the state: rows per (key, month)."""
    now = ledger.net(ledger.read(spark, root, "months", MONTHS), ["key", "month"])
    return now.select(F.col("key").alias(key), F.col("month").alias(month_col), F.col("n").alias(count_col))


def _members(months: DataFrame, focus, focus_label, k, member_label) -> DataFrame:
    top = months.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), F.col("key")).limit(k)
    return cohort(top, "key", focus, focus_label, member_label)


def kept_focus_vs_top_k(spark: SparkSession, root: str, key: str = "repository", month_col: str = "pr_month", count_col: str = "feature_pr_count",
                        group_col: str = "repo_group", focus: str | None = DEFAULT_FOCUS, focus_label: str = DEFAULT_FOCUS_LABEL,
                        k: int = DEFAULT_K, member_label: str = DEFAULT_MEMBER_LABEL) -> DataFrame:
    """M4 / M7 from the state."""
    months = ledger.net(ledger.read(spark, root, "months", MONTHS), ["key", "month"])
    out = apply_cohort(months, _members(months, focus, focus_label, k, member_label), "key", group_col)
    return out.select(F.col("key").alias(key), group_col, F.col("month").alias(month_col), F.col("n").alias(count_col))


def kept_median_gap(spark: SparkSession, root: str, key: str = "repository", out_col: str = "median_days_between_feature_prs",
                    focus: str | None = DEFAULT_FOCUS, focus_label: str = DEFAULT_FOCUS_LABEL, k: int = DEFAULT_K,
                    member_label: str = DEFAULT_MEMBER_LABEL, digits: int = 2) -> DataFrame:
    """M5 / M8 from the state: reads the cohort's gap multisets; the same rows as ``median_gap`` over all events."""
    months = ledger.net(ledger.read(spark, root, "months", MONTHS), ["key", "month"])
    members = _members(months, focus, focus_label, k, member_label)
    gaps = ledger.net(ledger.read(spark, root, "gaps", GAPS), ["key", "days"])
    # an event without a time comes last and pairs with the last that has one: a gap of NULL
    last = (months.groupBy("key").agg(F.count(F.when(F.col("month").isNull(), 1)).alias("open"), F.count("month").alias("closed"))
            .where("open > 0 AND closed > 0").select("key", F.lit(None).cast("double").alias("days"), F.lit(1).cast("long").alias("n")))
    med = exact_quantile_by(apply_cohort(gaps.unionByName(last), members, "key").select("key", "days", "n"), ["key"], "days", 0.5, out="m",
                            bounded_keys=True, keep_empty_keys=True, weight="n")
    return med.select(F.col("key").alias(key), round_half_away("m", digits).alias(out_col))
