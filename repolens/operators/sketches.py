"""A3, A4 by mergeable summaries: exact top-k groups from Misra-Gries counters, stored KLL quantile sketches."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.timefmt import days_between, month_start
from ..session import ensure_checkpoint_dir
from .aggregates import count_by, top_k_groups
from .windows import lag_within


def key_summaries(df: DataFrame, key: str, counters: int) -> DataFrame:
    """(key, n, low): per input partition a Misra-Gries summary; the row with ``n`` NULL says how much any count may lack.

    A partition's true count of a key lies in [n, n + low]; a key without a row has at most ``low``.
    """
    src = df.select(F.col(key).alias("key"))
    schema = StructType([src.schema["key"], StructField("n", LongType()), StructField("low", LongType())])

    def summarise(batches):
        held: Counter = Counter()
        low = 0
        for b in batches:
            found = b.column(0).value_counts()
            for value, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                held[value] += n
            if len(held) > counters:  # take the (counters + 1)-th largest count off all
                cut = sorted(held.values(), reverse=True)[counters]
                held = Counter({v: n - cut for v, n in held.items() if n > cut})
                low += cut
        kind = b.schema.field(0).type if held else None
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), kind), pa.array(list(held.values()), pa.int64()), pa.nulls(len(held), pa.int64())], names=schema.names)
        if low:
            yield pa.RecordBatch.from_arrays([pa.nulls(1, b.schema.field(0).type), pa.nulls(1, pa.int64()), pa.array([low], pa.int64())], names=schema.names)

    return src.mapInArrow(summarise, schema)


def top_k_by_summary(df: DataFrame, key: str, k: int, out: str = "n", counters: int = 1000) -> DataFrame:
    """A3 + O2, the rows of :func:`.aggregates.top_k_groups`, for keys too many to shuffle.

    Every task keeps ``counters`` keys; merged, a key's count lies in [n, n + slack], where slack is the sum of
    what the tasks took off. If the k-th largest n exceeds the slack, no key without a counter can be among the
    first k, and only keys with n + slack at least that much are counted exactly in a second read. Else (flat
    data, or fewer than k keys left) nothing is proved and the exact plan counts all keys. Without slack the
    summaries are the counts.
    """
    ensure_checkpoint_dir(df.sparkSession)
    parts = key_summaries(df, key, counters).checkpoint(eager=True)
    slack = parts.agg(F.sum("low")).first()[0] or 0
    merged = parts.where(F.col("n").isNotNull()).groupBy("key").agg(F.sum("n").alias("n"))
    order = [F.col("n").desc(), F.col("key").asc_nulls_last()]
    if slack == 0:
        return merged.orderBy(*order).limit(k).select(F.col("key").alias(key), F.col("n").alias(out))
    best = merged.orderBy(*order).limit(k).agg(F.min("n").alias("least"), F.count("*").alias("c")).first()
    if best["c"] < k or best["least"] <= slack:
        return top_k_groups(df, key, k, out)
    likely = merged.where(F.col("n") + slack >= best["least"]).select(F.col("key").alias("_k"))
    counted = df.select(key).join(likely, F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    return top_k_groups(counted, key, k, out)


def gap_sketches(df: DataFrame, key: str, ts_col: str, accuracy: int = 800) -> DataFrame:
    """(key, month, sketch binary): a KLL sketch of the days since the key's previous event, by the later event's month.

    Sketches have a bounded size and merge, so they are stored once per load and serve every period.
    """
    ranked = lag_within(df.where(F.col(ts_col).isNotNull()).select(key, ts_col), [key], ts_col, out="_prev")
    gaps = ranked.where(F.col("_prev").isNotNull()).select(key, month_start(ts_col).alias("month"), days_between(ts_col, "_prev").alias("_days"))
    return gaps.groupBy(key, "month").agg(F.kll_sketch_agg_double("_days", accuracy).alias("sketch"))


def sketch_quantile(sketches: DataFrame, keys: list[str], q: float = 0.5, out: str = "quantile") -> DataFrame:
    """The quantile of each group's merged sketches, and the number of values they stand for (``n``)."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("_s"))
    return merged.select(*keys, F.kll_sketch_get_n_double("_s").alias("n"), F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(out))


def kll_rank_error(accuracy: int) -> float:
    """The published 99 % bound of a KLL sketch's rank error, as a share of all values."""
    return 2.296 / accuracy ** 0.9723


def rank_error(values: DataFrame, quantiles: DataFrame, key: str, value: str, quantile: str, q: float = 0.5) -> DataFrame:
    """(key, rank_error): how far each key's ``quantile`` stands from rank ``q`` among its ``values``, counted exactly."""
    both = count_by(values, [key, value], "_n").join(quantiles.select(key, quantile), key)
    at = both.groupBy(key).agg(F.sum("_n").alias("_all"), F.sum(F.when(F.col(value) < F.col(quantile), F.col("_n")).otherwise(0)).alias("_under"),
                               F.sum(F.when(F.col(value) <= F.col(quantile), F.col("_n")).otherwise(0)).alias("_upto"))
    return at.select(key, F.greatest(F.col("_under") / F.col("_all") - q, q - F.col("_upto") / F.col("_all"), F.lit(0.0)).alias("rank_error"))
