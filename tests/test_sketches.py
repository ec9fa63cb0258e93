import random

import pytest
from pyspark.sql import functions as F

from repolens.operators import sketches as S
from repolens.operators.aggregates import top_k_groups
from repolens.functions.timefmt import days_between
from repolens.operators.windows import lag_within


def frame(spark, keys, parts=5):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, i long").repartition(parts)


def data(shape):
    rng = random.Random(shape)
    if shape == "skewed":
        return [f"k{int(rng.paretovariate(0.7))}" for _ in range(4000)]
    if shape == "flat":
        return [f"k{rng.randrange(1500)}" for _ in range(4000)]
    if shape == "tied":
        return [f"k{i % 6}" for i in range(1200)] + [f"rare{i}" for i in range(2000)]
    if shape == "hot null":
        return [None] * 900 + [f"k{i % 700}" for i in range(1400)] + ["b"] * 300
    return [f"k{i % 3}" for i in range(30)]  # few keys


@pytest.mark.parametrize("shape", ["skewed", "flat", "tied", "hot null", "few"])
@pytest.mark.parametrize("counters", [8, 40, 5000])
def test_equal_to_the_exact_plan(spark, shape, counters):
    df = frame(spark, data(shape))
    for k in (1, 4) if counters == 40 else (4,):
        assert S.top_k_by_summary(df, "key", k, counters=counters).collect() == top_k_groups(df, "key", k).collect()


def test_counts_lie_within_the_bound_and_few_rows_leave_a_task(spark):
    keys = data("skewed")
    parts = S.key_summaries(frame(spark, keys), "key", 40).collect()
    slack = sum(r.low or 0 for r in parts)
    assert len(parts) <= 5 * 41 and 0 < slack <= len(keys) / 41 + 5
    seen = {}
    for r in parts:
        if r.n is not None:
            seen[r.key] = seen.get(r.key, 0) + r.n
    true = {k: keys.count(k) for k in set(keys)}
    assert all(seen.get(k, 0) <= n <= seen.get(k, 0) + slack for k, n in true.items())


def test_proved_ranks_count_only_likely_keys(spark, monkeypatch):
    df, asked = frame(spark, data("tied")), []
    monkeypatch.setattr(S, "top_k_groups", lambda d, key, k, out: asked.append(d) or top_k_groups(d, key, k, out))
    S.top_k_by_summary(df, "key", 6, counters=40)
    assert asked[0].select("key").distinct().count() == 6
    S.top_k_by_summary(frame(spark, data("flat")), "key", 6, counters=40)
    assert asked[1].select("key").distinct().count() > 1000


def test_empty_tables(spark):
    none = spark.createDataFrame([], "key string, t timestamp_ntz")
    assert S.top_k_by_summary(none, "key", 3).isEmpty() and S.sketch_quantile(S.gap_sketches(none, "key", "t"), ["key"]).isEmpty()


def test_merged_sketches_stay_within_their_bound(spark):
    rng = random.Random(3)
    rows = [(f"k{rng.randrange(2)}", rng.randrange(10 ** 8)) for _ in range(20_000)]
    df = spark.createDataFrame(rows, "key string, s long").select("key", F.timestamp_seconds("s").cast("timestamp_ntz").alias("t"))
    stored = S.gap_sketches(df, "key", "t", 400)
    assert stored.count() > 40
    merged = S.sketch_quantile(stored, ["key"], 0.5, "m")
    gaps = lag_within(df, ["key"], "t", out="p").where("p IS NOT NULL").select("key", days_between("t", "p").alias("d"))
    assert {r.key: r.n for r in merged.collect()} == {r.key: r["count"] for r in gaps.groupBy("key").count().collect()}
    assert all(r.rank_error <= 2 * S.kll_rank_error(400) for r in S.rank_error(gaps, merged, "key", "d", "m").collect())
