"""Skew-proof lag and exact quantiles against brute force, with one key holding a third of the rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from repolens.operators.aggregates import exact_quantile_by
from repolens.operators.ranking import with_position
from repolens.operators.windows import lag_within


@pytest.fixture(scope="module", autouse=True)
def many_partitions(spark):
    """Small test data would be coalesced into one partition by AQE; keep all 8 so segments split."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, old)


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        v = None if rng.random() < 0.05 else float(rng.randrange(0, 500))  # duplicates and NULLs
        rows.append((key, v, i))
    rows.append((None, 1.0, 10**6))
    rows.append((None, 3.0, 10**6 + 1))
    return rows, spark.createDataFrame(rows, "k string, v double, id long")


def _brute_lag(rows):
    by = {}
    for k, v, i in rows:
        by.setdefault(k, []).append(v)
    out = {}
    for k, vs in by.items():
        ordered = sorted(vs, key=lambda x: (x is None, x if x is not None else 0))
        out[k] = sorted([(ordered[j], ordered[j - 1] if j else None) for j in range(len(ordered))],
                        key=lambda t: (str(t[0]), str(t[1])))
    return out


def test_lag_matches_brute_force(spark, skewed):
    rows, df = skewed
    got = {}
    for r in lag_within(df, ["k"], "v", out="prev").collect():
        got.setdefault(r["k"], []).append((r["v"], r["prev"]))
    got = {k: sorted(v, key=lambda t: (str(t[0]), str(t[1]))) for k, v in got.items()}
    assert got == _brute_lag(rows)


def test_hot_key_spans_many_partitions(spark, skewed):
    _, df = skewed
    from repolens.operators.ranking import PART, range_sorted
    s = range_sorted(df, ["k"], ["v"])
    parts = s.where(F.col("k") == "hot").select(PART).distinct().count()
    assert parts >= 3


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantile_matches_numpy(spark, skewed, q):
    rows, df = skewed
    got = {r["k"]: r["quantile"] for r in exact_quantile_by(df, ["k"], "v", q).collect()}
    by = {}
    for k, v, _ in rows:
        if v is not None:
            by.setdefault(k, []).append(v)
    want = {}
    for k, vs in by.items():
        a = np.sort(np.array(vs))
        pos = (len(a) - 1) * q
        lo, hi = int(np.floor(pos)), int(np.ceil(pos))
        d = pos - lo
        want[k] = a[lo] * (1 - d) + a[hi] * d
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == want[k], k


def test_positions_are_dense_per_key(spark, skewed):
    rows, df = skewed
    pos = with_position(df, ["k"], ["v"], out="pos")
    agg = pos.groupBy("k").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"),
                               F.count("*").alias("n"), F.countDistinct("pos").alias("d")).collect()
    for r in agg:
        assert r["lo"] == 0 and r["hi"] == r["n"] - 1 and r["d"] == r["n"]


def test_group_of_copies_splits_with_tiebreak(spark):
    """A third of the rows share one (key, value): an id tie-break lets range bounds split them."""
    from repolens.operators.ranking import PART, range_sorted
    rows = [("hot", 5.0, i) for i in range(1500)] + [(f"k{i % 30}", float(i % 97), 10000 + i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v double, id long")
    plain = range_sorted(df, ["k"], ["v"]).where("k = 'hot'").select(PART).distinct().count()
    split = range_sorted(df, ["k"], ["v"], ["id"]).where("k = 'hot'").select(PART).distinct().count()
    assert plain == 1 and split >= 2
    q = {r["k"]: r["quantile"] for r in exact_quantile_by(df, ["k"], "v", 0.5, tiebreak=["id"]).collect()}
    assert q["hot"] == 5.0
    lag = lag_within(df.where("k = 'hot'"), ["k"], "v", out="prev", tiebreak=["id"])
    prevs = [r["prev"] for r in lag.collect()]
    assert prevs.count(None) == 1 and prevs.count(5.0) == 1499


def test_lag_plan_has_no_shuffle_of_the_big_side(spark, skewed):
    """After the range-sorted checkpoint, the previous-row pass and the stitch move no big data."""
    _, df = skewed
    plan = lag_within(df, ["k"], "v", out="prev", bounded_keys=True)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    i = next(n for n, line in enumerate(lines) if "MapInArrow" in line)
    depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
    below = []
    for line in lines[i + 1:]:
        d = len(line) - len(line.lstrip(" :+-"))
        if d <= depth:
            break
        below.append(line)
    assert any("Scan ExistingRDD" in line for line in below)      # reads the checkpoint directly
    assert not any("Exchange" in line for line in below)          # no shuffle between them
    assert "BroadcastHashJoin" in plan


def test_range_sort_keeps_callers_cache(spark, skewed):
    from repolens.operators.ranking import range_sorted
    _, df = skewed
    mine = df.cache()
    mine.count()
    range_sorted(mine, ["k"], ["v"])
    assert mine.is_cached
    mine.unpersist()


def test_lag_without_keys_is_one_sequence(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 3, 2, 4, 3]], "v double")
    got = sorted((r["v"], r["prev"]) for r in lag_within(df, [], "v", out="prev").collect())
    assert got == [(1.0, None), (2.0, 1.0), (3.0, 2.0), (3.0, 3.0), (4.0, 3.0), (5.0, 4.0)]
