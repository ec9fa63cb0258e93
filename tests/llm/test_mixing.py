import random

import pytest
from pyspark.sql import functions as F

from repolens.llm import mixing as M
from tests.llm.data import empty, odd, prose


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), share=1.5, most=2.0):
    """sizes: {source: size}; give by weight, hold who is above the bound, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, held = share * sum(sizes.values()), {}
    while True:
        left, open_ = total - sum(held.values()), [s for s in names if s not in held]
        got = {s: left * w[s] / sum(w[t] for t in open_) for s in open_}
        above = [s for s in open_ if got[s] > most * sizes[s]]
        if not above:
            return held | got
        held |= {s: most * sizes[s] for s in above}


@pytest.mark.parametrize("seed", range(6))
def test_targets(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i}": rng.choice([0, 3, 50, 1000, 100_000]) * rng.randrange(1, 9) for i in range(rng.randrange(1, 14))}
    if seed % 2:
        sizes[None] = 500
    rows = spark.createDataFrame([(s, n, 4) for s, n in sizes.items()], "source string, source_size long, docs long")
    got = {r.source: r.target for r in M.targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def corpus(spark, seed=1, docs=3000):
    rng = random.Random(seed)
    rows = [(i, prose(rng, min(4000, int(rng.paretovariate(0.9) * 20))), f"s{min(9, int(rng.expovariate(0.5)))}" if rng.random() < 0.95 else None) for i in range(docs)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def test_mix_meets_targets_and_tilts(spark):
    rows, df = corpus(spark)
    out = M.mix(df).collect()
    size = {i: len(t.split()) for i, t, _ in rows}
    total = {}
    for i, _, s in rows:
        total[s] = total.get(s, 0) + size[i]
    goal = brute_targets(total)
    taken, want = {}, {}
    for r in out:
        assert r.size == size[r.id] and 0 <= r.copies <= 2 and r.source_size == total[r.source]
        assert r.target == pytest.approx(goal[r.source])
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        want[r.source] = want.get(r.source, 0) + r.size * r.rate
    for s in goal:
        assert want[s] == pytest.approx(goal[s], rel=1e-6)
        assert abs(taken[s] - goal[s]) <= 0.005 * goal[s] + 20
    # rates are one exponential tilt of the size in each source
    import math
    for s in goal:
        slopes = [math.log(r.rate / (2 - r.rate)) / r.size for r in out if r.source == s and 0.01 < r.rate < 1.99 and abs(r.rate - 1) > 1e-3]
        assert not slopes or max(slopes) == pytest.approx(min(slopes), rel=1e-6, abs=1e-12)
    again = M.mix(df.repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out)) if all(r.source for r in out) else sorted(map(str, again)) == sorted(map(str, out))


def test_small_blocks_still_meet_targets(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_DOCS", 200)
    _, df = corpus(spark, 2)
    for r in M.mix(df).groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("got"), F.first("target").alias("t")).collect():
        assert abs(r.got - r.t) <= 0.01 * r.t + 40


def test_rows_follow_the_mix(spark):
    _, df = corpus(spark, 3, 400)
    copies = {r.id: r.copies for r in M.mix(df).collect()}
    out = M.mixed_rows(df)
    assert out.schema.names == df.schema.names
    seen = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert seen == {i: n for i, n in copies.items() if n}


def test_odd_rows(spark):
    df = odd(spark)
    out = M.mix(df, source_col="source").collect()
    assert len(out) == df.count() and all(0 <= r.copies <= 2 for r in out)
    assert M.mixed_rows(df).schema.names == df.schema.names and M.mixed_rows(df).count() > 0
    assert M.mix(empty(spark)).collect() == [] and M.mixed_rows(empty(spark)).collect() == []
    wordless = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert {(r.id, r.size, r.target) for r in M.mix(wordless).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}
