"""Filters and caps over their whole range of arguments."""

import pytest

@pytest.mark.parametrize("state", ["open", "closed", "all"])
def test_state_values_accepted(spark, state):
    from repolens.operators.filters import state_filter
    df = spark.createDataFrame([("open",), ("closed",)], "state string")
    assert state_filter(df, state).count() == (2 if state == "all" else 1)


def test_invalid_state_rejected(spark):
    from repolens.operators.filters import state_filter
    with pytest.raises(ValueError):
        state_filter(spark.createDataFrame([("open",)], "state string"), "merged")


def test_a_cap_keeps_the_newest_of_every_key(spark):
    """Keys of 2, 7 and 23 rows: min(size, cap) of each stay, all without a cap, none below zero."""
    from pyspark.sql import functions as F
    from repolens.operators.windows import recent_n_per_key
    sizes = {"small": 2, "middle": 7, "large": 23}
    df = spark.createDataFrame([(k, i) for k, n in sizes.items() for i in range(n)], "k string, i long").repartition(4)
    for cap in (None, 0, -3, 1, 2, 6, 7, 8, 22, 40):
        got = {(r.k, r.i) for r in recent_n_per_key(df, ["k"], [F.col("i").desc()], cap, rank_col=None).collect()}
        room = lambda n: n if not cap else min(n, max(cap, 0))
        assert got == {(k, n - 1 - j) for k, n in sizes.items() for j in range(room(n))}, cap


def test_cap_is_one_path_for_any_n(spark):
    """A hot key over several input partitions: the same rows whatever the cap."""
    from pyspark.sql import functions as F
    from repolens.operators.windows import recent_n_per_key
    df = spark.range(0, 6000, 1, 6).select(F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 11).cast("string")).alias("k"), F.col("id"))
    want = {}
    for r in df.collect():
        want.setdefault(r.k, []).append(r.id)
    for n in (1, 7, 1500, None):
        got = {(r.k, r.id): r.rn for r in recent_n_per_key(df, ["k"], [F.col("id").desc()], n).collect()}
        assert got == {(k, x): i + 1 for k, ids in want.items() for i, x in enumerate(sorted(ids, reverse=True)[:n])}
