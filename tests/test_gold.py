"""M3-M8 semantics on small hand-made silver rows (FIXTURES §6 edge cases)."""

import datetime as dt

import pytest

from repolens.plans.gold import focus_vs_top_k, median_gap, monthly_counts

T = dt.datetime


def silver(spark, rows):
    return spark.createDataFrame(rows, "repository string, closed_at timestamp_ntz, feat_classifier string")


def test_monthly_null_month_is_a_group(spark):
    df = silver(spark, [("a/x", T(2024, 1, 5), "feature"), ("a/x", T(2024, 1, 20), "feature"),
                        ("a/x", None, "feature"), ("a/x", T(2024, 2, 1), "bug fix"),
                        ("b/y", T(2024, 2, 3), "FEATURE")])
    out = sorted(((r[0], r[1], r[2]) for r in monthly_counts(df).collect()), key=str)
    assert out == sorted([("a/x", T(2024, 1, 1), 2), ("a/x", None, 1), ("b/y", T(2024, 2, 1), 1)], key=str)


def test_top_k_tie_goes_to_smaller_key_and_focus_wins(spark):
    rows = []
    for i, n in enumerate([5, 4, 3, 3]):
        rows += [(f"r/{i}", T(2024, 1, 1 + j), "feature") for j in range(n)]
    rows += [("focus/x", T(2024, 3, 1), "feature")]
    df = silver(spark, rows)
    out = {(r["repository"], r["repo_group"]) for r in
           focus_vs_top_k(df, focus="focus/x", focus_label="focus", k=3, member_label="top_3").collect()}
    # r/2 and r/3 tie at rank 3: r/2 (smaller) is in, r/3 is out; focus outside the top 3 still appears
    assert out == {("r/0", "top_3"), ("r/1", "top_3"), ("r/2", "top_3"), ("focus/x", "focus")}
    # focus inside the top k: labelled focus, not top
    out2 = {(r["repository"], r["repo_group"]) for r in
            focus_vs_top_k(df, focus="r/0", focus_label="focus", k=2, member_label="top_2").collect()}
    assert out2 == {("r/0", "focus"), ("r/1", "top_2")}
    # focus absent from the data: no focus row
    out3 = {r["repository"] for r in focus_vs_top_k(df, focus="none/x", k=1).collect()}
    assert out3 == {"r/0"}


def test_null_repository_never_joins_cohort(spark):
    rows = [(None, T(2024, 1, d), "feature") for d in range(1, 6)] + [("a/x", T(2024, 1, 1), "feature")]
    out = {r["repository"] for r in focus_vs_top_k(silver(spark, rows), focus=None, k=10).collect()}
    assert out == {"a/x"}


@pytest.fixture()
def gaps(spark):
    def run(rows, **kw):
        return {r[0]: r[1] for r in median_gap(silver(spark, rows), focus=None, k=10, **kw).collect()}
    return run


def test_median_open_pr_gives_null_row_single_pr_no_row(gaps):
    out = gaps([("one/closed_one_open", T(2024, 1, 1), "feature"), ("one/closed_one_open", None, "feature"),
                ("single/pr", T(2024, 1, 1), "feature")])
    assert out == {"one/closed_one_open": None}


def test_median_even_and_odd_and_equal_timestamps(gaps):
    rows = [("e/x", T(2024, 1, 1), "feature"), ("e/x", T(2024, 1, 2), "feature"),
            ("e/x", T(2024, 1, 5), "feature"),                         # gaps 1, 3 -> median 2
            ("o/x", T(2024, 1, 1), "feature"), ("o/x", T(2024, 1, 2), "feature"),
            ("o/x", T(2024, 1, 4), "feature"), ("o/x", T(2024, 1, 10), "feature"),  # 1, 2, 6 -> 2
            ("z/x", T(2024, 1, 1), "feature"), ("z/x", T(2024, 1, 1), "feature")]  # equal -> 0
    assert gaps(rows) == {"e/x": 2.0, "o/x": 2.0, "z/x": 0.0}


def test_median_rounding_binary_half(gaps):
    # gap of 1.005 days and 0.285 days: rounded on the binary value (1.0, 0.28), not 1.01 / 0.29
    s1 = 1.005 * 86400
    s2 = 0.285 * 86400
    base = T(2024, 1, 1)
    rows = [("a/x", base, "feature"), ("a/x", base + dt.timedelta(seconds=s1), "feature"),
            ("b/x", base, "feature"), ("b/x", base + dt.timedelta(seconds=s2), "feature")]
    out = gaps(rows)
    assert out["a/x"] == round(((base + dt.timedelta(seconds=s1)).timestamp() - base.timestamp()) / 86400.0 * 100) / 100
    assert out["b/x"] == 0.28


def test_median_sub_second(gaps):
    base = T(2024, 1, 1)
    rows = [("a/x", base, "feature"), ("a/x", base + dt.timedelta(microseconds=500000), "feature")]
    out = gaps(rows, digits=8)
    assert out["a/x"] == round(0.5 / 86400.0, 8)


def test_median_approx_opt_in_close_to_exact(spark):
    rows = [("a/x", T(2024, 1, 1) + dt.timedelta(hours=7 * i * i % 97 + i * 24), "feature") for i in range(200)]
    rows += [("a/x", None, "feature")]
    df = silver(spark, rows)
    exact = {r[0]: r[1] for r in median_gap(df, focus=None, k=10).collect()}
    approx = {r[0]: r[1] for r in median_gap(df, focus=None, k=10, approx_accuracy=100000).collect()}
    assert exact.keys() == approx.keys()
    assert abs(exact["a/x"] - approx["a/x"]) <= 1.0   # one rank step at most; gaps are about a day


def test_focus_vs_top_k_reads_rows_once(spark):
    """The rows are scanned once, into the checkpointed monthly aggregate; the plan itself reads no parquet."""
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL
    plan = E.queries()["focus_vs_topk_prs"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    assert plan.count("Scan ExistingRDD") == 2      # ranking and result read the same checkpoint
    assert "BroadcastHashJoin" in plan
