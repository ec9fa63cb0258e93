"""M1, M2 on fixture-shaped records."""

import json

from repolens.plans.silver import PR_COLUMNS, RELEASE_COLUMNS, silver_pull_requests, silver_releases
from tests.fixtures import PR_FIXTURES, RELEASE_FIXTURES, prs_df, releases_df


def test_silver_pr_columns_and_values(spark):
    out = silver_pull_requests(prs_df(spark))
    assert out.columns == PR_COLUMNS
    rows = {r["id"]: r for r in out.collect()}
    assert {i: r["feat_classifier"] for i, r in rows.items()} == {11: "bug fix", 12: "feature", 13: "refactor", 14: "bug fix", 15: "feature"}
    assert rows[11]["author"] == "sam" and rows[11]["base_branch"] == "trunk" and rows[11]["number"] == 110
    assert rows[14]["base_branch"] is None and rows[14]["additions"] is None  # absent -> NULL
    assert rows[11]["labels_list"] == ["p1", "crash"]
    assert json.loads(rows[11]["labels_json"]) == [{"name": "p1"}, {"name": "crash"}]
    assert rows[12]["closed_at"] is None


def test_labels_null_empty_and_null_field(spark):
    base = dict(PR_FIXTURES[0])
    rows = [dict(base, id=11, labels=None), dict(base, id=12, labels=[]),
            dict(base, id=13, labels=[{"name": None}, {"name": "x"}])]
    out = {r["id"]: r for r in silver_pull_requests(prs_df(spark, rows)).collect()}
    assert out[11]["labels_json"] == "[]" and out[11]["labels_list"] == []
    assert out[12]["labels_json"] == "[]" and out[12]["labels_list"] == []
    assert out[13]["labels_json"] == '[{"name":null},{"name":"x"}]'  # NULL field kept
    assert out[13]["labels_list"] == [None, "x"]


def test_silver_releases_drops_unpublished(spark):
    out = silver_releases(releases_df(spark))
    assert out.columns == RELEASE_COLUMNS
    ids = sorted(r["id"] for r in out.collect())
    assert ids == [71, 72]  # 79 has no published_at
    assert {r["row_num"] for r in out.collect()} == {1}


def test_release_dedup_same_tag(spark):
    base = dict(RELEASE_FIXTURES[0])
    rows = [dict(base, id=10, tag_name="v1", published_at="2024-01-01T00:00:00Z"),
            dict(base, id=11, tag_name="v1", published_at="2024-02-01T00:00:00Z"),   # later wins
            dict(base, id=12, tag_name="v2", published_at="2024-03-01T00:00:00Z"),
            dict(base, id=13, tag_name="v2", published_at="2024-03-01T00:00:00Z"),   # tie -> higher id
            dict(base, id=14, tag_name=None, published_at="2024-03-01T00:00:00Z"),
            dict(base, id=15, tag_name=None, published_at="2024-04-01T00:00:00Z"),   # NULL tag is one group
            dict(base, id=16, tag_name="v1", published_at="2024-05-01T00:00:00Z",
                 repository_full_name="other/repo")]
    out = {(r["repository"], r["tag"], r["id"]) for r in silver_releases(releases_df(spark, rows)).collect()}
    assert out == {("other/repo", "v1", 16), ("acme/engine", None, 15), ("acme/engine", "v1", 11),
                   ("acme/engine", "v2", 13)}


def test_release_dedup_is_partial_aggregate(spark):
    """The keep-latest dedup combines map-side (no whole-group window)."""
    out = silver_releases(releases_df(spark))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "partial" in plan
    assert "Window" not in plan
