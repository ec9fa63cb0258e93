"""M9-M12, P8, P9, P14, P16, W3 caps, Q1-Q3 violations on small fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from repolens.operators.joins import existence_flag
from repolens.operators.project import split_owner_name
from repolens.operators.quality import (TableTests, accepted_values_violations, not_null_violations, summarize,
                                        unique_violations, violations)
from repolens.operators.windows import recent_n_per_key
from repolens.plans.issues import clean_issues
from repolens.plans.legacy import enrich_pull_requests, enrich_releases, select_repositories
from repolens.schemas import GQL_PULL_REQUEST, GQL_RELEASE, GQL_REPOSITORY


def repos(spark):
    rows = [
        dict(databaseId=1, nameWithOwner="a/wallet", description="ledger wallet", stargazerCount=50,
             isArchived=False, repositoryTopics={"nodes": [{"topic": {"name": "ledger"}}]}),
        dict(databaseId=2, nameWithOwner="b/wallet", description="a wallet", stargazerCount=40, isArchived=True,
             repositoryTopics={"nodes": [{"topic": {"name": "ledger"}}]}),
        dict(databaseId=3, nameWithOwner="c/node", description="node", stargazerCount=30, isArchived=False,
             repositoryTopics={"nodes": [{"topic": {"name": "ledger"}}, {"topic": {"name": "wallet"}}]}),
        dict(databaseId=4, nameWithOwner="d/wallet", description="ledger wallet", stargazerCount=3,
             isArchived=False, repositoryTopics=None),
    ]
    return spark.createDataFrame(rows, GQL_REPOSITORY)


def test_select_repositories_cap_before_skip(spark):
    existing = spark.createDataFrame([("a/wallet",)], "nameWithOwner string")
    out = select_repositories(repos(spark), existing, "ledger wallet", max_repos=2)
    # candidates (not archived, all terms in name/description/topics): a(50), c(30), d(3); cap 2 -> a, c;
    # a is already loaded but still used up the budget -> only c
    assert [r["nameWithOwner"] for r in out.collect()] == ["c/node"]
    r = out.collect()[0]
    assert r["topics"] == ["ledger", "wallet"] and r["repo_database_id"] == 3
    both = select_repositories(repos(spark), None, "ledger wallet", max_repos=None, include_archived=True,
                               min_stars=10)
    assert sorted(r["nameWithOwner"] for r in both.collect()) == ["a/wallet", "b/wallet", "c/node"]
    assert select_repositories(repos(spark), None, max_repos=0).count() == 0      # 0 takes none
    assert select_repositories(repos(spark), None, max_repos=-1).count() == 0
    assert select_repositories(repos(spark), None).count() == 3                   # no cap


def test_select_repositories_qualifiers(spark):
    names = lambda text, **kw: sorted(r["nameWithOwner"] for r in select_repositories(repos(spark), None, text, **kw).collect())
    assert names("wallet stars:<50") == ["c/node", "d/wallet"]
    assert names("stars:3..30") == ["c/node", "d/wallet"] and names("stars:>3 stars:<50") == ["c/node"]
    assert names("archived:true") == ["b/wallet"] and names("archived:false") == ["a/wallet", "c/node", "d/wallet"]
    with pytest.raises(ValueError):
        names("wallet topic:x")


def test_enrich_pull_requests(spark):
    prs = spark.createDataFrame([
        dict(databaseId=10, number=1, title="t", state="OPEN", repo="a/wallet",
             author={"login": "x", "name": "X", "email": None, "company": "c", "location": None},
             baseRefName="main", headRefName="f", commits=None,
             labels={"nodes": [{"name": "bug", "color": None, "description": None}]},
             assignees={"nodes": [{"login": "u1", "name": None}]}, milestone=None),
        dict(databaseId=11, number=2, title="t2", state="MERGED", repo="c/node", author=None,
             commits={"totalCount": 4}, labels={"nodes": []}, assignees=None, milestone={"title": "m1"}),
        dict(databaseId=12, number=3, title="t3", state="OPEN", repo="zzz/unknown"),
    ], GQL_PULL_REQUEST)
    out = {r["database_id"]: r for r in enrich_pull_requests(prs, repos(spark)).collect()}
    assert set(out) == {10, 11}                        # no repository -> no row (FK join)
    assert out[10]["author__login"] == "x" and out[10]["commit_count"] == 0
    assert out[10]["labels_list"] == ["bug"] and out[10]["assignees_list"] == ["u1"]
    assert out[10]["labels_json"] == '[{"name":"bug","color":null,"description":null}]'
    assert out[11]["author__login"] is None and out[11]["commit_count"] == 4
    assert out[11]["milestone_title"] == "m1" and out[11]["assignees_list"] == []
    assert out[11]["repo_database_id"] == 3
    assert set(prs.columns) <= set(out[10].asDict())     # the record's own fields
    many = prs.where("databaseId = 10").withColumn("labels", F.struct(F.array_repeat(F.col("labels.nodes")[0], 30).alias("nodes")))
    assert len(enrich_pull_requests(many, repos(spark)).first()["labels_list"]) == 30
    assert len(enrich_pull_requests(many, repos(spark), labels_cap=20).first()["labels_list"]) == 20


def test_enrich_releases_assets(spark):
    rel = spark.createDataFrame([
        dict(databaseId=1, tagName="v1", repo="a/wallet", author={"login": "r", "name": None},
             releaseAssets={"nodes": [{"name": f"f{i}", "size": i} for i in range(12)]}),
        dict(databaseId=2, tagName="v2", repo="a/wallet", author=None, releaseAssets=None),
    ], GQL_RELEASE)
    out = {r["database_id"]: r for r in enrich_releases(rel, repos(spark)).collect()}
    assert out[1]["assets_count"] == 12 and len(out[1]["assets_data"]) == 12   # complete
    assert out[1]["tagName"] == out[1]["tag_name"] == "v1" and "publishedAt" in out[1].asDict()   # the record's own fields
    capped = {r["database_id"]: r for r in enrich_releases(rel, repos(spark), assets_cap=10).collect()}
    assert capped[1]["assets_count"] == 10 and len(capped[1]["assets_data"]) == 10
    assert out[2]["assets_count"] == 0 and out[2]["author__login"] is None


def test_split_owner_name(spark):
    df = spark.createDataFrame([("a/b",), ("solo",), ("x/y/z",), (None,)], "full string")
    good, bad = split_owner_name(df, "full")
    assert [(r["owner"], r["name"]) for r in good.collect()] == [("a", "b")]
    assert bad.count() == 3


def test_recent_n_caps(spark):
    df = spark.range(10).select(F.lit("r").alias("k"), F.col("id"))
    order = [F.col("id").desc()]
    assert recent_n_per_key(df, ["k"], order, 3).count() == 3
    assert recent_n_per_key(df, ["k"], order, 0).count() == 10      # 0 = unlimited
    assert recent_n_per_key(df, ["k"], order, None).count() == 10
    assert recent_n_per_key(df, ["k"], order, -1).count() == 0      # negative = none


def test_recent_n_uses_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id"))
    plan = recent_n_per_key(df, ["k"], [F.col("id").desc()], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_clean_issues_cap_and_merge(spark):
    T = dt.datetime
    iss = spark.createDataFrame(
        [(i, "t", "o/r", "open", T(2024, 1, i), T(2024, 2, 1)) for i in range(1, 8)],
        "id long, title string, repository_full_name string, state string, updated_at timestamp_ntz, "
        "fetched_at timestamp_ntz")
    out = clean_issues(iss, max_per_repo=3)
    assert sorted(r["id"] for r in out.collect()) == [5, 6, 7]
    old = iss.where("id = 7").withColumn("title", F.lit("old")).withColumn("fetched_at", F.lit(T(2023, 1, 1)))
    merged = {r["id"]: r["title"] for r in clean_issues(iss, max_per_repo=3, existing=old).collect()}
    assert merged[7] == "t"


def test_existence_flag_three_valued(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id long, k string")
    with_null = spark.createDataFrame([("a",), (None,)], "k string")
    without = spark.createDataFrame([("a",)], "k string")
    got = {r["id"]: r["f"] for r in existence_flag(df, with_null, "k", "f").collect()}
    assert got == {1: True, 2: None, 3: None}
    none = spark.createDataFrame([], "k string")
    only_null = spark.createDataFrame([(None,)], "k string")
    for listed, want in [(with_null, {1: True, 2: None, 3: None}), (without, {1: True, 2: None, 3: False}),
                         (none, {1: False, 2: False, 3: False}), (only_null, {1: None, 2: None, 3: None})]:
        for small in (True, False):
            assert {r["id"]: r["f"] for r in existence_flag(df, listed, "k", "f", small=small).collect()} == want


def test_quality_violations(spark):
    df = spark.createDataFrame([(1, "feature"), (1, "bogus"), (None, None), (2, "test")], "id long, c string")
    assert not_null_violations(df, "id").count() == 1
    assert unique_violations(df, "id").collect()[0]["n_records"] == 2
    assert accepted_values_violations(df, "c", ["feature", "test"]).count() == 1   # NULL is not a violation
    s = {(r["test"], r["column_name"]): r["failures"] for r in
         summarize(df, TableTests("t", not_null=["id", "c"], unique=["id"],
                                  accepted_values={"c": ["feature", "test"]})).collect()}
    assert s == {("not_null", "id"): 1, ("not_null", "c"): 1, ("unique", "id"): 1, ("accepted_values", "c"): 1}
    tests = TableTests("t", not_null=["id", "c"], unique=["id", "c"], accepted_values={"c": ["feature", "test"]})
    rows = {k: v.count() for k, v in violations(df, tests).items()}
    assert rows == {("not_null", "id"): 1, ("not_null", "c"): 1, ("unique", "id"): 1, ("unique", "c"): 0, ("accepted_values", "c"): 1}
    assert {(r["test"], r["column_name"]): r["failures"] for r in summarize(df, tests).collect()} == rows
    empty = {r["failures"] for r in summarize(df.limit(0), tests).collect()}
    assert empty == {0}


def test_summary_reads_the_table_once(spark, tmpdir_path):
    spark.range(10).withColumn("c", F.lit("x")).write.parquet(tmpdir_path + "/t")
    df = summarize(spark.read.parquet(tmpdir_path + "/t"), TableTests("t", not_null=["id", "c"], unique=["id"], accepted_values={"c": ["x"]}))
    assert df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan") == 1


def test_run_legacy_job_one_pass(spark, tmpdir_path):
    import json
    import os
    from repolens.plans.legacy import run_legacy_job
    from repolens.sinks.upsert import read_current

    def land(entity, rows):
        d = os.path.join(tmpdir_path, "landing", f"entity={entity}", "repo=all")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, "p1.json"), "w") as f:
            json.dump(rows, f)
    land("gql_repositories", [
        {"databaseId": 1, "nameWithOwner": "a/wallet", "description": "ledger wallet", "stargazerCount": 9,
         "isArchived": False, "repositoryTopics": {"nodes": [{"topic": {"name": "ledger"}}]}},
        {"databaseId": 2, "nameWithOwner": "b/wallet", "description": "ledger wallet", "stargazerCount": 5,
         "isArchived": True}])
    land("gql_pull_requests", [
        {"databaseId": 10, "number": 1, "title": "x", "repo": "a/wallet", "commits": {"totalCount": 2}},
        {"databaseId": 11, "number": 2, "title": "y", "repo": "b/wallet"}])
    land("gql_releases", [{"databaseId": 20, "tagName": "v1", "repo": "a/wallet",
                           "releaseAssets": {"nodes": [{"name": "f"}]}}])
    wh = os.path.join(tmpdir_path, "wh")
    counts = run_legacy_job(spark, os.path.join(tmpdir_path, "landing"), wh, search="ledger wallet")
    assert counts == {"repositories": 1, "pull_requests": 1, "releases": 1}
    pr = read_current(spark, os.path.join(wh, "pull_requests")).collect()[0]
    assert pr["repo_database_id"] == 1 and pr["commit_count"] == 2 and pr["collected_at"] is not None
    # second run: a/wallet is stored and skipped, nothing new to select; children still join to it
    again = run_legacy_job(spark, os.path.join(tmpdir_path, "landing"), wh, search="ledger wallet")
    assert again == {"repositories": 1, "pull_requests": 1, "releases": 1}


def test_recent_n_above_group_limit_threshold_is_exact(spark):
    """Above the group-limit threshold the cap uses range-sorted positions; same rows as the window."""
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    old = spark.conf.get(key)
    df = spark.range(3000).select((F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        (F.col("id") % 7).cast("string"))).alias("k"), (F.col("id") % 500).alias("t"), F.col("id"))
    order = [F.col("t").desc(), F.col("id").desc()]
    want = {(r["k"], r["id"], r["rn"]) for r in recent_n_per_key(df, ["k"], order, 50).collect()}
    try:
        spark.conf.set(key, "10")
        got = {(r["k"], r["id"], r["rn"]) for r in recent_n_per_key(df, ["k"], order, 50).collect()}
    finally:
        spark.conf.set(key, old)
    assert got == want and len(got) == 50 * 8
