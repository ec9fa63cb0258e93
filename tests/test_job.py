"""Landed pages through every layer to the export folder."""

import json
import os

import pytest

from repolens.plans.job import EXPORTED_MODELS, run_job
from repolens.sinks.writers import read_model
from tests.fixtures import PR_FIXTURES, RELEASE_FIXTURES


def _land(root, entity, repo, page, rows):
    d = os.path.join(root, f"entity={entity}", f"repo={repo.replace('/', '__')}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, page), "w") as f:
        json.dump(rows, f)


def test_run_job_end_to_end(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    prs = [dict(r, repository_full_name=None) for r in PR_FIXTURES]
    _land(landing, "pull_requests", "acme/engine", "p1.json", prs)
    _land(landing, "pull_requests", "input-output-hk/lace", "p1.json",
          [dict(PR_FIXTURES[1], id=900 + i, title="Add thing", closed_at=f"2024-0{i}-01T00:00:00Z",
                repository_full_name=None) for i in range(1, 4)])
    _land(landing, "releases", "acme/engine", "p1.json", [*RELEASE_FIXTURES, {"id": None}, {"id": "bad"}])
    _land(landing, "repositories", "acme/engine", "p1.json", {"id": 5, "full_name": "acme/engine", "forks": 3})
    wh, ex = os.path.join(tmpdir_path, "wh"), os.path.join(tmpdir_path, "exports")
    out = run_job(spark, landing, wh, ex)
    assert out["raw_rows"] == {"repositories": 1, "pull_requests": 8, "releases": 3, "issues": 0}
    assert out["rejects"] == {"repositories": 0, "pull_requests": 0, "releases": 2}     # a wrong type and a NULL key
    assert all(v == 0 for v in out["checks"].values()) and len(out["checks"]) == 22
    assert read_model(spark, os.path.join(wh, "checks")).count() == 22
    assert all(isinstance(n, int) for n in out["gold"].values()), out["gold"]
    repo = read_model(spark, os.path.join(wh, "bronze", "stg_github_repositories")).collect()
    assert [(r["id"], r["full_name"]) for r in repo] == [(5, "acme/engine")] and json.loads(repo[0]["_raw"])["forks"] == 3
    assert set(out["export"]) == set(EXPORTED_MODELS)
    assert all(isinstance(v, int) for v in out["export"].values()), out["export"]
    med = spark.read.parquet(os.path.join(ex, "median_feature_prs_lace_vs_top10.parquet")).collect()
    got = {r["repository"]: r["median_days_between_feature_prs"] for r in med}
    assert got["input-output-hk/lace"] == 30.0   # gaps Jan->Feb 31 days, Feb->Mar 29 days
    # rerun with the same landing: idempotent
    again = run_job(spark, landing, wh, None)
    assert again["raw_rows"] == out["raw_rows"] and again["gold"] == out["gold"]


def test_run_job_without_landing(spark, tmpdir_path):
    os.makedirs(os.path.join(tmpdir_path, "landing"))
    out = run_job(spark, os.path.join(tmpdir_path, "landing"), os.path.join(tmpdir_path, "wh"), os.path.join(tmpdir_path, "ex"))
    assert set(out["raw_rows"].values()) == {0} and len(out["checks"]) == 22 and set(out["checks"].values()) == {0}
    assert set(out["gold"].values()) == {0} and set(out["export"].values()) == {0}


def test_one_failing_gold_model_stops_no_other(spark, tmpdir_path, monkeypatch):
    from repolens.plans import job
    landing = os.path.join(tmpdir_path, "landing")
    _land(landing, "releases", "acme/engine", "p1.json", RELEASE_FIXTURES)

    def broken(*a, **kw):
        raise RuntimeError("no median")
    monkeypatch.setattr(job, "median_gap", broken)
    out = job.run_job(spark, landing, os.path.join(tmpdir_path, "wh"), os.path.join(tmpdir_path, "ex"))
    bad = {k for k, v in out["gold"].items() if not isinstance(v, int)}
    assert bad == {"median_feature_prs_lace_vs_top10", "median_releases_lace_vs_top10"} and "no median" in out["gold"][bad.pop()]
    assert out["gold"]["feature_releases_monthly"] == 2 and len(out["export"]) == 6


def test_run_job_caps_allow_list_and_issues(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    prs = [dict(PR_FIXTURES[0], id=i, repository_full_name=None, updated_at=f"2024-01-{i:02d}T00:00:00Z")
           for i in range(1, 8)]
    _land(landing, "pull_requests", "acme/engine", "p1.json", prs)
    _land(landing, "pull_requests", "other/repo", "p1.json", [dict(PR_FIXTURES[0], id=50, repository_full_name=None)])
    _land(landing, "releases", "acme/engine", "p1.json", RELEASE_FIXTURES)
    _land(landing, "issues", "acme/engine", "p1.json",
          [{"id": 1, "title": "a", "pull_request": {"url": "u"}}, {"id": 2, "title": "b"},
           {"id": 3, "title": "c", "state": "open"}])
    wh = os.path.join(tmpdir_path, "wh")
    out = run_job(spark, landing, wh, None, repos=["acme/engine"], max_prs_per_repo=3, max_releases_per_repo=0,
                  max_issues_per_repo=-1)
    assert out["raw_rows"] == {"repositories": 0, "pull_requests": 3, "releases": 3, "issues": 0}
    ids = sorted(r["id"] for r in read_model(spark, os.path.join(wh, "silver", "stg_pull_requests")).collect())
    assert ids == [5, 6, 7]   # most recently updated three, other/repo not allowed


def test_presets_and_qualifiers():
    from repolens.plans.presets import PRESETS, split_qualifiers
    free = {"low": None, "high": None, "low_open": False, "high_open": False}
    terms, opts = split_qualifiers(PRESETS["cardano-active"]["search"])
    assert terms == "cardano wallet" and opts == {"pushed": [dict(free, low="2023-01-01T00:00:00", low_open=True)]}
    for text, want in [("stars:>5", dict(free, low=5.0, low_open=True)), ("stars:>=5", dict(free, low=5.0)), ("stars:<10", dict(free, high=10.0, high_open=True)),
                       ("stars:<=10", dict(free, high=10.0)), ("stars:50", dict(free, low=50.0, high=50.0)), ("stars:10..50", {"low": 10.0, "high": 50.0}),
                       ("stars:10..*", {"low": 10.0, "high": None}), ("pushed:<2023-01-01", dict(free, high="2023-01-01T00:00:00", high_open=True))]:
        assert split_qualifiers(f"x {text}") == ("x", {text.split(":")[0]: [want]})
    assert split_qualifiers("archived:true language:rust") == ("", {"archived": True, "language": "rust"})
    for odd in ("topic:x", "stars:many", "pushed:>soon", "archived:maybe", "stars:", "http://x"):
        with pytest.raises(ValueError):
            split_qualifiers(odd)


def test_job_on_landed_supplied_tables_matches_registered_queries(spark, tmpdir_path):
    """Land the PR / release adapters as Spark-written JSON Lines, run every layer, compare gold models."""
    from pyspark.sql import functions as F
    from repolens.plans import adapters as ad
    import __spark_entry__ as E
    from tests.conftest import SF_SMALL

    landing = os.path.join(tmpdir_path, "landing")
    for entity, raw in (("pull_requests", ad.pull_requests_raw(spark, SF_SMALL)),
                        ("releases", ad.releases_raw(spark, SF_SMALL))):
        (raw.withColumn("repo", F.regexp_replace("repository_full_name", "/", "__"))
            .write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            .partitionBy("repo").json(os.path.join(landing, f"entity={entity}")))
    wh = os.path.join(tmpdir_path, "wh")
    run_job(spark, landing, wh, None, focus=ad.ADAPTER_FOCUS, focus_label=ad.ADAPTER_FOCUS_LABEL, k=10,
            member_label="top_10")
    pairs = [("median_feature_prs_lace_vs_top10", "median_gap_prs"),
             ("median_releases_lace_vs_top10", "median_gap_releases"),
             ("feature_prs_lace_vs_top10", "focus_vs_topk_prs"),
             ("feature_releases_monthly", "monthly_releases"),
             ("feature_prs_monthly", "monthly_counts")]
    for model, query in pairs:
        got = read_model(spark, os.path.join(wh, "gold", model))
        want = E.queries()[query](spark, SF_SMALL)
        cols = sorted(want.columns)
        assert sorted(map(tuple, got.select(cols).collect()), key=str) == \
            sorted(map(tuple, want.select(cols).collect()), key=str), model


def test_gold_reads_only_the_feature_partition(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    _land(landing, "pull_requests", "acme/engine", "p1.json", [dict(r, repository_full_name=None) for r in PR_FIXTURES])
    _land(landing, "releases", "acme/engine", "p1.json", RELEASE_FIXTURES)
    wh = os.path.join(tmpdir_path, "wh")
    run_job(spark, landing, wh, None)
    from repolens.plans.gold import monthly_counts
    prs = read_model(spark, os.path.join(wh, "silver", "stg_pull_requests"))
    plan = monthly_counts(prs)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feat_classifier" in plan and "lower(feat_classifier" in plan
    assert "feat_classifier=feature" in os.listdir(os.path.join(wh, "silver", "stg_pull_requests", "v=1"))


def test_layers_are_compressed_closely_and_the_export_as_usual(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    _land(landing, "pull_requests", "acme/engine", "p1.json", [dict(r, repository_full_name=None) for r in PR_FIXTURES])
    _land(landing, "releases", "acme/engine", "p1.json", [*RELEASE_FIXTURES, {"id": None}])
    _land(landing, "issues", "acme/engine", "p1.json", [{"id": 2, "title": "b"}])
    wh, ex = os.path.join(tmpdir_path, "wh"), os.path.join(tmpdir_path, "ex")
    codec = "spark.sql.parquet.compression.codec"
    before = spark.conf.get(codec)
    run_job(spark, landing, wh, ex)
    assert spark.conf.get(codec) == before

    def parts(top):
        return [os.path.join(d, f) for d, _, names in os.walk(top) for f in names if f.startswith("part-")]
    for layer in ("parsed", "raw", "rejects", "bronze", "silver", "gold"):
        found = parts(os.path.join(wh, layer))
        assert found and all(f.endswith(".zstd.parquet") for f in found), layer
    assert parts(ex) and all(f.endswith(f".{before}.parquet") for f in parts(ex))
    assert {json.loads(r["_raw"])["id"] for r in read_model(spark, os.path.join(wh, "bronze", "stg_github_pull_requests")).collect()} == {r["id"] for r in PR_FIXTURES}


class _Landed(Exception):
    pass


@pytest.mark.parametrize("query", ["q_job_tables", "q_job_report"])
def test_job_pages_are_landed_compressed_in_short_files(spark, tmpdir_path, monkeypatch, query):
    import gzip
    from repolens.plans import catalog
    from tests.conftest import SF_SMALL

    def landed(*a, **kw):
        raise _Landed
    monkeypatch.setattr(catalog, "scratch", lambda *_: tmpdir_path)
    monkeypatch.setattr(catalog, "run_job", landed)
    monkeypatch.setitem(catalog.PACKED, "maxRecordsPerFile", 20)
    with pytest.raises(_Landed):
        getattr(catalog, query)(spark, SF_SMALL)
    for entity, table in {"pull_requests": "events", "releases": "orders", "repositories": "customer"}.items():
        files = [os.path.join(d, f) for d, _, names in os.walk(os.path.join(tmpdir_path, "landing", f"entity={entity}")) for f in names if f.startswith("part-")]
        counts = []
        for f in files:
            if f.endswith(".json.gz"):
                with gzip.open(f, "rt") as text:
                    counts.append(sum(1 for _ in text))
            else:
                assert f.endswith(".txt")    # the bad pages
        assert sum(counts) == spark.read.parquet(f"{SF_SMALL}/{table}.parquet").count() and max(counts) <= 20
        assert len(files) - len(counts) == (2 if (query, entity) == ("q_job_report", "pull_requests") else 0)
