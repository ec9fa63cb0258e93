"""What a job doesn't store is counted and kept with its reason; old versions and loads can be listed."""

import json
import os

from repolens.plans.legacy import run_legacy_job
from repolens.sinks.upsert import obsolete_loads, read_changes, read_current, upsert_parquet
from repolens.sinks.writers import materialize, obsolete_versions, read_model
from repolens.sources.landing import read_pages


def land(root, entity, text):
    folder = f"{root}/landing/entity={entity}/repo=all"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/p{len(os.listdir(folder))}.json", "w") as f:
        f.write(text if isinstance(text, str) else json.dumps(text))


def test_legacy_job_keeps_its_rejects(spark, tmp_path):
    land(tmp_path, "gql_repositories", [{"databaseId": 1, "nameWithOwner": "a/x", "stargazerCount": 1}, {"databaseId": "one"}, {"nameWithOwner": "a/noid"}])
    land(tmp_path, "gql_pull_requests", [{"databaseId": 10, "repo": "a/x", "number": 1}, {"databaseId": 11, "repo": "b/unknown"}, {"databaseId": 12},
                                         {"repo": "a/x"}, {"databaseId": 13, "commits": 7}, 5])
    land(tmp_path, "gql_pull_requests", "[{broken")
    land(tmp_path, "gql_releases", [{"databaseId": 20, "repo": "b/unknown"}])
    warehouse = f"{tmp_path}/wh"
    before = spark.sql("SELECT current_timestamp()").first()[0]
    assert run_legacy_job(spark, f"{tmp_path}/landing", warehouse) == {"repositories": 1, "pull_requests": 1, "releases": 0}
    rows = {(r.entity, r.outcome): r.n for r in read_model(spark, f"{warehouse}/summary").collect()}
    assert rows == {("repositories", "stored"): 1, ("repositories", "a key does not fit its type"): 1, ("repositories", "no id"): 1,
                    ("pull_requests", "stored"): 1, ("pull_requests", "no stored repository"): 2, ("pull_requests", "no id"): 1,
                    ("pull_requests", "a key does not fit its type"): 1, ("pull_requests", "not an object"): 1, ("pull_requests", "unreadable page"): 1,
                    ("releases", "stored"): 0, ("releases", "no stored repository"): 1}
    stamps = [r["collected_at"] for t in ("repositories", "pull_requests") for r in read_current(spark, f"{warehouse}/{t}").collect()]
    assert stamps and all(before <= t <= spark.sql("SELECT current_timestamp()").first()[0] for t in stamps)  # F13
    kept = read_model(spark, f"{warehouse}/rejects/pull_requests").where("_reason = 'no stored repository'").collect()
    assert sorted(json.loads(r["_corrupt_record"])["databaseId"] for r in kept) == [11, 12]


def test_staged_parse_reads_each_side_alone(spark, tmp_path):
    land(tmp_path, "releases", [{"id": 1, "tag_name": "v1"}, {"id": "x"}, {"id": 2}])
    plain = read_pages(spark, f"{tmp_path}/landing", "releases")
    once = read_pages(spark, f"{tmp_path}/landing", "releases", stage=f"{tmp_path}/stage")
    for a, b in zip(plain, once):
        assert sorted(map(str, a.drop("fetched_at").collect())) == sorted(map(str, b.drop("fetched_at").collect()))
    for side in once:
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "from_json" not in plan and "PartitionFilters: [" in plan and "_reject" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_old_loads_and_versions_are_listed(spark, tmp_path):
    root = f"{tmp_path}/t"
    for i in range(4):
        upsert_parquet(spark, root, spark.createDataFrame([(1, i), (None, i)], "id long, v long"), ["id"], ["v"], buckets=2, changes=True)
        materialize(spark.range(i + 1), path=f"{tmp_path}/m")
    assert obsolete_loads(spark, root, keep=2) == [f"{root}/{k}/v={v}" for k in ("_incoming", "_changes") for v in (1, 2)]
    assert obsolete_versions(spark, f"{tmp_path}/m", keep=2) == [f"{tmp_path}/m/v={v}" for v in (1, 2)] and obsolete_versions(spark, f"{tmp_path}/none") == []
    assert sorted((r["_change"], r["v"]) for r in read_changes(spark, root, 4).collect()) == [(-1, 2), (1, 3)]
    assert read_changes(spark, root, 9) is None
