"""Incremental load picks up only new pages and merges them by key."""

import json
import os

from repolens.sinks.upsert import read_current
from repolens.streaming.incremental import incremental_upsert


def _land(root, repo, page, rows):
    d = os.path.join(root, "entity=releases", f"repo={repo.replace('/', '__')}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, page), "w") as f:
        json.dump(rows, f)


def test_incremental_available_now(spark, tmpdir_path):
    landing = os.path.join(tmpdir_path, "landing")
    target = os.path.join(tmpdir_path, "releases")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    _land(landing, "o/r", "p1.json", [{"id": 1, "tag_name": "v1", "fetched_at": "2024-01-01"},
                                     {"id": 2, "tag_name": "v2", "fetched_at": "2024-01-01"}])
    incremental_upsert(spark, landing, "releases", target, ckpt).awaitTermination(120)
    assert read_current(spark, target).count() == 2
    _land(landing, "o/r", "p2.json", [{"id": 2, "tag_name": "v2-fixed", "fetched_at": "2024-01-02"},
                                     {"id": 3, "tag_name": "v3", "fetched_at": "2024-01-02"}])
    incremental_upsert(spark, landing, "releases", target, ckpt).awaitTermination(120)
    with open(os.path.join(landing, "entity=releases", "repo=o__r", "p3.json"), "w") as f:
        f.write("[{broken")
    incremental_upsert(spark, landing, "releases", target, ckpt).awaitTermination(120)
    rejects = spark.read.parquet(os.path.join(target, "_page_rejects"))
    assert rejects.count() == 1
    got = {r["id"]: r["tag_name"] for r in read_current(spark, target).collect()}
    assert got == {1: "v1", 2: "v2-fixed", 3: "v3"}
    assert all(r["repository_full_name"] == "o/r" for r in read_current(spark, target).collect())


def test_stream_of_landed_supplied_table_equals_batch_merge(spark, tmpdir_path):
    """Releases from the supplied `orders` table, landed in two drops and streamed in two runs."""
    from pyspark.sql import functions as F
    from repolens.plans import adapters as ad
    from repolens.sinks.upsert import merge_latest
    from repolens.sources.landing import read_pages
    from tests.conftest import SF_SMALL

    landing = os.path.join(tmpdir_path, "landing")
    raw = ad.releases_raw(spark, SF_SMALL).withColumn("repo", F.regexp_replace("repository_full_name", "/", "__"))
    w = lambda df, d: (df.write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
                       .partitionBy("repo").mode("append").json(os.path.join(landing, "entity=releases", d)))
    w(raw.where(F.col("prerelease")), "drop=1")
    target, ckpt = os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "c")
    incremental_upsert(spark, landing, "releases", target, ckpt).awaitTermination(180)
    w(raw.where(~F.col("prerelease")), "drop=2")
    incremental_upsert(spark, landing, "releases", target, ckpt).awaitTermination(180)
    streamed = read_current(spark, target)
    batch, _ = read_pages(spark, landing, "releases")
    expected = merge_latest(None, batch.drop("_source_file"), ["id"], ["fetched_at"])
    cols = sorted(expected.columns)
    assert streamed.count() == raw.count()
    assert sorted(map(tuple, streamed.select(cols).collect()), key=str) == \
        sorted(map(tuple, expected.select(cols).collect()), key=str)


def test_files_of_lines_are_streamed_line_by_line(spark, tmpdir_path):
    from pyspark.sql import functions as F
    from repolens.streaming.incremental import stream_pages
    folder = os.path.join(tmpdir_path, "landing", "entity=releases", "repo=o__r")
    os.makedirs(folder)
    rows = [{"id": i, "tag_name": f"v{i}", "fetched_at": "2024-01-01", "body": "x" * 2000} for i in range(400)]
    with open(os.path.join(folder, "a.jsonl"), "w") as f:
        f.write("\n".join(map(json.dumps, rows)))
    with open(os.path.join(folder, "b.json"), "w") as f:
        json.dump([{"id": 1000, "tag_name": "page"}, {"id": 1001, "tag_name": "page"}], f)
    seen = []

    def count(batch, _):
        seen.append((batch.count(), batch.groupBy(F.spark_partition_id()).count().count()))

    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "100k")
    try:
        q = stream_pages(spark, os.path.join(tmpdir_path, "landing"), "releases").writeStream.foreachBatch(count)
        q.option("checkpointLocation", os.path.join(tmpdir_path, "c")).trigger(availableNow=True).start().awaitTermination(120)
        assert seen[0][0] == 401 and seen[0][1] > 4  # one row a line, one the page, in more than one task
        incremental_upsert(spark, os.path.join(tmpdir_path, "landing"), "releases", os.path.join(tmpdir_path, "t"), os.path.join(tmpdir_path, "c2")).awaitTermination(120)
    finally:
        spark.conf.set(key, old)
    assert sorted(r["id"] for r in read_current(spark, os.path.join(tmpdir_path, "t")).collect()) == [*range(400), 1000, 1001]
