"""Materialised models, the persisted upsert, exports, guarded lookups."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from repolens.schemas import REST_RELEASE
from repolens.sinks.upsert import current_folders, obsolete_folders, read_current, read_log, read_rejects, upsert_parquet
from repolens.sinks.writers import export_models, materialize, model_version, read_model, write_counted
from repolens.sources.tables import existing_or_empty
from tests.fixtures import RELEASE_FIXTURES

SCHEMA = "id long, v string, fetched_at string"


def table(spark, root):
    return {(r.id, r.v) for r in read_current(spark, root).collect()}


def test_upsert_idempotent_and_later_load_wins(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "releases")
    b1 = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (2, "b2", "2024-01-02")], SCHEMA)
    assert read_current(spark, root) is None
    assert upsert_parquet(spark, root, b1, ["id"], ["fetched_at"]).rows == 2
    assert table(spark, root) == {(1, "a"), (2, "b2")}
    # older, equal and NULL stamps: the later load wins all the same
    b2 = spark.createDataFrame([(1, "a2", "2020-01-01"), (2, "b3", None), (3, "c", "2024-02-01")], SCHEMA)
    for version in (2, 3):                                       # the second time: a rerun of the same load
        assert upsert_parquet(spark, root, b2, ["id"], ["fetched_at"]).version == version
        assert table(spark, root) == {(1, "a2"), (2, "b3"), (3, "c")}


def test_upsert_keeps_columns_a_load_lacks(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    upsert_parquet(spark, root, spark.createDataFrame([(i, f"v{i}", f"x{i}") for i in range(40)], "id long, v string, extra string"), ["id"], ["v"])
    upsert_parquet(spark, root, spark.createDataFrame([(1, "new")], "id long, v string"), ["id"], ["v"])
    upsert_parquet(spark, root, spark.createDataFrame([(2, "new", 5)], "id long, v string, more int"), ["id"], ["v"])
    rows = {r.id: r for r in read_current(spark, root).collect()}
    assert len(rows) == 40 and rows[7].extra == "x7" and rows[7].more is None
    assert (rows[1].v, rows[1].extra) == ("new", None) and (rows[2].v, rows[2].more) == ("new", 5)
    typed = read_current(spark, root, spark.createDataFrame([], "id long, extra string, absent long").schema)
    assert typed.columns == ["id", "extra", "absent"] and typed.where("absent is not null").count() == 0


def test_upsert_rejects_null_keys(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    rows = [(1, "a", "x"), (None, "b", "x"), (None, "c", "x"), (None, "c", "x")]
    done = upsert_parquet(spark, root, spark.createDataFrame(rows, SCHEMA), ["id"], ["fetched_at"])
    assert (done.rows, done.rejected) == (1, 3) and sorted(r.v for r in read_rejects(spark, root, done.version).collect()) == ["b", "c", "c"]
    none = upsert_parquet(spark, root, spark.createDataFrame([], SCHEMA), ["id"], ["fetched_at"])
    assert none.rows == 1 and table(spark, root) == {(1, "a")}
    only = upsert_parquet(spark, os.path.join(tmpdir_path, "u"), spark.createDataFrame(rows[1:], SCHEMA), ["id"], ["fetched_at"])
    assert (only.rows, only.rejected) == (0, 3)


def test_upsert_rewrites_only_touched_buckets(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    upsert_parquet(spark, root, spark.createDataFrame([(i, "a", "1") for i in range(200)], SCHEMA), ["id"], ["fetched_at"])
    before = current_folders(spark, root)
    upsert_parquet(spark, root, spark.createDataFrame([(5, "b", "2")], SCHEMA), ["id"], ["fetched_at"])
    after = current_folders(spark, root)
    assert len(before) == 32 and sum(before[b] != after[b] for b in before) == 1
    assert obsolete_folders(spark, root, keep=2) == []
    assert obsolete_folders(spark, root, keep=1) == [p for b, p in before.items() if after[b] != p]


def test_a_failed_load_leaves_the_table(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "t")
    upsert_parquet(spark, root, spark.createDataFrame([(1, "a", "1")], SCHEMA), ["id"], ["fetched_at"])
    bad = spark.createDataFrame([(1, "b", "2")], SCHEMA).withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception):
        upsert_parquet(spark, root, bad, ["id"], ["fetched_at"])
    assert table(spark, root) == {(1, "a")} and read_log(spark, root).count() == 1
    upsert_parquet(spark, root, spark.createDataFrame([(1, "c", "0")], SCHEMA), ["id"], ["fetched_at"])
    assert table(spark, root) == {(1, "c")}


def test_materialize_keeps_the_old_model_until_the_new_one_is_whole(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "m")
    assert model_version(spark, path) is None
    with pytest.raises(ValueError):
        read_model(spark, path)
    materialize(spark.range(3), path=path)
    materialize(read_model(spark, path).union(spark.range(10, 12)), path=path)      # from its own last version
    assert sorted(r.id for r in read_model(spark, path).collect()) == [0, 1, 2, 10, 11]
    with pytest.raises(Exception):
        materialize(spark.range(5).withColumn("id", F.raise_error(F.lit("no")).cast("long")), path=path)
    assert read_model(spark, path).count() == 5
    with pytest.raises(ValueError):
        materialize(spark.range(1))


def test_export_models_skips_missing_and_survives_errors(spark, tmpdir_path):
    out = os.path.join(tmpdir_path, "exports")
    text = "broken model " + "x" * 500

    def boom():
        raise RuntimeError(text)
    report = export_models(spark, {
        "stg_releases": lambda: spark.createDataFrame(RELEASE_FIXTURES, REST_RELEASE),
        "not_there": "no_such_table_xyz",
        "broken": boom,
    }, out)
    assert report["stg_releases"] == 3
    assert report["not_there"] == "missing"
    assert report["broken"] == f"error: RuntimeError: {text}"      # the whole text
    assert spark.read.parquet(os.path.join(out, "stg_releases.parquet")).count() == 3


def test_write_counted_observes_rows(spark, tmpdir_path):
    n = write_counted(spark.range(123).withColumn("x", F.lit(1)), os.path.join(tmpdir_path, "o"))
    assert n == 123


def test_existing_or_empty(spark, tmpdir_path):
    schema = spark.createDataFrame([], "name_with_owner string").schema
    missing = ["no_such_table_abc", os.path.join(tmpdir_path, "missing")]
    df = existing_or_empty(spark, missing, schema)
    assert df.count() == 0 and df.columns == ["name_with_owner"]
    there = os.path.join(tmpdir_path, "there")
    spark.createDataFrame([("a/b",)], "name_with_owner string").write.parquet(there)
    assert existing_or_empty(spark, [*missing, there], schema).count() == 1
    spark.createDataFrame([(1,)], "other long").createOrReplaceTempView("repolens_odd_view")
    with pytest.raises(AnalysisException):                         # it exists but lacks the column
        existing_or_empty(spark, ["repolens_odd_view"], schema)


def test_a_merge_is_one_shuffle_and_hot_keys_are_combined_first(spark):
    from repolens.sinks.upsert import _merged, merge_latest
    stored = spark.range(0, 300).selectExpr("id", "'old' v", "CAST(NULL AS string) fetched_at", "id extra")
    load = spark.range(0, 2000).selectExpr("IF(id < 1500, id % 7, id - 1400) id", "CONCAT('v', id % 900) v", "IF(id % 3 = 0, NULL, CAST(id % 50 AS string)) fetched_at")
    want = sorted(map(str, merge_latest(stored, load, ["id"], ["fetched_at"]).collect()))
    for hot in (10_000, 100):                                   # 7 keys have 214 rows or more each
        got = _merged(stored, load, ["id"], ["fetched_at"], 4, 2300, hot_rows=hot)
        assert got.where(F.col("_bucket") != F.pmod(F.xxhash64("id"), F.lit(4))).isEmpty()
        assert sorted(map(str, got.drop("_bucket").collect())) == want
    plan = _merged(None, load, ["id"], ["fetched_at"], 4, 2000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1


def test_a_kept_load_is_not_copied(spark, tmpdir_path):
    src, root = os.path.join(tmpdir_path, "src"), os.path.join(tmpdir_path, "t")
    spark.createDataFrame([(1, "a", "1"), (1, "b", "2"), (None, "c", "1"), (None, "c", "1")], SCHEMA).write.parquet(src)
    done = upsert_parquet(spark, root, spark.read.parquet(src), ["id"], ["fetched_at"], kept=True)
    assert tuple(done) == (1, 1, 2) and table(spark, root) == {(1, "b")}
    assert [f for f in os.listdir(f"{root}/_incoming/v=1") if f.startswith("_bucket")] == ["_bucket=-1"] and read_rejects(spark, root, 1).count() == 2
    done = upsert_parquet(spark, root, spark.read.parquet(src).where("id = 1"), ["id"], ["fetched_at"], kept=True)
    assert tuple(done) == (2, 1, 0) and not os.path.exists(f"{root}/_incoming/v=2")


def test_partitioned_models_are_written_without_a_sort(spark, tmpdir_path):
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    rows = spark.range(500).selectExpr("id", "CAST(id % 40 AS int) AS part")
    path = materialize(rows, path=os.path.join(tmpdir_path, "m"), partition_by=["part"])   # more folders than open writers
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "part").collect())) == sorted(map(tuple, rows.collect()))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == before
