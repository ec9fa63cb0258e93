"""Records kept as VARIANT: typed fields, other paths, unknown keys, rejects."""

import json
import os

from pyspark.sql import types as T

from repolens.sources import variant as V

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()),
                       T.StructField("user", T.StructType([T.StructField("login", T.StringType())])),
                       T.StructField("repository_full_name", T.StringType())])


def stored(spark, place, *pages):
    folder = f"{place}/in/entity=things/repo=org__one"
    os.makedirs(folder)
    for i, page in enumerate(pages):
        with open(f"{folder}/{i}.json", "w", encoding="utf-8") as f:
            f.write(page if isinstance(page, str) else json.dumps(page))
    return V.store_records(spark, f"{place}/in", "things", f"{place}/out")


def test_known_and_unknown_keys(spark, tmpdir_path):
    rows = stored(spark, tmpdir_path, [
        {"id": 1, "name": "a", "user": {"login": "u", "age": 3}, "new": {"x": [5, 6]}},
        {"id": 2, "name": None, "new": 7, "odd key, 'quoted'": True}, {"new": None, "repository_full_name": "org/own"}], [])
    records, rejects = V.read_typed(rows, SCHEMA)
    got = sorted(map(tuple, records.select("id", "name", "user.login", "repository_full_name", V.path_value("$.new.x[1]", "int")).collect()), key=str)
    assert got == [(1, "a", "u", "org/one", 6), (2, None, None, "org/one", None), (None, None, None, "org/own", None)]
    assert rejects.collect() == []
    assert sorted(map(tuple, V.unknown_keys(rows, SCHEMA).collect())) == [
        ("new", "BIGINT", 1), ("new", "OBJECT", 1), ("new", "VOID", 1), ("odd key, 'quoted'", "BOOLEAN", 1)]


def test_rejects_keep_their_text(spark, tmpdir_path):
    rows = stored(spark, tmpdir_path, [{"id": 1}, 7, {"id": "five"}, {"id": "5"}, {"user": [1]}], "[{broken", "")
    records, rejects = V.read_typed(rows, SCHEMA)
    assert sorted(r.id for r in records.collect()) == [1, 5]
    assert sorted((r._reason, r._corrupt_record) for r in rejects.collect()) == [
        ("a key does not fit its type", '{"id":"five"}'), ("a key does not fit its type", '{"user":[1]}'),
        ("not an object", "7"), ("unreadable page", "[{broken")]


def test_each_record_is_parsed_once(spark, tmpdir_path):
    rows = stored(spark, tmpdir_path, [{"id": 1}])
    plan = V.read_typed(rows, SCHEMA)[0]._jdf.queryExecution().executedPlan().toString()
    assert "parse" not in plan.lower() and "from_json" not in plan


def test_no_records(spark, tmpdir_path):
    rows = stored(spark, tmpdir_path, "")
    assert V.read_typed(rows, SCHEMA)[0].collect() == [] and V.unknown_keys(rows, SCHEMA).collect() == []


def test_large_pages_of_lines_are_stored_line_by_line(spark, tmpdir_path):
    page = "\n".join(json.dumps({"id": i, "name": "x" * 2000}) for i in range(1000)) + "\n[7]\n"
    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "200k")
    try:
        rows = stored(spark, tmpdir_path, page)
    finally:
        spark.conf.set(key, old)
    good = [n for n in os.listdir(f"{tmpdir_path}/out/_reject=false") if n.startswith("part-")]
    assert len(good) > 3 and rows.where("not _reject").count() == 1000      # one page, several tasks
    assert [(r._json, r._reason) for r in rows.where("_reject").collect()] == [("[7]", "not an object")]


def test_objects_are_told_by_their_text(spark, tmpdir_path, monkeypatch):
    monkeypatch.setattr(V.F, "schema_of_variant", None)     # a whole schema per record is not worked out
    rows = stored(spark, tmpdir_path, ' {"id": 1}', [{"id": 2}, [3], "x"])
    assert sorted(r.id for r in V.read_typed(rows, SCHEMA)[0].collect()) == [1, 2]
    assert sorted((r._json, r._reason) for r in rows.where("_reject").collect()) == [("[3]", "not an object"), ("x", "not JSON")]
