"""F9, F10, F12, N1-N7, O6, O7 edge cases: NULL / empty lists, NULL fields, ties, caps."""

from pyspark.sql import functions as F

from repolens.functions.nested import (cap_nested, child_rows, field_names, nested_count, nested_to_json,
                                       topk_nested)

SCHEMA = "id long, labels array<struct<name:string>>, edges array<struct<size:double,node:struct<name:string>>>"


def _df(spark):
    e = lambda s, n: {"size": s, "node": {"name": n}}
    return spark.createDataFrame([
        (1, None, None),
        (2, [], []),
        (3, [{"name": None}, {"name": "b"}, {"name": "c"}],
         [e(5.0, "x"), e(9.0, "y"), e(5.0, "a"), e(None, "n")]),
    ], SCHEMA)


def test_names_json_count(spark):
    rows = {r["id"]: r for r in _df(spark).select(
        "id", field_names("labels", "name").alias("names"), nested_to_json("labels").alias("js"),
        nested_count("labels").alias("n")).collect()}
    assert rows[1]["names"] == [] and rows[1]["js"] == "[]" and rows[1]["n"] == 0
    assert rows[2]["names"] == [] and rows[2]["js"] == "[]" and rows[2]["n"] == 0
    assert rows[3]["names"] == [None, "b", "c"] and rows[3]["n"] == 3
    assert rows[3]["js"] == '[{"name":null},{"name":"b"},{"name":"c"}]'


def test_topk_and_cap(spark):
    rows = {r["id"]: r for r in _df(spark).select(
        "id", F.transform(topk_nested("edges", "size", 3), lambda x: x["node"]["name"]).alias("top"),
        cap_nested(field_names("labels", "name"), 2).alias("cap")).collect()}
    assert rows[1]["top"] is None and rows[2]["top"] == []
    # largest first; the 5.0 tie falls back to the rest of the element (name y > x > a); NULL size last
    assert rows[3]["top"] == ["y", "x", "a"]
    assert rows[3]["cap"] == [None, "b"] and rows[1]["cap"] == []


def test_child_rows_skip_null_and_empty(spark):
    names = _df(spark).select("id", field_names("labels", "name").alias("names"))
    out = [(r["id"], r["pos"], r["value"]) for r in child_rows(names, ["id"], "names").orderBy("pos").collect()]
    assert out == [(3, 0, None), (3, 1, "b"), (3, 2, "c")]


def test_topk_first_field_fast_path_same_order(spark):
    df = _df(spark)
    a = [r[0] for r in df.select(topk_nested("edges", "size", 3)).collect()]
    b = [r[0] for r in df.select(topk_nested("edges", "size", 3, by_is_first=True)).collect()]
    assert a == b
