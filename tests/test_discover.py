"""Schemas found in records, and child tables of lists at any depth."""

import json

from repolens.sources import discover as D


def records(spark, *rows):
    return spark.createDataFrame([(r if isinstance(r, str) else json.dumps(r),) for r in rows], "_json string").repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_an_unknown_nested_list_becomes_a_table(spark):
    df = records(spark, {"id": 1, "owner": {"login": "a"}, "new": {"nodes": [{"x": 1, "tags": ["p", "q"]}, {"y": 2.5}]}}, {"id": 2, "plain": [7, 8]}, {"id": 3, "new": None, "plain": []})
    typed = D.typed_records(df, D.discovered_schema(df))
    tables = D.child_tables(typed, ["id"], "thing")
    assert set(tables) == {"thing", "thing__new__nodes", "thing__new__nodes__tags", "thing__plain"}
    assert rows_of(tables["thing"].select("id", "owner__login")) == [(1, "a"), (2, None), (3, None)]
    assert rows_of(tables["thing__new__nodes"].select("id", "new__nodes_pos", "x", "y")) == [(1, 0, 1, None), (1, 1, None, 2.5)]
    assert rows_of(tables["thing__new__nodes__tags"]) == [(1, 0, 0, "p"), (1, 0, 1, "q")]
    assert rows_of(tables["thing__plain"]) == [(2, 0, 7), (2, 1, 8)]


def test_types_that_differ_become_text_and_nothing_is_lost(spark):
    df = records(spark, {"id": 1, "v": 5}, {"id": 2, "v": {"deep": [1]}}, {"id": 3, "v": "text"}, {"id": 4, "n": None, "odd name, OBJECT<": True}, "7", "[1]", "broken")
    typed = D.typed_records(df, D.discovered_schema(df))
    assert rows_of(typed.select("id", "v")) == [(1, "5"), (2, '{"deep":[1]}'), (3, "text"), (4, None)]
    assert "odd name, OBJECT<" in typed.columns and dict(typed.dtypes)["n"] == "string"


def test_lists_of_lists_and_no_records(spark):
    df = records(spark, {"id": 1, "grid": [[1, 2], [3]]})
    tables = D.child_tables(D.typed_records(df, D.discovered_schema(df)), ["id"])
    assert rows_of(tables["grid__list"]) == [(1, 0, 0, 1), (1, 0, 1, 2), (1, 1, 0, 3)]
    assert D.discovered_schema(records(spark, "7", "x")).fields == [] and D.discovered_schema(df.limit(0)).fields == []


def test_landed_text_is_compressed_and_read_whole(spark, tmp_path, monkeypatch):
    import os
    from repolens.plans import adapters as ad, catalog as C
    from tests.conftest import SF_SMALL
    monkeypatch.setattr(C, "scratch", lambda *_: f"{tmp_path}/landed")
    rows = C.q_discovered_children(spark, SF_SMALL)
    names = [n for n in os.listdir(f"{tmp_path}/landed") if n.startswith("part-")]
    assert names and all(n.endswith(".txt.gz") for n in names)
    want = ad.gql_releases(spark, SF_SMALL).selectExpr("databaseId", "posexplode(releaseAssets.nodes) AS (position, a)").selectExpr("databaseId", "CAST(position AS long) position", "a.name", "a.size", "a.contentType")
    assert rows.count() == want.count() and rows.exceptAll(want).isEmpty()
