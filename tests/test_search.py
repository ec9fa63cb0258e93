"""The trigram index gives what the scan gives, from few rows."""

import random

import pytest
from pyspark.sql import functions as F

from repolens.operators import search as S
from repolens.operators.filters import search_terms


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeÉé") for _ in range(rng.randrange(1, 8)))
    rows = [(rng.choice([i, i, None]), " ".join(word() for _ in range(rng.randrange(6))), rng.choice([None, word()])) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, name string, about string")
    path = str(tmp_path_factory.mktemp("index"))
    S.build_index(df, "id", ["name", "about"], path)
    return df, path, rows


def answer(df):
    return sorted(map(str, df.collect()))


def test_equal_to_the_scan(spark, table):
    df, path, rows = table
    rng = random.Random(2)
    queries = ["", "a", "ab c", "zzz", "É", "ÉÉé abc"]
    for _ in range(8):
        text = " ".join(x or "" for x in rng.choice(rows)[1:])
        at = rng.randrange(max(1, len(text) - 4))
        queries.append(text[at:at + rng.randrange(2, 9)].strip())
    for q in queries:
        assert answer(S.search_index(spark, path, q)) == answer(search_terms(df, q, ["name", "about"])), q


def test_few_rows_are_compared(spark, table):
    df, path, rows = table
    for q in ("abcd", "deca", "éab cde"):
        found = S.candidates(spark, path, S.query_grams(q))
        assert search_terms(df, q, ["name", "about"]).count() <= found.count() < len(rows) / 10
        assert found.count() == found.distinct().count()
    plan = S.candidates(spark, path, ["abc"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(gram,abc)" in plan.replace("In(gram, [abc])", "EqualTo(gram,abc)")


def test_several_blocks_and_empty_tables(spark, tmp_path):
    df = spark.range(70_000).select("id", F.concat(F.lit("row "), F.hex("id")).alias("name"))
    S.build_index(df, "id", ["name"], f"{tmp_path}/a")
    assert answer(S.search_index(spark, f"{tmp_path}/a", "row 11100")) == answer(search_terms(df, "row 11100", ["name"]))
    S.build_index(df.where("id < 0"), "id", ["name"], f"{tmp_path}/b")
    assert S.search_index(spark, f"{tmp_path}/b", "row").isEmpty() and S.search_index(spark, f"{tmp_path}/b", "r").isEmpty()
