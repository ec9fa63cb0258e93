"""Title rule chain."""

import pytest
from pyspark.sql import functions as F

from repolens.functions.classify import CLASSES, classify_title

# Titles of our own: every word of every rule, order of the rules, case, substrings, no hit.
GRID = [
    ("Hotfix: crash on empty input", "bug fix"),
    ("Debug output left in", "bug fix"),          # 'bug' inside 'debug'
    ("Use a prefix", "bug fix"),                  # 'fix' inside 'prefix'
    ("Implement batch exports", "feature"),
    ("Featherweight locks", "feature"),           # 'feat'
    ("New address book", "feature"),              # 'add' inside 'address'
    ("Cleanup of the parser", "refactor"),
    ("REFACTOR everything", "refactor"),
    ("Show the latest build", "test"),            # 'test' inside 'latest'
    ("Docker image", "documentation"),            # 'doc'
    ("Add a bugfix test doc", "bug fix"),         # the first rule wins, not the first word
    ("Clean up, add docs", "feature"),
    ("Tests for the docs", "test"),
    ("Bump the version", "not clear"),
    ("", "not clear"),
    (None, "not clear"),
]


@pytest.fixture(scope="module")
def classified(spark):
    df = spark.createDataFrame([(t,) for t, _ in GRID], "title string")
    return {r["title"]: r["c"] for r in df.select("title", classify_title("title").alias("c")).collect()}


@pytest.mark.parametrize("title,expected", GRID)
def test_rule_chain(classified, title, expected):
    assert classified[title] == expected


def test_classes_fixed_values():
    assert CLASSES == ("bug fix", "feature", "refactor", "test", "documentation", "not clear")


def test_rule_chain_is_jvm_expression(spark):
    df = spark.createDataFrame([("Fix it",)], "title string").select(classify_title(F.col("title")).alias("c"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
