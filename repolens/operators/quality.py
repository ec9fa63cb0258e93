"""Q1-Q3: declarative data tests (not_null, unique, accepted_values).

Each test yields its violating rows; a table passes when all are empty. The
summary form counts them for all tests of a table in one read.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass
class TableTests:
    model: str
    not_null: list[str] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    accepted_values: dict[str, list[str]] = field(default_factory=dict)


def not_null_violations(df: DataFrame, col: str) -> DataFrame:
    """Q1: rows where ``col`` is NULL."""
    return df.where(F.col(col).isNull())


def unique_violations(df: DataFrame, col: str) -> DataFrame:
    """Q2: non-NULL values of ``col`` that occur more than once, with their count."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def outside(col: str, values: list[str]):
    """The accepted-values test of one column; NULL is not a violation."""
    return ~F.col(col).isin(list(values))


def accepted_values_violations(df: DataFrame, col: str, values: list[str]) -> DataFrame:
    """Q3: rows whose ``col`` is outside ``values``; NULL is not a violation."""
    return df.where(outside(col, values))


def violations(df: DataFrame, tests: TableTests) -> dict[tuple[str, str], DataFrame]:
    """The violating rows of every test: what to look at when :func:`summarize` counts any."""
    return ({("not_null", c): not_null_violations(df, c) for c in tests.not_null}
            | {("accepted_values", c): accepted_values_violations(df, c, v) for c, v in tests.accepted_values.items()}
            | {("unique", c): unique_violations(df, c) for c in tests.unique})


def summarize(df: DataFrame, tests: TableTests) -> DataFrame:
    """One row per test instance: (test, model, column_name, failures BIGINT).

    One read of the table for all row-level tests and the first ``unique`` test: rows are grouped by that
    column with conditional counts, and the groups are summed. Each further ``unique`` test is one more.
    """
    row_level = [("not_null", c, F.col(c).isNull()) for c in tests.not_null]
    row_level += [("accepted_values", c, outside(c, v)) for c, v in tests.accepted_values.items()]
    counts = [F.count(F.when(cond, F.lit(1))).alias(f"_q{i}") for i, (_, _, cond) in enumerate(row_level)]
    names = [(t, c) for t, c, _ in row_level]
    first, *more = [*tests.unique, None]
    if first is None:
        one = df.agg(*counts)
    else:
        groups = df.groupBy(F.col(first).alias("_u")).agg(*counts, F.count(F.lit(1)).alias("_n"))
        names.append(("unique", first))
        one = groups.agg(*[F.coalesce(F.sum(f"_q{i}"), F.lit(0)).alias(f"_q{i}") for i in range(len(row_level))],
                         F.count(F.when(F.col("_u").isNotNull() & (F.col("_n") > 1), 1)).alias(f"_q{len(row_level)}"))
    stack = ", ".join(f"'{t}', '{c}', _q{i}" for i, (t, c) in enumerate(names))
    out = one.selectExpr(f"stack({len(names)}, {stack}) as (test, column_name, failures)")
    for c in more[:-1]:
        out = out.unionByName(unique_violations(df, c).agg(F.count(F.lit(1)).alias("failures"))
                              .select(F.lit("unique").alias("test"), F.lit(c).alias("column_name"), "failures"))
    return out.select("test", F.lit(tests.model).alias("model"), "column_name",
                      F.col("failures").cast("long").alias("failures"))
