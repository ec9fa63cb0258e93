"""Anti join after a cap, IN-subquery semi join, existence flag, FK enrichment, cohorts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ordering import first_n


def new_entities(candidates: DataFrame, existing: DataFrame, key: str, max_n: int | None,
                 order: list[Column]) -> DataFrame:
    """J1 + O4: take the first ``max_n`` candidates in ``order``, then drop keys already loaded.

    The cap is applied before the anti join: skipped entities still use up the budget. None is no cap
    (and needs no sort); 0 or less takes nothing.
    """
    capped = candidates if max_n is None else first_n(candidates, order, max_n)
    return capped.join(existing.select(key), on=key, how="left_anti")


def semi_join(df: DataFrame, keys_df: DataFrame, key: str, small: bool = False) -> DataFrame:
    """``WHERE key IN (SELECT key FROM keys_df)``; ``small`` = size-bounded, broadcast it."""
    right = keys_df.select(key)
    return df.join(F.broadcast(right) if small else right, on=key, how="left_semi")


def existence_flag(df: DataFrame, keys_df: DataFrame, key: str, out: str, small: bool = False) -> DataFrame:
    """``key IN (subquery)`` as a column with SQL three-valued logic.

    TRUE on a match; NULL when the key is NULL or the list holds a NULL and nothing matched; FALSE
    otherwise, and always for an empty list. (Spark's own IN-subquery in a projection becomes an
    ExistenceJoin that answers FALSE in the NULL cases.) ``small`` says the list is bounded (a top-k): it
    is computed once, as one scalar row of its values, and nothing is joined.
    """
    k = F.col(key)
    if small:
        one = keys_df.agg(F.struct(F.collect_set(key).alias("values"), F.count(F.when(k.isNull(), 1)).alias("nulls")).alias("list"))
        listed = one.scalar()
        hit, nulls, empty = F.array_contains(listed["values"], k), listed["nulls"] > 0, F.size(listed["values"]) + listed["nulls"] == 0
        flag = (F.when(empty, F.lit(False)).when(hit, F.lit(True))
                 .when(k.isNull() | nulls, F.lit(None).cast("boolean")).otherwise(F.lit(False)))
        return df.withColumn(out, flag)
    listed = keys_df.select(k.alias("_k")).distinct().withColumn("_hit", F.lit(True))
    stats = keys_df.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(F.when(k.isNull(), 1)).alias("nulls")).alias("s")).scalar()
    joined = df.join(listed.where(F.col("_k").isNotNull()), k == F.col("_k"), "left").drop("_k")
    flag = (F.when(F.col("_hit"), F.lit(True)).when(stats["n"] == 0, F.lit(False))
             .when(k.isNull() | (stats["nulls"] > 0), F.lit(None).cast("boolean")).otherwise(F.lit(False)))
    return joined.withColumn(out, flag).drop("_hit")


def fk_enrich(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str,
              parent_cols: dict[str, str], how: str = "inner") -> DataFrame:
    """Attach parent attributes (renamed per ``parent_cols``) to every child row.

    No broadcast is forced: the parent table grows with the data, so the
    strategy is left to the planner and to AQE's runtime size check.
    """
    p = parents.select(F.col(parent_key).alias("__pk"),
                       *[F.col(src).alias(dst) for src, dst in parent_cols.items()])
    return children.join(p, children[child_key] == p["__pk"], how).drop("__pk")


def cohort(top: DataFrame, key: str, focus: str | None, focus_label: str, member_label: str) -> DataFrame:
    """Members of the comparison: the top-k keys labelled ``member_label`` plus the focus
    key labelled ``focus_label`` (the focus label wins when the focus is in the top k).

    At most k + 1 rows, which is what makes broadcasting it safe.
    """
    members = top.select(key).where(F.col(key).isNotNull())
    if focus is not None:
        members = members.where(F.col(key) != F.lit(focus))
    out = members.select(key, F.lit(member_label).alias("_group"))
    if focus is not None:
        focus_row = top.sparkSession.range(1).select(F.lit(focus).alias(key), F.lit(focus_label).alias("_group"))
        out = out.unionByName(focus_row)
    return out


def apply_cohort(df: DataFrame, members: DataFrame, key: str, group_col: str | None = None) -> DataFrame:
    """P10 + J5: keep rows whose key is the focus or a top-k key, optionally with their label.

    An inner join with the broadcast (k + 1)-row cohort replaces the
    ``key = focus OR key IN (subquery)`` filter and the CASE label in one step;
    NULL keys never match, as in the SQL.
    """
    m = members if group_col is None else members.withColumnRenamed("_group", group_col)
    if group_col is None:
        m = m.drop("_group")
    return df.join(F.broadcast(m), on=key, how="inner")
