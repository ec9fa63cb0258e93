"""Operators on nested lists of structs (higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def field_names(arr: Column | str, path: str = "name", element_type: str = "string") -> Column:
    """``[x.<path> for x in arr]``; a NULL list becomes an empty list."""
    def pick(x):
        out = x
        for part in path.split("."):
            out = out[part]
        return out
    return F.coalesce(F.transform(_c(arr), pick), F.array().cast(f"array<{element_type}>"))


def nested_to_json(arr: Column | str) -> Column:
    """List -> JSON text keeping NULL fields; a NULL list becomes ``'[]'``."""
    return F.coalesce(F.to_json(_c(arr), {"ignoreNullFields": "false"}), F.lit("[]"))


def nested_count(arr: Column | str) -> Column:
    """Number of elements as BIGINT; a NULL list counts 0."""
    col = _c(arr)
    return F.when(col.isNull(), F.lit(0).cast("long")).otherwise(F.size(col).cast("long"))


def cap_nested(arr: Column | str, n: int | None) -> Column:
    """Keep the first ``n`` elements; None keeps all."""
    return _c(arr) if n is None else F.slice(_c(arr), 1, n)


def topk_nested(arr: Column | str, by: str, n: int, by_is_first: bool = False) -> Column:
    """The ``n`` elements with the largest ``by`` field, largest first.

    Sorting is on the whole element with ``by`` hoisted to the front, so equal
    ``by`` values fall back to the remaining fields and the result is stable.
    ``by_is_first`` says ``by`` already is the element's first field: the
    elements then sort as they are (same order, no wrapping).
    """
    col = _c(arr)
    if by_is_first:
        return F.slice(F.sort_array(col, asc=False), 1, n)
    keyed = F.transform(col, lambda x: F.struct(x[by].alias("_k"), x.alias("_v")))
    ordered = F.sort_array(keyed, asc=False)
    return F.slice(F.transform(ordered, lambda x: x["_v"]), 1, n)


def child_rows(df: DataFrame, parent_keys: list[str], arr: str, pos_col: str = "pos",
               value_col: str = "value") -> DataFrame:
    """One child row per list element with the parent key and 0-based position.

    Not the ``_outer`` form: an empty or NULL list yields no child rows.
    """
    return (df.select(*parent_keys, F.posexplode(arr).alias(pos_col, value_col))
              .withColumn(pos_col, F.col(pos_col).cast("long")))
