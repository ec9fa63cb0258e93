"""Key-presence, not-null, case-folded equality, state, repository and search filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def lacks_json_key(df: DataFrame, json_col: str, key: str) -> DataFrame:
    """Keep records whose raw JSON object does not contain ``key`` at all.

    Presence, not NULL-ness: ``{"pull_request": null}`` has the key and is dropped.
    """
    keys = F.json_object_keys(F.col(json_col))
    return df.where(~F.coalesce(F.array_contains(keys, F.lit(key)), F.lit(False)))


def not_null(df: DataFrame, col: str) -> DataFrame:
    """P5."""
    return df.where(F.col(col).isNotNull())


def equals_folded(df: DataFrame, col: str, value: str) -> DataFrame:
    """``lower(col) = value``."""
    return df.where(F.lower(F.col(col)) == F.lit(value.lower()))


def state_filter(df: DataFrame, state: str = "all", col: str = "state") -> DataFrame:
    """``open`` / ``closed`` keep that state, ``all`` keeps everything."""
    if state == "all":
        return df
    if state not in ("open", "closed"):
        raise ValueError(f"state must be open, closed or all, got {state!r}")
    return df.where(F.col(col) == F.lit(state))


def repository_filter(df: DataFrame, include_archived: bool = False, min_stars: int = 0,
                      pushed_after: str | None = None, archived_col: str = "is_archived",
                      stars_col: str = "stargazer_count", pushed_col: str = "pushed_at") -> DataFrame:
    """Drop archived unless asked; ``stars >= n`` only when ``n > 0``; pushed after a date."""
    out = df
    if not include_archived:
        out = out.where(~F.coalesce(F.col(archived_col), F.lit(False)))
    if min_stars and min_stars > 0:
        out = out.where(F.col(stars_col) >= F.lit(min_stars))
    if pushed_after:
        out = out.where(F.col(pushed_col) > F.lit(pushed_after).cast("timestamp_ntz"))
    return out


def within(c: Column, low=None, low_open: bool = False, high=None, high_open: bool = False, as_type: str | None = None) -> Column:
    """A one- or two-sided range test; a NULL value is in no range, and no bounds at all are TRUE."""
    value = lambda v: F.lit(v).cast(as_type) if as_type else F.lit(v)
    cond = F.lit(True)
    if low is not None:
        cond = (c > value(low)) if low_open else (c >= value(low))
    if high is not None:
        below = (c < value(high)) if high_open else (c <= value(high))
        cond = below if low is None else cond & below
    return cond


def search_terms(df: DataFrame, query: str, text_cols: list[str]) -> DataFrame:
    """Every whitespace-separated term occurs (case-folded) in the concatenated text.

    A term ``name:value`` is a qualifier, not text: split it off with
    :func:`repolens.plans.presets.split_qualifiers`. Given here it raises.
    """
    terms = [t.lower() for t in query.split()]
    if odd := [t for t in terms if ":" in t]:
        raise ValueError(f"qualifiers are not search text: {odd}")
    hay = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in text_cols]))  # NULLs skipped
    cond: Column = F.lit(True)
    for t in terms:
        cond = cond & hay.contains(t)
    return df.where(cond)


def allow_list(df: DataFrame, col: str, values: list[str] | None) -> DataFrame:
    """Keep rows whose ``col`` is in a (short, literal) allow-list; empty = no filter."""
    if not values:
        return df
    return df.where(F.col(col).isin(list(values)))
