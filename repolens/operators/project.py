"""Provenance stamps, null-safe flattening, defaults, name split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stamp_provenance(df: DataFrame, repo: Column | str | None = None, fetched_at: Column | str | None = None,
                     repo_col: str = "repository_full_name", fetched_col: str = "fetched_at") -> DataFrame:
    """Add the repository name and fetch time unless the record already carries them.

    The fetch time should come from the landing (a column or the file's
    modification time), not from the clock, so reruns stay reproducible.
    """
    out = df
    if repo is not None:
        r = F.col(repo) if isinstance(repo, str) else repo
        out = out.withColumn(repo_col, F.coalesce(F.col(repo_col), r) if repo_col in df.columns else r)
    if fetched_at is not None:
        f = F.col(fetched_at) if isinstance(fetched_at, str) else fetched_at
        out = out.withColumn(fetched_col, F.coalesce(F.col(fetched_col), f) if fetched_col in df.columns else f)
    return out


def flatten_struct(df: DataFrame, struct_col: str, fields: list[str], prefix: str | None = None,
                   sep: str = "__") -> DataFrame:
    """``author`` -> ``author__login``, ``author__name``, ...; NULL struct -> NULL fields."""
    p = prefix if prefix is not None else struct_col
    return df.select("*", *[F.col(f"{struct_col}.{f}").alias(f"{p}{sep}{f}") for f in fields])


def default_if_missing(c: Column | str, default) -> Column:
    """``coalesce(c, default)`` (the reference keeps an explicit NULL; we fold both)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(col, F.lit(default))


def split_owner_name(df: DataFrame, col: str, owner_col: str = "owner", name_col: str = "name",
                     sep: str = "/") -> tuple[DataFrame, DataFrame]:
    """Split ``owner/name``; rows without exactly two parts go to the rejects frame."""
    parts = F.split(F.col(col), sep)
    tagged = df.withColumn("_parts", parts)
    ok = F.size("_parts") == 2
    good = (tagged.where(ok)
                  .withColumn(owner_col, F.col("_parts")[0])
                  .withColumn(name_col, F.col("_parts")[1])
                  .drop("_parts"))
    bad = tagged.where(~ok | F.col("_parts").isNull()).drop("_parts")
    return good, bad
