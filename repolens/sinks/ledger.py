"""Append-only tables of signed counts: the state behind aggregates that are kept up to date per load.

A ledger is a folder of tables. A load stages one folder per table (``<table>/v=<version>``) and then logs its
version: readers only see logged versions, so a failed load leaves nothing behind that counts, and a load
that is run again after it was logged changes nothing. The value of a group is the sum of its signed counts;
groups at 0 are gone. ``compact`` replaces all folders so far by their sums.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..sources.tables import is_missing, path_exists

_LOG = "version long, base boolean"


def _log(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """The newest base, if any, and the loads after it: what readers need (``compact`` bounds it)."""
    if not path_exists(spark, f"{root.rstrip('/')}/_log"):
        return []
    try:
        log = spark.read.schema(_LOG).parquet(f"{root.rstrip('/')}/_log")
        base = log.where("base").agg(F.max("version").alias("v")).first()["v"]
        rows = log.where(F.col("version") >= F.lit(-1 if base is None else base)).distinct().collect()
    except AnalysisException as e:
        if is_missing(e):
            return []
        raise
    return sorted((r["version"], r["base"]) for r in rows if r["base"] or base is None or r["version"] > base)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Logged versions that readers use, the newest last."""
    return [v for v, _ in _log(spark, root)]


def is_committed(spark: SparkSession, root: str, version: int) -> bool:
    """Whether a load was logged: by itself, or within a base that came after it."""
    used = versions(spark, root)
    return version in used or bool(used) and version <= used[0]


def stage(df: DataFrame, root: str, table: str, version: int, partition_by: list[str] | None = None) -> None:
    """Write a load's rows of one table; a leftover of a failed run is replaced."""
    w = df.write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{root.rstrip('/')}/{table}/v={version}")


def commit(spark: SparkSession, root: str, version: int, base: bool = False) -> None:
    """Make a staged load visible."""
    spark.createDataFrame([(version, base)], _LOG).coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/_log")


def folders(spark: SparkSession, root: str, table: str) -> list[str]:
    return [f"{root.rstrip('/')}/{table}/{'base' if base else 'v'}={v}" for v, base in _log(spark, root)]


def read(spark: SparkSession, root: str, table: str, schema: StructType) -> DataFrame:
    """All visible rows of a table (no rows before the first load); each folder has partition folders of its own."""
    parts = [spark.read.schema(schema).parquet(p) for p in folders(spark, root, table)]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def net(rows: DataFrame, keys: list[str], n: str = "n") -> DataFrame:
    """Sums of signed counts per group, without the groups at 0; combined map-side."""
    return rows.groupBy(*keys).agg(F.sum(n).alias(n)).where(F.col(n) != 0)


def compact(spark: SparkSession, root: str, tables: dict[str, tuple]) -> list[str]:
    """Write every table's present state as one base and return the folders it replaces, for a retention job.

    ``tables`` maps a name to (schema, rows -> present rows, partition columns).
    """
    used = _log(spark, root)
    if not used or used == [(used[-1][0], True)]:
        return []
    old = [p for name in tables for p in folders(spark, root, name)]
    version = used[-1][0]
    for name, (schema, present, partition_by) in tables.items():
        w = present(read(spark, root, name, schema)).write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{root.rstrip('/')}/{name}/base={version}")
    commit(spark, root, version, base=True)
    return old
