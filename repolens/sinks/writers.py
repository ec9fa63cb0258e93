"""Materialise models, export a list of models, count rows without a second scan."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..session import open_writers
from ..sources.tables import is_missing, path_exists


def materialize(df: DataFrame, name: str | None = None, path: str | None = None,
                partition_by: list[str] | None = None) -> str:
    """Full replace of a model, as a catalog table (``name``) or a folder (``path``); returns where the rows are.

    A folder keeps its versions: the rows are written to a new ``v=<n>`` beside the old one, which becomes
    the model only when its number is logged. A run that fails half-way leaves the old model in place, and
    a model may be computed from its own last version.
    """
    if name:
        w = df.write.mode("overwrite")
        (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
        return name
    if not path:
        raise ValueError("give a table name or a path")
    spark, root = df.sparkSession, path.rstrip("/")
    version = (model_version(spark, root) or 0) + 1
    w = df.write.mode("overwrite")
    with open_writers(spark):
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{root}/v={version}")
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{root}/_log")
    return f"{root}/v={version}"


def model_version(spark: SparkSession, path: str) -> int | None:
    """The newest complete version of a model folder, None before the first."""
    if not path_exists(spark, f"{path.rstrip('/')}/_log"):
        return None
    try:
        return spark.read.schema("version long").parquet(f"{path.rstrip('/')}/_log").agg(F.max("version").alias("v")).first()["v"]
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a model folder's newest version."""
    version = model_version(spark, path)
    if version is None:
        raise ValueError(f"nothing was materialised at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/v={version}")


def layer(df: DataFrame, path: str, **how) -> DataFrame:
    """The model as written; an empty one keeps its columns."""
    return df.sparkSession.read.schema(df.schema).parquet(materialize(df, path=path, **how))


def write_summary(spark: SparkSession, root: str, outcomes: list[tuple[str, str, int]]) -> str:
    """A run's (entity, outcome, n) as the next version of ``<root>/summary``: rows stored, and rejects by reason."""
    return materialize(spark.createDataFrame(outcomes, "entity string, outcome string, n long").coalesce(1), path=f"{root}/summary")


def obsolete_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """The folders of a model's versions but the newest ``keep``: what a retention job may delete."""
    root, newest = path.rstrip("/"), model_version(spark, path)
    if newest is None:
        return []
    old = spark.read.schema("version long").parquet(f"{root}/_log").where(F.col("version") <= newest - keep).distinct()
    return [f"{root}/v={r['version']}" for r in old.orderBy("version").toLocalIterator()]


def write_counted(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write parquet and return the row count observed during the write (S9, no second scan)."""
    obs = Observation()
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).parquet(path)
    return int(obs.get["rows"])


def export_models(spark: SparkSession, models: dict[str, Callable[[], DataFrame] | str],
                  out_dir: str) -> dict[str, int | str]:
    """Write each model to ``out_dir/<model>.parquet`` (a folder).

    ``models`` maps a name to a catalog table name or a DataFrame factory. A
    missing table is skipped; a failing model is reported and the rest go on.
    Returns ``{model: rows written | 'missing' | 'error: ...'}``.
    """
    report: dict[str, int | str] = {}
    for model, src in models.items():
        try:
            if isinstance(src, str):
                if not spark.catalog.tableExists(src):
                    report[model] = "missing"
                    continue
                df = spark.table(src)
            else:
                df = src()
            report[model] = write_counted(df, f"{out_dir.rstrip('/')}/{model}.parquet")
        except Exception as e:  # noqa: BLE001 - one model must not stop the others
            report[model] = f"error: {type(e).__name__}: {e}"
    return report
