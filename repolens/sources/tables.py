"""Parquet scans with projection, catalog tables, guarded lookups."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Conditions that mean "nothing there"; any other error is a fault and is raised.
NOT_THERE = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def is_missing(error: AnalysisException) -> bool:
    """Whether an analysis error says that a path or table does not exist (or holds no file)."""
    return (error.getCondition() or "").split(".")[0] in NOT_THERE


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """S3: ``read_parquet(path)`` with a projection; the path is a parameter (any object store)."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def table(spark: SparkSession, name: str) -> DataFrame:
    """``SELECT * FROM source(...)`` - a catalog table as a DataFrame (bronze is a view of it)."""
    return spark.table(name)


def existing_or_empty(spark: SparkSession, candidates: list[str], schema: StructType) -> DataFrame:
    """The first catalog table / parquet path that exists, else an empty frame with ``schema``.

    Only a missing candidate is passed over; one that exists but cannot be read raises.
    """
    for c in candidates:
        try:
            if "/" in c:
                return spark.read.schema(schema).parquet(c).select(*schema.fieldNames())
            if spark.catalog.tableExists(c):
                return spark.table(c).select(*schema.fieldNames())
        except AnalysisException as e:
            if not is_missing(e):
                raise
    return spark.createDataFrame([], schema)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, asked of its file system; True where that can't be asked (Spark Connect)."""
    try:
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    except Exception:  # noqa: BLE001 - no JVM on this side
        return True
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf).exists(where)
