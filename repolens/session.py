"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job here relies on. Session time zone is pinned to UTC because
# landed ISO-8601 text carries 'Z'; all timestamps are kept zone-less (NTZ).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files of finished range sorts are removed once their RDDs are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "repolens",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session. ``master`` is only set for local runs/tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    Only when the setting is absent on a local master (tests) do we pick our
    own folder; on a cluster the setting must point to shared storage and is
    never overridden. Without a SparkContext (Spark Connect) the server's
    setting is used as is.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no driver-side context
        return conf_dir
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = conf_dir or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    local_dir = tempfile.mkdtemp(prefix="repolens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def open_writers(spark: SparkSession, most: int = 32):
    """Partitioned writes within keep up to ``most`` files open per task instead of sorting whole rows by folder first.

    A task that meets more folders sorts the rest of its rows, as Spark does by default for all of them.
    """
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(most))


def small_files(spark: SparkSession):
    """Parquet written within is compressed with zstd: records' text takes about half of what it takes by default."""
    return _setting(spark, "spark.sql.parquet.compression.codec", "zstd")
