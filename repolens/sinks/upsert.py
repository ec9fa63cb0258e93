"""Keyed upsert (merge on primary key, the later load wins).

``merge_latest`` is the relational core (existing UNION ALL incoming, one row per key, combined map-side).
``upsert_parquet`` persists it. A table is a folder of key buckets; a load rewrites only the buckets it
touches, each into a folder of the load's version, and then appends one row per touched bucket to the
table's log. Readers take each bucket's newest logged folder, so they never see a half-written load and a
failed run leaves the table as it was. Stored columns that a load lacks are kept, and rows with a NULL key
cannot be merged and go to the rejects.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.windows import latest_per_key
from ..session import open_writers
from ..sources.tables import is_missing, path_exists

LOAD = "_load"
CHANGE = "_change"
TIE = "_tie"
BUCKETS = 32
#: Rows that a task merges, and rows of one key in a load from which they are first combined where they lie.
PART_ROWS, HOT_ROWS = 100_000, 10_000
#: Hash slots per bucket in which a load's rows are counted: only keys of slots with more than HOT_ROWS rows can be hot.
SLOTS = 16_384


def _tagged(existing: DataFrame | None, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Both loads by column name, with their number (``_load``) and a hash of the whole row (``_tie``)."""
    tagged = incoming.withColumn(LOAD, F.lit(1))
    if existing is not None:
        tagged = existing.withColumn(LOAD, F.lit(0)).unionByName(tagged, allowMissingColumns=True)
    return tagged.withColumn(TIE, F.xxhash64(*[c for c in tagged.columns if c not in keys]))


def merge_latest(existing: DataFrame | None, incoming: DataFrame, keys: list[str],
                 newest_first: list[str]) -> DataFrame:
    """Union the two loads (by column name) and keep one row per key: the later load wins.

    Within a load the row that sorts first by ``newest_first`` descending stays (NULLs last), equal ones
    by a hash of the whole row, so reruns agree. Columns that only one side has are NULL on the other.
    """
    return latest_per_key(_tagged(existing, incoming, keys), keys, [LOAD, *newest_first, TIE]).drop(LOAD, TIE)


def _merged(stored: DataFrame | None, load: DataFrame, keys: list[str], newest_first: list[str], buckets: int, rows: int,
            hot_rows: int = HOT_ROWS, crowded: bool = True, changes: bool = False) -> DataFrame:
    """The rows of :func:`merge_latest` with their ``_bucket``, in one shuffle and one sort; a partition holds one bucket.

    Rows are dealt to parts of buckets (about :data:`PART_ROWS` of ``rows`` each) and the first row of each key is
    taken in sorted order. Keys with more than ``hot_rows`` rows in the load are cut to one row by an
    aggregate first (combined map-side), so no key fills a task; they are only looked for in a ``crowded`` load.
    With ``changes`` each row says in ``_change`` whether it stays as stored (0), comes from the load (1) or is
    the stored row of a key of the load (-1), which is no row of the table any more.
    """
    tagged, order = _tagged(stored, load, keys), [LOAD, *newest_first, TIE]
    hot = load.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*keys)
    if crowded and not hot.isEmpty():
        few, loaded = F.broadcast(hot), F.col(LOAD) == 1     # at most one of ``hot_rows`` rows
        best = latest_per_key(tagged.where(loaded).join(few, keys, "left_semi"), keys, order)
        tagged = tagged.where(~loaded).unionByName(tagged.where(loaded).join(few, keys, "left_anti")).unionByName(best)
    parts = buckets * max(1, -(-rows // (buckets * PART_ROWS)))
    of = lambda n: F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    dealt = tagged.withColumns({"_bucket": of(buckets), "_part": of(parts)}).repartitionById(parts, F.col("_part"))
    first = Window.partitionBy(*keys, "_part").orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = dealt.withColumn("_rank", F.row_number().over(first))
    if changes:
        best = F.max(LOAD).over(first)    # the first row's
        change = F.when(F.col("_rank") == 1, F.col(LOAD)).when((F.col(LOAD) == 0) & (best == 1), F.lit(-1))
        ranked = ranked.withColumn(CHANGE, change).where(F.col(CHANGE).isNotNull())
    else:
        ranked = ranked.where("_rank = 1")
    return ranked.drop("_part", "_rank", LOAD, TIE)


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/_log"


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    """(version, bucket, path) of every committed bucket write, or None for a table without loads."""
    if not path_exists(spark, _log_path(root)):
        return None
    try:
        return spark.read.schema("version long, bucket int, path string").parquet(_log_path(root))
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise


def current_folders(spark: SparkSession, root: str) -> dict[int, str]:
    """The newest folder of each bucket: at most one row per bucket reaches the driver."""
    log = read_log(spark, root)
    rows = [] if log is None else log.groupBy("bucket").agg(F.max_by("path", "version").alias("path")).collect()
    return {r["bucket"]: r["path"] for r in rows}


def last_version(spark: SparkSession, root: str) -> int:
    """The newest committed version, 0 before the first load."""
    log = read_log(spark, root)
    return 0 if log is None else int(log.agg(F.max("version").alias("v")).first()["v"] or 0)


def obsolete_folders(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Folders that no bucket's ``keep`` newest versions use: what a retention job may delete."""
    log = read_log(spark, root)
    if log is None:
        return []
    newest = log.groupBy("bucket").agg(F.slice(F.sort_array(F.collect_set("version"), asc=False), 1, keep).alias("kept"))
    old = log.join(newest, "bucket").where(~F.array_contains("kept", F.col("version")))
    whole = F.regexp_replace("path", f"/{CHANGE}=[^/]*$", "")    # with the rows that the load replaced
    return sorted(r["path"] for r in old.select(whole.alias("path")).distinct().toLocalIterator())


def obsolete_loads(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Staged loads (with their NULL-key rejects) and lists of changed rows of all versions but the newest ``keep``.

    Readers of the table never use them: a retention job may delete them once rejects and changes were taken.
    The rows a load replaced lie in its bucket folders and go with these (:func:`obsolete_folders`).
    """
    root, last = root.rstrip("/"), last_version(spark, root)
    places = [f"{root}/{kind}/v={v}" for kind in ("_incoming", "_changes") for v in range(1, last - keep + 1)]
    return [p for p in places if path_exists(spark, p)]


def _read_folders(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    if not folders:
        return None
    return spark.read.option("mergeSchema", True).parquet(*folders)


def read_current(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The table's rows, or None when nothing was written yet; ``schema`` selects and types the columns."""
    df = _read_folders(spark, sorted(current_folders(spark, root).values()))
    if df is None or schema is None:
        return df
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def _listed(spark: SparkSession, rows: list[tuple], schema: str):
    """A writer of few rows into one file."""
    return spark.createDataFrame(rows, schema).coalesce(1).write


class Upserted(NamedTuple):
    version: int    # the load's number
    rows: int       # rows of the table afterwards
    rejected: int   # incoming rows with a NULL key


def upsert_parquet(spark: SparkSession, root: str, incoming: DataFrame, keys: list[str],
                   newest_first: list[str], buckets: int = BUCKETS, changes: bool = False, kept: bool = False) -> Upserted:
    """Merge ``incoming`` into the table at ``root``; rerunning the same load yields the same rows.

    The load is computed once, into ``<root>/_incoming/v=<version>`` (NULL keys in bucket -1, the rejects);
    only the stored buckets it touches are read and rewritten. A load that is ``kept`` only reads files that
    stay as they are, row by row: it isn't copied, just its rejects are. ``buckets`` must be the same for
    all loads of a table. With ``changes`` the merge also writes the stored rows that it replaces, and a bucket's
    folder keeps them, the load's rows and all others apart (:func:`read_changes`).
    """
    root = root.rstrip("/")
    version = last_version(spark, root) + 1
    null_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    stage = f"{root}/_incoming/v={version}"
    load = incoming.withColumn("_bucket", F.when(null_key, F.lit(-1)).otherwise(F.lit(0)))
    if not kept:
        with open_writers(spark):
            load.write.mode("overwrite").partitionBy("_bucket").parquet(stage)
        load = spark.read.schema(load.schema).parquet(stage)
    slot = F.when(~null_key, F.pmod(F.xxhash64(*keys), F.lit(buckets * SLOTS)))    # keys alone are read
    slots = load.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    sizes = slots.groupBy((F.col("slot") % buckets).cast("int").alias("bucket")).agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect()
    counts = {r["bucket"]: r["n"] for r in sizes}
    crowded = any(r["most"] > HOT_ROWS for r in sizes if r["bucket"] is not None)    # a key has at most its slot's rows
    rejected = counts.pop(None, 0)
    if kept and rejected:
        load.where(null_key).write.mode("overwrite").partitionBy("_bucket").parquet(stage)
    if counts:
        load, touched = load.where(~null_key).drop("_bucket"), sorted(counts)
        folders = current_folders(spark, root)
        stored = _read_folders(spark, [folders[b] for b in touched if b in folders])
        rows = sum(counts.values()) + (0 if stored is None else stored.count())
        # an unlogged leftover of a failed run is replaced
        merged = _merged(stored, load, keys, newest_first, buckets, rows, HOT_ROWS, crowded, changes)
        with open_writers(spark):    # a task has one bucket
            merged.write.mode("overwrite").partitionBy("_bucket", *[CHANGE] * changes).parquet(f"{root}/v={version}")
        places = {b: f"{root}/v={version}/_bucket={b}" for b in touched}
        if changes:
            _listed(spark, [(f"{p}/{CHANGE}={{-1,1}}",) for p in places.values()], "path string").mode("overwrite").parquet(f"{root}/_changes/v={version}")
            places = {b: f"{p}/{CHANGE}={{0,1}}" for b, p in places.items()}
        _listed(spark, [(version, b, p) for b, p in places.items()], "version long, bucket int, path string").mode("append").parquet(_log_path(root))
    now = read_current(spark, root)
    return Upserted(version, 0 if now is None else now.count(), rejected)


def read_changes(spark: SparkSession, root: str, version: int) -> DataFrame | None:
    """The rows of a load's keys, before it (``_change`` -1, keys that were there) and after (+1); None if nothing was kept."""
    root = root.rstrip("/")
    try:
        places = [r["path"] for r in spark.read.schema("path string").parquet(f"{root}/_changes/v={version}").collect()]
        return spark.read.option("basePath", f"{root}/v={version}").parquet(*places).drop("_bucket")
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise


def read_rejects(spark: SparkSession, root: str, version: int) -> DataFrame | None:
    """The NULL-key rows of a load, or None if it had none."""
    try:
        return spark.read.parquet(f"{root.rstrip('/')}/_incoming/v={version}/_bucket=-1")
    except AnalysisException as e:
        if is_missing(e):
            return None
        raise
