"""Incremental load = file-source stream + keyed upsert per micro-batch.

New pages under ``<landing>/entity=<name>`` are picked up exactly once (the stream's checkpoint records
which files were consumed) and go through the same record-wise reader as a batch load. Each micro-batch is
merged into the target with :func:`repolens.sinks.upsert.upsert_parquet`, which rewrites only the buckets
the batch touches, so a rerun of a batch after a failure gives the same rows; records that do not parse go
to ``<target>/_page_rejects/batch=<id>``. ``availableNow`` drains what is there and stops, which suits
scheduled runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ENTITY_SCHEMAS
from ..sinks.upsert import upsert_parquet
from ..operators.filters import lacks_json_key
from ..sources.landing import (REJECT_COLUMNS, by_line, entity_path, is_large, page_rows, parse_records, split_records, whole_pages,
                               with_whole_pages)


def stream_pages(spark: SparkSession, landing: str, entity: str, max_files_per_trigger: int | None = None
                 ) -> DataFrame:
    """A streaming frame of page rows (``value``, ``_source_file``, ``_file_time`` and how they were read).

    As in the batch, files of lines and large pages are read by line (split over tasks), all others as one
    row each: two file sources over the folder, each with a condition on the file's name and size. Both count
    towards ``max_files_per_trigger``.
    """
    def files(**how) -> DataFrame:
        reader = spark.readStream
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        return reader.text(f"{landing.rstrip('/')}/entity={entity}", recursiveFileLookup=True, **how)

    return page_rows(files(wholetext=True).where(~by_line() & ~is_large())).unionByName(page_rows(files().where(by_line() | is_large())))


def incremental_upsert(spark: SparkSession, landing: str, entity: str, target: str, checkpoint: str,
                       keys: list[str] | None = None, newest_first: list[str] | None = None,
                       available_now: bool = True):
    """Run (or start) the incremental load of ``entity`` into the table at ``target``."""
    k = keys or ["id"]
    order = newest_first or ["fetched_at"]
    schema = ENTITY_SCHEMAS[entity]

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        pages = with_whole_pages(batch, whole_pages(batch), lambda: spark.read.text(entity_path(landing, entity), recursiveFileLookup=True, wholetext=True))
        texts = split_records(pages)
        if entity == "issues":
            texts = lacks_json_key(texts, "_json", "pull_request")
        records, rejects = parse_records(texts, schema, stage=f"{target.rstrip('/')}/_parsed")  # replaced by the next batch
        upsert_parquet(spark, target, records.drop("_source_file"), k, order, kept=True)
        rejects.select(*REJECT_COLUMNS).write.mode("overwrite").parquet(f"{target.rstrip('/')}/_page_rejects/batch={batch_id}")

    q = (stream_pages(spark, landing, entity).writeStream
         .foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
