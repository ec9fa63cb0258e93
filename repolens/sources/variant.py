"""Landed records kept whole as VARIANT, so that keys no schema names stay queryable.

:func:`store_records` parses each record once and writes it as a VARIANT column. Typed fields
(:func:`read_typed`), any other path (:func:`path_value`) and the keys a schema doesn't know
(:func:`unknown_keys`) are then read from the stored table; no text is parsed again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import open_writers
from .landing import CORRUPT, REASON, _pages, entity_path, repo_from_path, split_records

RECORD = "_record"


def store_records(spark: SparkSession, root: str, entity: str, path: str, repos: list[str] | None = None) -> DataFrame:
    """Write an entity's records to ``path`` and read them back: (_source_file, _file_time, _json, _reason, _record, _reject).

    A record that is no JSON object is a reject: it keeps its text and a reason, and has no ``_record``. Good
    records keep no text. The two lie in folders of their own, so a reader of one side prunes the other.
    """
    rows = split_records(_pages(spark, entity_path(root, entity, repos)), apart=True).withColumn(RECORD, F.try_parse_json("_json"))
    why = F.coalesce(F.col(REASON), F.when(F.col(RECORD).isNull(), F.lit("not JSON")),
                     F.when(~F.ltrim("_json", F.lit(" \t\r\n")).startswith("{"), F.lit("not an object")))    # JSON that begins so is an object
    rows = rows.withColumn(REASON, why)
    good = F.col(REASON).isNull()
    out = rows.select("_source_file", "_file_time", F.when(~good, F.col("_json")).alias("_json"), REASON,
                      F.when(good, F.col(RECORD)).alias(RECORD), (~good).alias("_reject"))
    with open_writers(spark):
        out.write.mode("overwrite").partitionBy("_reject").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


def path_value(path: str, kind: str, record: str = RECORD) -> Column:
    """The value at a path (``$.delivery.stops[1]``) as ``kind``; NULL where it is missing or doesn't fit."""
    return F.try_variant_get(F.col(record), path, kind)


def _key_path(name: str) -> str:
    return f"$['{name}']"


def misfits(schema: StructType, record: str = RECORD) -> Column:
    """The schema's keys that a record holds with a value that doesn't fit their type."""
    def bad(f):
        value = path_value(_key_path(f.name), "variant", record)
        there = value.isNotNull() & ~F.is_variant_null(value)
        # a value that fits is there: only the others are looked up once more
        return F.when(path_value(_key_path(f.name), f.dataType.simpleString(), record).isNull() & there, F.lit(f.name))
    return F.array_compact(F.array(*map(bad, schema.fields)))


def read_typed(stored: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of a stored table: the schema's fields beside the whole ``_record``.

    Values are cast as VARIANT casts them (the text ``"5"`` fits a number). A record in which a present key
    does not fit its type is a reject, as in :func:`~.landing.read_pages`; keys are missing or NULL alike.
    """
    tagged = stored.where("not _reject").withColumn("_misfits", misfits(schema))
    fields = [path_value(_key_path(f.name), f.dataType.simpleString()).alias(f.name) for f in schema.fields]
    records = tagged.where(F.size("_misfits") == 0).select(*fields, RECORD, "_source_file", "_file_time")
    if "repository_full_name" in schema.fieldNames():
        records = records.withColumn("repository_full_name", F.coalesce("repository_full_name", repo_from_path()))
    unfit = tagged.where(F.size("_misfits") > 0).select("_source_file", F.to_json(RECORD).alias(CORRUPT), F.lit("a key does not fit its type").alias(REASON))
    return records, stored.where("_reject").select("_source_file", F.col("_json").alias(CORRUPT), REASON).unionByName(unfit)


def unknown_keys(stored: DataFrame, schema: StructType) -> DataFrame:
    """(key, kind, n): the top-level keys that the schema doesn't name, by the kind of their values, with their records.

    Kinds are VARIANT's (``BIGINT``, ``STRING``, ``OBJECT``, ``ARRAY``, ``VOID`` for null). The counts are combined map-side.
    """
    entries = stored.where("not _reject").lateralJoin(stored.sparkSession.tvf.variant_explode(F.col(RECORD).outer()))
    kind = F.regexp_extract(F.schema_of_variant("value"), r"^[A-Z]+", 0)
    return (entries.where(~F.col("key").isin(schema.fieldNames())).select("key", kind.alias("kind"))
                   .groupBy("key", "kind").agg(F.count(F.lit(1)).alias("n")))
