"""Landed JSON pages -> typed records + rejects, one record at a time.

Layout: ``<root>/entity=<name>/repo=<owner>__<name>/<page>.json`` where a page is one JSON array of
records, a single object, or JSON Lines; empty text is an empty page. Every file is read, whatever its
name: ``.jsonl`` / ``.ndjson`` files (also compressed) line by line, split over tasks like any text file; all
others (an API page holds at most 100 records) as one text row each, unless they are large (:data:`WHOLE_BYTES`)
and hold JSON Lines: those are read line by line too. Batch, issues and stream share one path:

1. a page is split into its records' JSON text; text that is no array, object or lines is one reject;
2. each record is parsed with the entity schema; one that is no object, or in which a present key did not
   fit its type, is a reject of its own and never touches its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.filters import lacks_json_key
from ..schemas import ENTITY_SCHEMAS
from ..session import open_writers

CORRUPT = "_corrupt_record"
REASON = "_reason"
REPO_SEP = "__"
PACKED_NAME = r"(?i)\.(gz|gzip|bz2|zst|lz4|snappy|deflate)$"
LINES_NAME = r"(?i)\.(jsonl|ndjson)(\.(gz|gzip|bz2|zst|lz4|snappy|deflate))?$"
LINE_END = "\r\n|\r|\n"
REJECT_COLUMNS = ["_source_file", CORRUPT, REASON]
#: A page up to this size is one text row; of larger ones only those that are no JSON Lines.
WHOLE_BYTES = 1 << 20
#: JSON text is at least so many times the size of its compressed file.
UNPACKED = 4
LINE, START = "_line", "_start"


def repo_from_path(path_col: str = "_source_file") -> Column:
    """The repository named by the ``repo=<owner>__<name>`` folder of a page (NULL if none).

    Taken from the file path rather than partition discovery: a discovered ``repo`` partition column
    would overwrite GraphQL records' own ``repo`` field. The first separator ends the owner (an owner
    holds no underscore); further ones belong to the name.
    """
    folder = F.url_decode(F.regexp_extract(F.col(path_col), r"/repo=([^/]+)/", 1))
    return F.when(folder != "", F.regexp_replace(folder, f"^(.*?){REPO_SEP}", "$1/"))


def page_rows(reader) -> DataFrame:
    """(value, _source_file, _file_time, _line, _start) of a text read, batch or stream.

    ``_line``: the row is one line of a large page, read from the file's block that begins at ``_start``.
    """
    path = F.col("_metadata.file_path")
    return reader.select("value", path.alias("_source_file"), F.col("_metadata.file_modification_time").alias("_file_time"),
                         (~by_line() & is_large()).alias(LINE), F.col("_metadata.file_block_start").alias(START))


def by_line() -> Column:
    """Files named as files of lines. A condition on a file's name, path or size alone picks the files before any is read."""
    return F.col("_metadata.file_path").rlike(LINES_NAME)


def is_large() -> Column:
    size, packed = F.col("_metadata.file_size"), F.col("_metadata.file_path").rlike(PACKED_NAME)
    return F.when(packed, size * UNPACKED).otherwise(size) > WHOLE_BYTES


def _trimmed(line) -> Column:
    return F.btrim(line, F.lit(" \t"))


def whole_pages(pages: DataFrame) -> list[str]:
    """The large pages that must be read whole: arrays, objects over several lines, unreadable text.

    All other large pages are JSON Lines as :func:`_record_texts` knows them: their first line is a whole object, or
    it is no JSON and some other line is one. Per file only numbers are aggregated (map-side); the driver gets
    the paths of the pages found, of which each is large.
    """
    x = F.col("x")
    a_value = F.json_array_length(F.concat(F.lit("["), x, F.lit(",0]"))) == 2    # neither cut off nor closed early
    kind = F.when(x.startswith("{"), F.when(a_value, 1).otherwise(0)).when(x.startswith("["), 0).otherwise(2)
    rows = pages.where(LINE).select("_source_file", START, F.monotonically_increasing_id().alias("row"), _trimmed("value").alias("x"))
    rows = rows.select("_source_file", START, "row", kind.cast("long").alias("kind"), x.endswith("}").alias("ends"),
                       x.startswith("]").alias("closes"), (x != "").alias("filled"))
    # rows of a file's first block stand in one task, in order
    first = F.min(F.when((F.col(START) == 0) & F.col("filled"), F.col("row") * 4 + F.col("kind"))) % 4
    count = lambda c: F.count(F.when(c, 1))
    found = rows.groupBy("_source_file").agg(first.alias("first"), count(F.col("filled")).alias("n"), count(F.col("closes")).alias("closed"),
                                     count((F.col("kind") == 1) & F.col("ends")).alias("objects"))
    of_lines = (F.col("n") > 1) & (F.col("objects") > 0) & ((F.col("first") == 2) | (F.col("first") == 1) & (F.col("closed") == 0))
    return [r["_source_file"] for r in found.where(~F.coalesce(of_lines, F.lit(False))).select("_source_file").collect()]


def _pages(spark: SparkSession, path: str) -> DataFrame:
    texts = lambda **how: spark.read.text(path, recursiveFileLookup=True, **how)
    lines = page_rows(texts().where(by_line() | is_large()))
    pages = page_rows(texts(wholetext=True).where(~by_line() & ~is_large()))
    return with_whole_pages(lines, whole_pages(lines), lambda: texts(wholetext=True)).unionByName(pages)


def with_whole_pages(pages: DataFrame, whole: list[str], texts) -> DataFrame:
    """``pages`` with these large ones as one row each (of the text read ``texts()``) in place of their lines."""
    if not whole:
        return pages
    rows = page_rows(texts().where(F.col("_metadata.file_path").isin(whole))).withColumn(LINE, F.lit(False))
    return pages.where(~F.col("_source_file").isin(whole)).unionByName(rows)


def _record_texts(pages: DataFrame) -> DataFrame:
    """The pages with ``_texts``, the JSON text of a page's records; NULL for an unreadable page.

    JSON Lines are taken line by line unless the first line is a lone ``{``, which begins one object
    written over several lines. A first line that is no JSON doesn't matter where a line is an object; text
    that begins with ``[`` is an array or unreadable.
    """
    v, lines, x = F.col("_v"), F.col("_lines"), _trimmed("value")
    split = F.filter(F.transform(F.split(v, LINE_END), _trimmed), lambda x: x != "")
    one = F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1
    an_object = lambda x: x.startswith("{") & x.endswith("}") & F.json_object_keys(x).isNotNull()
    none = F.array().cast("array<string>")
    texts = (F.when(F.col(LINE), F.when(x == "", none).otherwise(F.array(x)))
              .when(v == "", none)
              .when(F.json_array_length(v).isNotNull(), F.from_json(v, "array<string>"))
              .when(v.startswith("{") & one, F.array(v))
              .when((F.size(lines) > 1) & (lines[0] != "{") & (v.startswith("{") | F.exists(lines, an_object)), lines))
    # columns of their own: what is used several times is worked out once
    return (pages.withColumn("_v", F.trim("value")).withColumn("_lines", F.when(~F.col(LINE) & ~v.startswith("["), split))
                 .withColumn("_texts", texts))


def split_records(pages: DataFrame, apart: bool = False) -> DataFrame:
    """(_source_file, _file_time, _json, _reason): one row per record, or per unreadable page with a reason.

    With ``apart`` the lines of large pages are taken as the records they are, apart from the pages that must be
    looked at as text. The two conditions pick whole files, so a batch reads none twice; a stream's batch can't leave files out.
    """
    if not apart:
        return _split_texts(pages)
    lone = pages.where(LINE).select("_source_file", "_file_time", _trimmed("value").alias("_json"), F.lit(None).cast("string").alias(REASON))
    return lone.where(F.col("_json") != "").unionByName(_split_texts(pages.where(~F.col(LINE))))


def _split_texts(pages: DataFrame) -> DataFrame:
    lone = F.col(LINE) if LINE in pages.columns else F.lit(False)
    # a file of lines that was read whole is cut at the line ends that the reader knows
    lines = F.when(F.col("_source_file").rlike(LINES_NAME), F.split("value", LINE_END)).otherwise(F.array("value"))
    pages = _record_texts(pages.select("_source_file", "_file_time", lone.alias(LINE), F.explode(lines).alias("value")))
    good = F.transform("_texts", lambda x: F.struct(x.alias("_json"), F.lit(None).cast("string").alias(REASON)))
    bad = F.array(F.struct(F.col("value").alias("_json"), F.lit("unreadable page").alias(REASON)))
    return pages.select("_source_file", "_file_time", F.explode(F.when(F.col("_texts").isNull(), bad).otherwise(good)).alias("_r")) \
                .select("_source_file", "_file_time", "_r.*")


def tag_records(records: DataFrame, sch: StructType) -> DataFrame:
    """The records of :func:`split_records` with their parse ``_p`` and why they are rejects (``_reason``, NULL for good ones)."""
    full = StructType(list(sch.fields) + [StructField(CORRUPT, StringType())])
    parsed = records.withColumn("_p", F.from_json("_json", full, {"columnNameOfCorruptRecord": CORRUPT}))
    misfit = F.col("_json").isNull() | F.col(f"_p.{CORRUPT}").isNotNull()
    why = F.coalesce(F.col(REASON), F.when(misfit, F.when(F.json_object_keys("_json").isNull(), F.lit("not an object"))
                                           .otherwise(F.lit("a key does not fit its type"))))
    return parsed.withColumn(REASON, why)


def staged(tagged: DataFrame, path: str) -> DataFrame:
    """The tagged records written once, good ones and rejects in folders of their own, and read back.

    Whoever reads one side then neither reads a page again nor parses it.
    """
    out = tagged.withColumn("_reject", F.col(REASON).isNotNull())
    with open_writers(out.sparkSession):
        out.write.mode("overwrite").partitionBy("_reject").parquet(path)
    return out.sparkSession.read.schema(out.schema).parquet(path)


def separated(parsed: DataFrame, sch: StructType, raw_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(records, rejects)`` of tagged records; each side prunes the other's folder where they were staged."""
    is_reject = F.col("_reject") if "_reject" in parsed.columns else F.col(REASON).isNotNull()
    rejects = parsed.where(is_reject).select("_source_file", F.coalesce("_json", F.lit("null")).alias(CORRUPT), REASON)
    out = parsed.where(~is_reject).select("_source_file", "_file_time", "_json", "_p.*").drop(CORRUPT)
    if "repository_full_name" in sch.fieldNames():
        out = out.withColumn("repository_full_name", F.coalesce(F.col("repository_full_name"), repo_from_path()))
    if "fetched_at" in sch.fieldNames():
        out = out.withColumn("fetched_at", F.coalesce(
            F.col("fetched_at"), F.date_format(F.col("_file_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")))
    extra = [F.col("_json").alias(raw_col)] if raw_col else []
    return out.select(*sch.fieldNames(), *extra, "_source_file"), rejects


def parse_records(records: DataFrame, sch: StructType, raw_col: str | None = None, stage: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Type the records of :func:`split_records`; returns ``(records, rejects)``, batch and stream alike.

    The repository falls back to the ``repo=`` folder and ``fetched_at`` to the file's modification time
    (never the wall clock at read). ``raw_col`` keeps each record's JSON text, unknown keys included. With
    ``stage`` the parse is written to that folder once and both frames read it (:func:`staged`).
    """
    tagged = tag_records(records, sch)
    if stage:
        # good records' text is only written for ``raw_col``
        kept = tagged if raw_col else tagged.withColumn("_json", F.when(F.col(REASON).isNotNull(), F.col("_json")))
        tagged = staged(kept, stage)
    return separated(tagged, sch, raw_col)


def parse_pages(pages: DataFrame, sch: StructType, raw_col: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Page rows (``value``, ``_source_file``, ``_file_time``) -> typed records + rejects."""
    return parse_records(split_records(pages), sch, raw_col)


def _page_order(path_col: str = "_source_file") -> Column:
    """Pages of a repository in order: by the first number in the file name, then by path."""
    name = F.regexp_extract(F.col(path_col), r"([^/]*)$", 1)
    number = F.regexp_extract(name, r"(\d+)", 1)
    return F.struct(F.when(number != "", F.lpad(number, 20, "0")).otherwise("").alias("n"), F.col(path_col).alias("p"))


def _end_after_bad_page(records: DataFrame) -> DataFrame:
    """Records of pages after a repository's first unreadable page become rejects with that reason."""
    tagged = records.withColumn("_repo", repo_from_path()).withColumn("_page", _page_order())
    first = (tagged.where(F.col(REASON).isNotNull() & F.col("_repo").isNotNull())
                   .groupBy(F.col("_repo").alias("_bad_repo")).agg(F.min("_page").alias("_first_bad")))
    late = F.when(F.col("_page") > F.col("_first_bad"), F.lit("after an unreadable page"))
    return (tagged.join(first, F.col("_repo") == F.col("_bad_repo"), "left")
                  .select("_source_file", "_file_time", "_json", F.coalesce(F.col(REASON), late).alias(REASON)))


def entity_path(root: str, entity: str, repos: list[str] | None = None) -> str:
    """The entity's landing folder, or a glob over just the allowed repositories' folders.

    Reading only those folders keeps the other repositories' pages from being listed or parsed at all
    (repository names hold no glob characters).
    """
    base = f"{root.rstrip('/')}/entity={entity}"
    if not repos:
        return base
    names = ",".join(sorted(r.replace("/", REPO_SEP, 1) for r in repos))
    return f"{base}/repo={{{names}}}"


def read_pages(spark: SparkSession, root: str, entity: str, schema: StructType | None = None,
               on_bad_page: str = "skip_page", repos: list[str] | None = None, raw_col: str | None = None,
               without_key: str | None = None, stage: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Read one entity's pages with an explicit schema; returns ``(records, rejects)``.

    Every landed record is in one of the two. ``on_bad_page``: ``"skip_page"`` rejects an unreadable page
    alone, ``"end_repository"`` also rejects the pages after it in that repository. ``repos`` limits the
    read to those repositories' folders (see :func:`entity_path`). ``without_key`` leaves out records
    that hold this key at all (P4): they belong to another entity. ``stage`` names a folder for the
    parsed records where both frames are used.
    """
    sch = schema or ENTITY_SCHEMAS[entity]
    records = split_records(_pages(spark, entity_path(root, entity, repos)), apart=True)
    if on_bad_page == "end_repository":
        records = _end_after_bad_page(records)
    elif on_bad_page != "skip_page":
        raise ValueError("on_bad_page must be 'end_repository' or 'skip_page'")
    if without_key:
        records = lacks_json_key(records, "_json", without_key)
    return parse_records(records, sch, raw_col, stage)


def read_issue_pages(spark: SparkSession, root: str, schema: StructType | None = None,
                     repos: list[str] | None = None, **how) -> tuple[DataFrame, DataFrame]:
    """Issues without the pull requests that the issues endpoint lists (records with a ``pull_request`` key)."""
    return read_pages(spark, root, "issues", schema, repos=repos, without_key="pull_request", **how)
