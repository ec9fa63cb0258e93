"""Exact dedup by content-defined chunk recipes.

A text (white-space runs as one blank) is cut where a 16-byte window's hash says so, hence equal texts
are cut alike. Its recipe is the ordered list of chunk identifiers. Chunks move once, after each map
task has dropped its own repeats; where one key comes with different bytes, the key's variants get
identifiers of their own, so equal identifiers always mean equal bytes. Texts are then equal exactly
when their recipes are: only recipes, never texts, are grouped and joined.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import durable, keyed_text, one_blank, one_per_group, texts_of

KEY_BYTES = 16
MEAN_CHUNK, LEAST_CHUNK, MOST_CHUNK = 2048, 512, 16384
# odd multipliers of the window hash
_M = np.uint32(0x9E3779B1)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(29)).astype(np.uint32)


def cut_points(data: bytes) -> np.ndarray:
    """Ends of windows that may end a chunk: one in MEAN_CHUNK, by the 16 bytes before the cut alone."""
    h, m = _BYTE[np.frombuffer(data, np.uint8)], _M
    for width in (1, 2, 4, 8):
        h = h[:-width] * m + h[width:]
        m = m * m
    return np.flatnonzero(h >> np.uint32(32 - MEAN_CHUNK.bit_length() + 1) == 0) + 16


def chunks_of(text: bytes) -> list[bytes]:
    """The content-defined chunks; their concatenation is the text. An empty text has none."""
    if len(text) <= MEAN_CHUNK:
        return [text] if text else []
    with np.errstate(over="ignore"):
        cuts = cut_points(text)
    out, begin = [], 0
    for end in (*cuts.tolist(), len(text)):
        while end - begin > MOST_CHUNK:
            out.append(text[begin:begin + MOST_CHUNK])
            begin += MOST_CHUNK
        if end - begin >= LEAST_CHUNK or end == len(text):
            if end > begin:
                out.append(text[begin:end])
            begin = end
    return out


def chunk_key(chunk: bytes, key_bytes: int) -> bytes:
    return xxhash.xxh3_128_digest(chunk)[:key_bytes]


def recipes(df: DataFrame, id_col: str, text_col: str, key_bytes: int = KEY_BYTES) -> DataFrame:
    """(id, sha256 of the normalised text, recipe: the chunk keys in order)."""
    src = keyed_text(df, id_col, text_col)
    schema = T.StructType([src.schema["id"], T.StructField("sha256", T.StringType()), T.StructField("recipe", T.BinaryType())])

    def build(batches):
        for b in batches:
            sha, recipe = [], []
            for _, texts in texts_of(b.column(1)):
                for t in map(one_blank, texts):
                    sha.append(hashlib.sha256(t).hexdigest())
                    recipe.append(b"".join(chunk_key(c, key_bytes) for c in chunks_of(t)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sha, pa.string()), pa.array(recipe, pa.binary())], names=schema.names)

    return src.mapInArrow(build, schema)


def _chunk_rows(df: DataFrame, id_col: str, text_col: str, key_bytes: int, places: bool) -> DataFrame:
    """(key, chunk), each once per batch; with ``places`` every chunk as (sha256 of its text, pos, key, chunk)."""
    src = keyed_text(df, id_col, text_col)
    pair = [T.StructField("key", T.BinaryType()), T.StructField("chunk", T.BinaryType())]
    schema = T.StructType(([T.StructField("sha256", T.StringType()), T.StructField("pos", T.LongType())] if places else []) + pair)

    def cut(batches):
        for b in batches:
            sha, pos, found = [], [], []
            seen: set[bytes] = set()
            for _, texts in texts_of(b.column(1)):
                for t in map(one_blank, texts):
                    name = hashlib.sha256(t).hexdigest() if places else ""
                    for k, c in enumerate(chunks_of(t)):
                        if places or c not in seen:
                            seen.add(c)
                            found.append(c)
                            sha.append(name)
                            pos.append(k)
            cols = [pa.array([chunk_key(c, key_bytes) for c in found], pa.binary()), pa.array(found, pa.binary())]
            if places:
                cols = [pa.array(sha, pa.string()), pa.array(pos, pa.int64()), *cols]
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(cut, schema)


def ambiguous_keys(df: DataFrame, id_col: str, text_col: str, key_bytes: int = KEY_BYTES) -> DataFrame:
    """(key) of the keys that stand for different bytes: all bytes of equal keys are compared.

    Equal chunks are combined before the one shuffle that moves them, so a chunk that all documents share
    is one row a map task; after it only keys travel. Spark's aggregates spill, no task holds its chunks.
    """
    each = _chunk_rows(df, id_col, text_col, key_bytes, False).distinct()
    return each.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")


def chunk_variants(df: DataFrame, keys: DataFrame, id_col: str, text_col: str, key_bytes: int = KEY_BYTES) -> DataFrame:
    """(key, chunk, variant): the chunks of the given keys, numbered from 0 in the order of their bytes."""
    each = _chunk_rows(df, id_col, text_col, key_bytes, False).join(keys, "key", "left_semi").distinct()
    return each.withColumn("variant", F.row_number().over(Window.partitionBy("key").orderBy("chunk")) - 1)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bytes: int = KEY_BYTES) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256): one row per input row, whole texts compared.

    Texts are equal when identical after each white-space run is one blank; null counts as empty. The
    smallest id of a group stays; a null id stays only where no row of the group has an id. Rows that
    repeat an id and a text are alike here, so ``kept`` holds for all or none; ``exact_dedup`` keeps one of
    them. No rows give none.
    """
    known = durable(recipes(df, id_col, text_col, key_bytes))
    keys = durable(ambiguous_keys(df, id_col, text_col, key_bytes))
    if keys.isEmpty():
        named = known.withColumn("names", F.lit(None).cast("binary"))
    else:
        unclear = durable(chunk_variants(df, keys, id_col, text_col, key_bytes))
        # recipes that hold such a key are told apart by the variants at their places as well
        where = _chunk_rows(df, id_col, text_col, key_bytes, True).join(unclear, ["key", "chunk"])
        places = F.collect_set(F.format_string("%019d:%d", "pos", "variant"))
        names = where.groupBy("sha256").agg(F.concat_ws(",", F.array_sort(places)).cast("binary").alias("names"))
        named = known.join(names, "sha256", "left")
    groups = named.groupBy("recipe", "names").agg(F.min("id").alias("keep_id"), F.count("*").alias("group_size"))
    g = groups.select(F.col("recipe").alias("r"), F.col("names").alias("n"), "keep_id", "group_size")
    # a hot recipe's rows meet one group row: adaptive execution splits that side of the join
    out = named.join(g, (F.col("recipe") == F.col("r")) & F.col("names").eqNullSafe(F.col("n")))
    return out.select("id", "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      F.col("sha256").alias("text_sha256"))


def exact_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``df`` for each distinct text, with its own columns: that of the smallest id, a null id if there is no other."""
    def tags(texts):
        return pa.array([hashlib.sha256(one_blank(t)).hexdigest() for t in texts], pa.string())

    groups = exact_groups(df, id_col, text_col).withColumnRenamed("text_sha256", "tag")
    return one_per_group(df, text_col, id_col, tags, groups.withColumn("grp", F.col("tag")))
