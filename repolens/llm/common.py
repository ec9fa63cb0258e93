"""Helpers shared by the operators: Arrow text access, tokens, durable intermediate results."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.session import ensure_checkpoint_dir

# White space of every word rule here: blank, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
TO_BLANK = bytes(0x20 if IS_SPACE[i] else i for i in range(256))
BLANKS = re.compile(rb" {2,}")
#: Bytes of text handled by one vectorised step; bounds the temporaries, never what is read.
STEP_BYTES = 1 << 20


def col(name: str) -> Column:
    """A column by its exact name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def one_per_group(df: DataFrame, text_col: str, id_col: str, tags: Callable[[list[bytes]], pa.Array], groups: DataFrame) -> DataFrame:
    """One row of ``df`` for each group, with its own columns: rows are told apart by id and tag, never by id alone.

    ``tags`` gives the tag of each text of a run. ``groups`` has one row (id, tag, grp, kept) per row of ``df``;
    a tag lies in one group, and the ``kept`` rows of a group share one id, null included. If several rows of a
    group are kept, that of the smallest tag stays, then that of the smallest JSON text of all its columns.
    """
    groups = durable(groups.select("id", "tag", "grp", "kept"))
    again = durable(groups.where("kept").groupBy("grp").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.min("tag").alias("tag")).where("n > 1"))
    gone = groups.where("not kept").select("id", "tag")
    name = "row_tag"
    while name in map(str.lower, df.columns):
        name += "_"
    at, src = df.columns.index(text_col), df
    if not isinstance(df.schema[at].dataType, T.StringType):
        at, src = len(df.columns), df.withColumn(name, col(text_col).cast("string"))
    own = df.columns
    schema = T.StructType([*df.schema.fields, T.StructField(name, groups.schema["tag"].dataType)])

    def tag(batches):
        for b in batches:
            found = [tags(texts) for _, texts in texts_of(b.column(at))]
            if found:
                yield pa.RecordBatch.from_arrays([*b.columns[:len(own)], pa.concat_arrays(found)], names=schema.names)

    rows = src.mapInArrow(tag, schema)

    def match(marks: DataFrame, how: str) -> DataFrame:
        marks = marks.select(F.col("id").alias("marked_id"), F.col("tag").alias("marked_tag")).distinct()
        return rows.join(marks, rows[f"`{name}`"].eqNullSafe(marks["marked_tag"])
                         & rows["`" + id_col.replace("`", "``") + "`"].eqNullSafe(marks["marked_id"]), how)

    if again.isEmpty():
        return match(gone, "left_anti").select(*map(col, own))
    more = groups.where("kept").join(again.select(F.col("grp").alias("g")), F.col("grp").eqNullSafe(F.col("g")), "left_semi")
    alone = match(gone.union(more.select("id", "tag")), "left_anti").select(*map(col, own))
    whole = F.struct(*map(col, own))
    first = match(again, "left_semi").groupBy(col(id_col), col(name)).agg(F.min_by(whole, F.to_json(whole)).alias("one"))
    return alone.union(first.select("one.*"))


def keyed_text(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """Only the columns a text pass reads, as (id, text, m0, m1, ...): extra columns never clash or travel."""
    return df.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"),
                     *(col(m).alias(f"m{i}") for i, m in enumerate(more)))


def durable(df: DataFrame) -> DataFrame:
    """Compute once into the shared checkpoint folder: readers share it and lost executors don't matter."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def steps(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: (first row, end row, bytes, offsets from 0).

    Null texts count as empty. A text over the limit is a run of its own; none is cut.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    n = len(texts)
    if not n:
        return
    at = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        yield first, end, data[at[first]:at[end]], at[first:end + 1] - at[first]
        first = end


def texts_of(texts: pa.Array, limit: int = STEP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, the texts of a run as bytes)."""
    for first, _, data, at in steps(texts, limit):
        raw = data.tobytes()
        cut = at.tolist()
        yield first, [raw[a:b] for a, b in zip(cut, cut[1:])]


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with about ``limit`` bytes of text in a column, so what is made of them stays small."""
    for b in batches:
        for first, end, _, _ in steps(b.column(column), limit):
            yield b.slice(first, end - first)


def one_blank(text: bytes) -> bytes:
    """Each run of white space becomes one blank (UTF-8 in, UTF-8 out)."""
    text = text.translate(TO_BLANK)
    return BLANKS.sub(b" ", text) if b"  " in text else text


def word_counts(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words (runs of other bytes than white space) of each text of a run."""
    if not len(data):
        return np.zeros(len(at) - 1, np.int64)
    space = IS_SPACE[data]
    start = ~space
    start[1:] &= space[:-1]
    inner = at[1:-1][at[1:-1] < len(data)]
    start[inner] = ~space[inner]  # a text's first byte starts a word whatever the text before ended with
    seen = np.concatenate(([0], np.cumsum(start)))
    return seen[at[1:]] - seen[at[:-1]]


def count_words(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(id, size long, m0, ...): the number of ``[^\\x20\\x09-\\x0D]+`` in each text, 0 for null."""
    src = keyed_text(df, id_col, text_col, *more)
    schema = T.StructType([src.schema["id"], T.StructField("size", T.LongType()), *src.schema.fields[2:]])

    def count(batches):
        for b in batches:
            sizes = [word_counts(data, at) for _, _, data, at in steps(b.column(1))]
            size = pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, *b.columns[2:]], names=schema.names)

    return src.mapInArrow(count, schema)


def union_forest(a, b, parent: dict) -> None:
    """Merge the pairs (a[i], b[i]) into ``parent``, a union-find forest whose roots are the smallest keys."""
    def find(x):
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while (up := parent.get(x, x)) != root:
            parent[x] = root
            x = up
        return root

    for x, y in zip(a, b):
        x, y = find(x), find(y)
        parent.setdefault(x, x)
        parent.setdefault(y, y)
        if x < y:
            parent[y] = x
        elif y < x:
            parent[x] = y


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: of one orderable type); root is the smallest node it reaches.

    Alternating large-star and small-star contraction: each round is two grouped minima and two joins,
    cut by a checkpoint, and the number of rounds grows with the logarithm of the longest chain. No node's
    neighbours are gathered anywhere. Self links add a node alone; repeated links change nothing.
    """
    def star(links: DataFrame) -> DataFrame:
        return links.groupBy("a").agg(F.min("b").alias("low"))

    def with_low(links: DataFrame, low: DataFrame) -> DataFrame:
        # by a struct of the key: both sides are dealt anew, so adaptive execution may split a hub's rows
        low = low.select(F.struct("a").alias("hub"), "low")
        return links.join(low, F.struct(links["a"]) == low["hub"]).drop("hub")

    now = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = with_low(both, low).where("b >= a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        low = star(large)
        small = with_low(large, low)
        now = durable(small.select(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b"))
                      .union(small.select("a", F.col("low").alias("b"))).distinct())
        was, mark = mark, now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == was:
            break
    return star(now).select(F.col("a").alias("node"), F.col("low").alias("root"))
