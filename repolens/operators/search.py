"""P9 over an index: trigram posting lists as bitmaps, intersected before any text is read.

Rows get dense numbers in the order of their ids. The index holds, for each gram of three code points and each block
of 32,768 numbers, the bitmap of the rows whose folded text has the gram. A query's grams select bitmaps
(the postings are sorted by gram, so files and row groups prune), their AND is a superset of the answer, and only
those rows are compared with the terms. Texts are folded and joined as :func:`.filters.search_terms` does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .filters import search_terms
from .ranking import with_position

GRAM = 3
ROW, HAY = "_row", "_hay"


def _grams(text: str) -> list[str]:
    return [text[i:i + GRAM] for i in range(len(text) - GRAM + 1)]


def query_grams(query: str) -> list[str]:
    """The grams that an answer's text must hold; terms shorter than a gram give none."""
    return sorted({g for t in query.split() for g in _grams(t.lower())})


def build_index(df: DataFrame, id_col: str, text_cols: list[str], path: str) -> None:
    """Write ``<path>/rows`` (all columns, row number, folded text) and ``<path>/postings`` (gram, block, bits).

    Rows with equal or NULL ids keep numbers of their own. A row is expanded to its distinct grams inside one
    task and put back together as bitmaps in the same stage's partial aggregate: what is shuffled is at most
    4 KB for a gram and block of each task.
    """
    hay = F.lower(F.concat_ws(" ", *[F.col(c).cast("string") for c in text_cols]))
    rows = with_position(df.withColumn(HAY, hay), [], [id_col], out=ROW)
    rows.write.mode("overwrite").parquet(f"{path}/rows")
    stored = df.sparkSession.read.parquet(f"{path}/rows")
    starts = F.sequence(F.lit(1), F.char_length(HAY) - (GRAM - 1))
    grams = F.when(F.char_length(HAY) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(F.col(HAY), i, F.lit(GRAM)))))
    number = F.col(ROW) + 1  # Spark's blocks begin at 1
    (stored.select(ROW, F.explode(grams).alias("gram"))
     .groupBy("gram", F.bitmap_bucket_number(number).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
     .repartitionByRange("gram", "block").sortWithinPartitions("gram", "block").write.mode("overwrite").parquet(f"{path}/postings"))


def candidates(spark: SparkSession, path: str, grams: list[str]) -> DataFrame:
    """(row): the numbers of the rows that hold every gram."""
    lists = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(grams))
    both = lists.groupBy("block").agg(F.count("*").alias("n"), F.bitmap_and_agg("bits").alias("bits")).where(F.col("n") == len(grams))

    def numbers(batches):
        for b in batches:
            for block, bits in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) + (block - 1) * 8 * len(bits)
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64())], names=["row"])

    return both.select("block", "bits").mapInArrow(numbers, "row long")


def search_index(spark: SparkSession, path: str, query: str) -> DataFrame:
    """The rows that :func:`.filters.search_terms` gives for ``query``, with their own columns.

    A query without a term of at least three code points has no grams: every row is compared.
    """
    rows = spark.read.parquet(f"{path}/rows")
    grams = query_grams(query)
    if grams:
        rows = rows.join(candidates(spark, path, grams), F.col(ROW) == F.col("row"), "left_semi")
    return search_terms(rows, query, [HAY]).drop(ROW, HAY)
