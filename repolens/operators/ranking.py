"""Skew-proof ordered positions inside key groups.

A plain ``Window.partitionBy(key)`` puts every row of a key into one task, so a
repository holding a third of all rows becomes a third of the job on one core.
Here rows are range-partitioned on ``(key, order)`` instead: the sampled range
bounds split a hot key over as many partitions as its size needs. Each
partition is sorted locally and every row gets (partition, local position);
the result is checkpointed to the reliable checkpoint folder so these tags are
fixed for every later reader and survive lost executors. Per-(key, partition)
segment sizes are a small table (at most partitions + keys - 1 rows) whose
running sums turn local positions into positions inside the key.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window, functions as F

from ..session import ensure_checkpoint_dir
from .keys import join_null_safe

PART = "_seg_part"
LOCAL = "_seg_local"
_POS = "_seg_pos"
_ROW_BITS = 33  # monotonically_increasing_id: partition index above bit 33, row index below


def _sort_col(c):
    """A column name sorts ascending with NULLs last; a Column sort order is used as given."""
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def range_sorted(df: DataFrame, keys: list[str], order: list, tiebreak: list[str] | None = None
                 ) -> DataFrame:
    """Range-partition and sort on ``keys + order + tiebreak`` (ascending, NULLs last), tag rows, checkpoint.

    Range bounds cannot split rows whose sort key is identical, so a hot group
    of copies (same key, same time) would still land in one task; a
    ``tiebreak`` column that differs between copies (a record id) lets the
    bounds split them too. It never changes results: tied rows are
    interchangeable for lag values and for order statistics.
    """
    ensure_checkpoint_dir(df.sparkSession)
    sort_cols = [_sort_col(c) for c in list(keys) + list(order) + list(tiebreak or [])]
    # The range partitioner samples its input in a separate job; keeping the (narrow) input
    # until the checkpoint is written stops that job from recomputing the whole upstream plan.
    ours = not df.is_cached          # never release a cache the caller made
    src = df.persist(StorageLevel.MEMORY_AND_DISK) if ours else df
    try:
        tagged = (src.repartitionByRange(*sort_cols)
                     .sortWithinPartitions(*sort_cols)
                     .withColumn(_POS, F.monotonically_increasing_id()))
        fixed = tagged.checkpoint(eager=True)
    finally:
        if ours:
            src.unpersist()
    return fixed.select(*[c for c in fixed.columns if c != _POS],
                        F.shiftright(F.col(_POS), _ROW_BITS).cast("int").alias(PART),
                        F.col(_POS).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(LOCAL))


def segments(sorted_df: DataFrame, keys: list[str], extra_aggs: list | None = None) -> DataFrame:
    """One row per (key, partition): first local position, size, offset inside the key, key size."""
    seg = sorted_df.groupBy(*keys, PART).agg(
        F.min(LOCAL).alias("_first"), F.count(F.lit(1)).alias("_cnt"), *(extra_aggs or []))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return seg.select("*", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("long").alias("_off"),
                      F.sum("_cnt").over(Window.partitionBy(*keys)).cast("long").alias("_n"))


def with_position(df: DataFrame, keys: list[str], order: list, out: str = "position",
                  bounded_keys: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    """Add the 0-based position of each row inside its key, ordered by ``order`` (names sort
    ascending with NULLs last; Column sort orders such as ``F.col("t").desc()`` are used as given).

    ``bounded_keys`` says the number of distinct keys is known to be small (for
    example a top-k cohort), which bounds the segment table and allows a broadcast.
    """
    s = range_sorted(df, keys, order, tiebreak)
    seg = segments(s, keys).select(*keys, PART, "_first", "_off")
    out_df = join_null_safe(s, seg, keys + [PART], "inner", broadcast_right=bounded_keys)
    return (out_df.withColumn(out, F.col("_off") + F.col(LOCAL) - F.col("_first"))
                  .drop(PART, LOCAL, "_first", "_off"))
