"""Keep-latest dedup, previous value in order (lag), most recent N per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .keys import join_null_safe
from .ranking import LOCAL, PART, range_sorted, with_position


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[str],
                   rank_col: str | None = None) -> DataFrame:
    """One row per key, the one that sorts first by ``newest_first`` DESC (NULLs last).

    Written as an aggregate (``max_by`` over a struct of the ordering columns)
    rather than ``row_number() = 1``: it is combined map-side, so a key that
    repeats billions of times is reduced before the shuffle instead of being
    sorted inside one task. Ties on every ordering column pick one row.
    ``rank_col`` adds the constant ``row_num = 1`` the SQL form exposes.
    """
    payload_cols = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(c) for c in newest_first])
    best = F.max_by(F.struct(*[F.col(c) for c in payload_cols]), order).alias("_best")
    out = df.groupBy(*keys).agg(best).select(*keys, *[F.col("_best")[c].alias(c) for c in payload_cols])
    out = out.select(*df.columns)
    if rank_col:
        out = out.withColumn(rank_col, F.lit(1).cast("long"))
    return out


def _previous_in_partition(keys: list[str], order: str):
    """Per-partition helper for :func:`lag_within` (runs on Arrow batches inside each task).

    The partition is already sorted by (keys, order, tiebreak). Each row gets the
    previous row's ``order`` value when that row has the same key, else it is a
    segment head (first row of its key in this partition). The last row of a
    batch is carried into the next batch of the same partition.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    def same_as_previous(col: pa.Array, carried) -> pa.Array:
        prev = pa.concat_arrays([pa.array([carried], type=col.type), col.slice(0, len(col) - 1)])
        eq = pc.equal(col, prev)
        both_null = pc.and_(pc.is_null(col), pc.is_null(prev))
        return pc.fill_null(pc.or_kleene(eq, both_null), False)

    def run(batches):
        carried = None   # (key values, order value) of the last row seen in this partition
        for b in batches:
            n = b.num_rows
            vals = b.column(order)
            if n == 0:
                yield b.append_column("_prev_in", pa.nulls(0, vals.type)).append_column(
                    "_head", pa.array([], pa.bool_()))
                continue
            same = None
            for i, k in enumerate(keys):
                eq = same_as_previous(b.column(k), carried[0][i] if carried else None)
                same = eq if same is None else pc.and_(same, eq)
            if same is None:      # no keys: one ordered sequence
                same = pa.array([True] * n, pa.bool_())
            if carried is None:   # the partition's first row has no predecessor here
                same = pa.concat_arrays([pa.array([False]), same.slice(1)])
            prev_vals = pa.concat_arrays([pa.array([carried[1] if carried else None], type=vals.type),
                                          vals.slice(0, n - 1)])
            prev = pc.if_else(same, prev_vals, pa.nulls(n, vals.type))
            carried = ([b.column(k)[n - 1].as_py() for k in keys], vals[n - 1].as_py())
            yield b.append_column("_prev_in", prev).append_column("_head", pc.invert(same))
    return run


def lag_within(df: DataFrame, keys: list[str], order: str, out: str = "prev",
               bounded_keys: bool = False, tiebreak: list[str] | None = None) -> DataFrame:
    """``lag(order) over (partition by keys order by order asc nulls last)`` without hot tasks.

    Rows are range-sorted and checkpointed (see :mod:`.ranking`), so a hot key
    spans many partitions of bounded size. Inside each partition the previous
    row is taken by a vectorised Arrow pass (``mapInArrow``) over the already
    sorted rows - a built-in window would need one more full shuffle, and that
    shuffle's hashing piles colliding segments back onto single tasks. The
    first row of a key in a partition takes the last value of the key's
    previous segment from a small per-segment table (built-in aggregate +
    ``lag`` over at most partitions + keys rows). ``tiebreak`` (e.g. a record
    id) lets rows with equal key and order value split across partitions too.
    """
    s = range_sorted(df, keys, [order], tiebreak)
    schema = StructType(list(s.schema.fields) + [
        StructField("_prev_in", s.schema[order].dataType, True), StructField("_head", BooleanType(), True)])
    inner = s.mapInArrow(_previous_in_partition(list(keys), order), schema)
    tails = (s.groupBy(*keys, PART).agg(F.max_by(order, LOCAL).alias("_last"))
              .select(*keys, PART, F.lag("_last").over(Window.partitionBy(*keys).orderBy(PART)).alias("_prev_seg")))
    # at most partitions + keys rows: broadcast only when the keys are bounded by construction
    joined = join_null_safe(inner, tails, keys + [PART], "left", broadcast_right=bounded_keys)
    prev = F.when(F.col("_head"), F.col("_prev_seg")).otherwise(F.col("_prev_in")).alias(out)
    return joined.select(*[c for c in df.columns], prev)


def recent_n_per_key(df: DataFrame, keys: list[str], newest_first: list[Column], n: int | None,
                     rank_col: str | None = "rn") -> DataFrame:
    """Keep the ``n`` most recent rows per key (``n`` falsy = unlimited, ``n < 0`` = none).

    ``newest_first`` should end in a unique column; rows equal in all of it are interchangeable. A capped
    key is first cut to ``n`` rows in each input partition, then once more over what is left, so a hot key
    is split over as many tasks as its rows come from, whatever ``n`` is (up to the group-limit threshold
    Spark also cuts before the first shuffle). Unlimited ranks come from exact range-sorted positions
    (:func:`.ranking.with_position`); unlimited without ``rank_col`` needs no ordering at all.
    """
    if n is not None and n < 0:
        out = df.limit(0)
        return out.withColumn(rank_col, F.lit(None).cast("long")) if rank_col else out
    if not n:
        if rank_col is None:
            return df
        ranked = with_position(df, keys, newest_first, out="_pos")
        return ranked.withColumn(rank_col, (F.col("_pos") + 1).cast("long")).drop("_pos")
    rc = rank_col or "_rn"
    part = Window.partitionBy(*keys, "_part").orderBy(*newest_first)
    cut = df.withColumn("_part", F.spark_partition_id()).withColumn(rc, F.row_number().over(part)).where(F.col(rc) <= F.lit(n))
    whole = Window.partitionBy(*keys).orderBy(*newest_first)
    ranked = cut.drop("_part", rc).withColumn(rc, F.row_number().over(whole)).where(F.col(rc) <= F.lit(n))
    ranked = ranked.withColumn(rc, F.col(rc).cast("long"))
    return ranked if rank_col else ranked.drop(rc)
