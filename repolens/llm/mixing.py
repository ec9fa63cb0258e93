"""Mixing sources to target token counts by entropy balancing.

Each document gets a rate of copies between 0 and ``most``. Among all rates that give every source its
target tokens, those of least relative entropy to one half of ``most`` are exponential tilts of the
document's size: rate = most / (1 + exp(-t * size / mean)), one multiplier t a source. The multipliers
maximise a concave dual; its Newton steps are grouped sums over (source, size, documents) rows, so each
iteration reads the table of distinct sizes and moves one row a source. The rates are then rounded to
whole copies by carrying the error from large documents to small ones within blocks of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import count_words, durable

WEIGHTS = (5.0, 2.0, 1.0)
#: Documents of a source that one block rounds together, on average.
BLOCK_DOCS = 2048
#: A multiplier is found when the source's expected tokens are this close to its target.
CLOSE = 1e-9
#: or when it is known this closely; the rates only use nine digits of it.
NARROW = 1e-12


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, source_size, docs) of (source, size) rows."""
    return sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs"))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, docs, target): ``share`` of all tokens by weight, at most ``most`` times a source.

    Weights repeat over the sources by code point, null last. A source whose part exceeds its bound gets
    the bound, and the rest is shared again by weight. With bound per weight q = most * size / weight the
    sources met first are those of small q: source k is bounded when sharing what the smaller ones left
    would still exceed its bound. One window over the sources' rows (one row a source) finds them all.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    pick = F.array(*(F.lit(float(w)) for w in weights))
    x = sizes.withColumn("weight", F.element_at(pick, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    x = x.withColumn("bound", F.lit(float(most)) * F.col("source_size")).withColumn("q", F.col("bound") / F.col("weight"))
    rank = Window.orderBy("q", F.col("source").isNull(), F.col("source").cast("binary"))
    before, all_rows = rank.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    total = F.lit(float(share)) * F.sum("source_size").over(all_rows)
    left = total - F.coalesce(F.sum("bound").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    x = x.withColumn("price", left / open_weight).withColumn("full", F.col("price") > F.col("q"))
    # from the first source that fits on, one price holds
    price = F.min(F.when(~F.col("full"), F.struct("q", "price"))).over(all_rows)["price"]
    target = F.when(F.col("full"), F.col("bound")).otherwise(F.least(F.col("weight") * price, F.col("bound")))
    return x.select("source", "source_size", "docs", target.alias("target"))


def tilt(t: Column, size: Column, mean: Column, most: float) -> Column:
    """The rate of a document: most / (1 + exp(-t * size / mean)), exact at both ends."""
    return F.lit(most) / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -t * size / mean))))


def multipliers(sized: DataFrame, goals: DataFrame, most: float = 2.0) -> DataFrame:
    """(source, source_size, docs, target, t, mean): Newton's iterations for the dual's multipliers, all sources at once.

    A step that leaves the interval known to hold the root is replaced by its middle, so every source
    converges; the loop ends when all are CLOSE or their intervals are too narrow to matter. A target at its
    bound or at 0 needs no multiplier.
    """
    cases = durable(sized.groupBy("source", "size").agg(F.count("*").alias("n")))
    mean = F.col("source_size") / F.col("docs")
    state = durable(goals.withColumns({
        "mean": mean, "t": F.lit(0.0), "low": F.lit(None).cast("double"), "high": F.lit(None).cast("double"),
        "open": (F.col("target") > 0) & (F.col("target") < most * F.col("source_size"))}))
    while True:
        s = state.where("open").select(F.col("source").alias("s"), "mean", "t")
        x = cases.join(s, F.col("source").eqNullSafe(F.col("s")))
        rate = tilt(F.col("t"), F.col("size"), F.col("mean"), most)
        sums = x.groupBy(F.col("s").alias("src")).agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("got"),
            F.sum(F.col("n") * F.col("size") * F.col("size") / F.col("mean") * rate * (1 - rate / most)).alias("slope"))
        y = state.join(sums, F.col("source").eqNullSafe(F.col("src")), "left")
        off = F.col("got") - F.col("target")
        done = F.coalesce(F.abs(off) <= CLOSE * F.col("target"), F.lit(True))
        low = F.when(off < 0, F.col("t")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("t")).otherwise(F.col("high"))
        done = done | F.coalesce(high - low <= NARROW * F.greatest(F.lit(1.0), F.abs("t")), F.lit(False))
        newton = F.col("t") - off / F.greatest(F.col("slope"), F.lit(1e-300))
        # outside what is known: the middle, or twice as far where one side is open
        safe = (F.when(low.isNotNull() & high.isNotNull(), F.when((newton > low) & (newton < high), newton).otherwise((low + high) / 2))
                .when(low.isNotNull(), F.least(newton, 2 * F.abs(low) + 4)).otherwise(F.greatest(newton, -2 * F.abs(high) - 4)))
        state = durable(y.select("source", "source_size", "docs", "target", "mean",
                                 F.when(done, F.col("t")).otherwise(safe).alias("t"), low.alias("low"), high.alias("high"),
                                 (F.col("open") & ~done).alias("open")))
        if state.where("open").isEmpty():
            break
    t = F.when(F.col("target") <= 0, F.lit(float("-inf"))).when(F.col("target") >= most * F.col("source_size"), F.lit(float("inf"))).otherwise(
        F.round("t", 9))  # sums of doubles differ in their last digits with the order of rows; the rates must not
    return state.select("source", "source_size", "docs", "target", "mean", t.alias("t"))


def round_rates(rows: DataFrame, most: int) -> DataFrame:
    """Whole ``copies`` for rows (block..., size, rate): large documents first, each takes up the error so far.

    Rows come sorted by block and falling size. What a block misses is at most half of its last, smallest
    document (more only if that one is at a bound), and the blocks' errors don't add up in one direction.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("copies", T.LongType())])

    def run(batches):
        block, carry = None, 0.0
        for b in batches:
            names = b.schema.names
            copies = np.zeros(b.num_rows, np.int64)
            keys = list(zip(b.column(names.index("source")).to_pylist(), b.column(names.index("block")).to_pylist()))
            for i, (k, size, rate) in enumerate(zip(keys, b.column(names.index("size")).to_pylist(), b.column(names.index("rate")).to_pylist())):
                if k != block:
                    block, carry = k, 0.0
                want = rate + (carry / size if size else 0.0)
                copies[i] = min(most, max(0, int(np.floor(want + 0.5))))
                carry += (rate - copies[i]) * size
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(copies)], names=schema.names)

    return rows.mapInArrow(run, schema)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights=WEIGHTS, share: float = 1.5, most: int = 2) -> DataFrame:
    """(id, source, size, source_size, target, rate, copies): one row per input row.

    size counts words (null text: 0), so texts without words have rate ``most`` / 2 and cost nothing.
    Sources by code point, null last, which is a source like any other. Equal input gives equal output:
    blocks and orders come from the id and size; repeated rows are interchangeable. No rows give none.
    """
    counted = durable(count_words(df, id_col, text_col, source_col).select("id", "size", F.col("m0").cast("string").alias("source")))
    solved = multipliers(counted, targets(source_sizes(counted), weights, share, most), most).withColumnRenamed("source", "s")
    y = counted.join(solved, F.col("source").eqNullSafe(F.col("s")))
    rate = tilt(F.col("t"), F.col("size"), F.greatest(F.col("mean"), F.lit(1e-9)), float(most))
    rate = F.when(F.col("size") == 0, F.lit(most / 2)).when(F.col("target") <= 0, F.lit(0.0)).when(F.col("target") >= most * F.col("source_size"), F.lit(float(most))).otherwise(rate)
    blocks = F.ceil(F.col("docs") / BLOCK_DOCS)
    block = F.pmod(F.xxhash64(F.col("id").cast("string"), "size"), blocks)
    y = y.select("id", "source", "size", "source_size", "target", rate.alias("rate"), block.alias("block"))
    y = y.repartition("source", "block").sortWithinPartitions("source", "block", F.desc("size"), "id")
    return round_rates(y, most).drop("block")


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it (not at all, once, twice), with its own columns.

    Rows that share an id take the copies that their id got on average, rounded down, at least one if any.
    """
    taken = mix(df, id_col, text_col, source_col, **how).groupBy(F.col("id").alias("mix_id")).agg(
        F.greatest(F.floor(F.avg("copies")), F.max("copies").cast("boolean").cast("long")).cast("int").alias("mix_copies")).where("mix_copies > 0")
    own = df["`" + id_col.replace("`", "``") + "`"]
    rows = F.struct(*(df["`" + c.replace("`", "``") + "`"] for c in df.columns))
    return df.join(taken, own.eqNullSafe(taken["mix_id"])).select(
        rows.alias("row"), F.explode(F.sequence(F.lit(1), taken["mix_copies"]))).select("row.*")
