"""SimHash near-dedup by segment-popcount embedding.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. The Manhattan distance of
two such vectors never exceeds the number of differing bits, so it is a lower bound that may be tested
first. The vector is split into groups of segments, d // 3 + 1 by default: two fingerprints within d bits
lie within distance 2 in at least one group (pigeonhole). Each group is a grid; a fingerprint stands in its
own cell and those one step away, so two within distance 2 always meet in a cell. In a cell the
whole vectors are compared, then the bits. Only a spanning forest of a task's links leaves the task.

For 4 bits these are two grids of 3^16 cells and about 50 cells a fingerprint. Of N unrelated fingerprints
each then meets about N / 6,500 others. One group of all 32 segments (``groups=1``, cells up to two steps
away) has about 1,180 cells a fingerprint, each of which meets about N / 48,000,000 others: the better grid
beyond some 10^7 unrelated fingerprints. Links are the same with any number of groups.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import connected_components, durable, keyed_text, one_per_group, texts_of, union_forest

SEED = 42
ODD = np.uint64(0x5555555555555555)
SEGMENTS = 32
#: Rows of a cell that one task compares; a larger cell is dealt out as pairs of blocks.
CELL_ROWS = 40_000
#: Cells up to this size are compared pair by pair in one vectorised step.
SMALL_CELL = 512
PAIRS = 1 << 20
#: Fingerprints placed in their cells at once; bounds memory only.
PLACED = 1024
# byte -> its eight bits in the eight bytes of a word, lowest bit in the lowest byte
LANES = ((np.arange(256, dtype=np.uint64)[:, None] >> np.arange(8, dtype=np.uint64) & np.uint64(1)) << np.arange(0, 64, 8, dtype=np.uint64)).sum(1, dtype=np.uint64)


def shingle_digests(text: bytes, k: int) -> list[bytes]:
    """XXH64 of each k-word shingle of the lower-cased (A-Z) text, big-endian."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return []
    joined = b" ".join(words)
    if n <= k:
        return [xxhash.xxh64_digest(joined, SEED)]
    size = np.fromiter(map(len, words), np.int64, n)
    end = np.cumsum(size + 1) - 1
    digest = xxhash.xxh64_digest
    return [digest(joined[a:b], SEED) for a, b in zip((end - size)[:n - k + 1].tolist(), end[k - 1:].tolist())]


def majority(digests: bytes, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each text from its shingles' digests; ``counts`` says how many each text has."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if not len(full):
        return out
    n = counts[full]
    begin = np.cumsum(n) - n
    # sums of eight counters of eight bits hold 255 votes: cut each text's shingles into such blocks
    blocks = -(-n // 255)
    first = np.cumsum(blocks) - blocks
    which = np.repeat(np.arange(len(n)), blocks)
    at = begin[which] + 255 * (np.arange(len(which)) - first[which])
    lanes = LANES[np.frombuffer(digests, np.uint8).reshape(-1, 8).T]
    votes = np.add.reduceat(lanes, at, axis=1).view(np.uint8).reshape(8, -1, 8).astype(np.int64)
    votes = np.add.reduceat(votes, first, axis=1)
    shift = (56 - 8 * np.arange(8))[:, None, None] + np.arange(8)
    out[full] = ((2 * votes > n[:, None]).astype(np.uint64) << shift.astype(np.uint64)).sum((0, 2), dtype=np.uint64)
    return out


def fingerprints_of(texts: list[bytes], shingle: int) -> np.ndarray:
    """The fingerprints of a run of texts, as signed longs."""
    digests = [shingle_digests(t, shingle) for t in texts]
    counts = np.fromiter(map(len, digests), np.int64, len(digests))
    return majority(b"".join(x for d in digests for x in d), counts).view(np.int64)


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id, fp): the 64-bit fingerprint of each whole text as a signed long; no words give 0."""
    src = keyed_text(df, id_col, text_col)
    schema = T.StructType([src.schema["id"], T.StructField("fp", T.LongType())])

    def run(batches):
        for b in batches:
            found = [fingerprints_of(texts, shingle) for _, texts in texts_of(b.column(1))]
            fp = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=schema.names)

    return src.mapInArrow(run, schema)


def embed(fp: np.ndarray) -> np.ndarray:
    """The bit counts (0 to 2) of the 32 two-bit segments, two bits each in one word."""
    return (fp & ODD) + (fp >> np.uint64(1) & ODD)


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance of two embeddings: their segments differ by 0, 1 (01/00, 10/01) or 2 (10/00)."""
    x = a ^ b
    low, high = x & ODD, x >> np.uint64(1) & ODD
    # 10^00 = 10: two; 01^00 = 01: one; 10^01 = 11: one
    return np.bitwise_count(low) + 2 * np.bitwise_count(high & ~low)


def linked(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Indexes of the pairs within ``most`` bits: by the lower bound, then exactly."""
    near = np.flatnonzero(manhattan(embed(a), embed(b)) <= most)
    return near[np.bitwise_count(a[near] ^ b[near]) <= most]


def grid_groups(most: int, groups: int | None = None) -> list[tuple[int, int]]:
    """(first segment, segments) of each group; by default so many that one of them is within distance 2."""
    n = min(groups or most // 3 + 1, SEGMENTS)
    cut = [SEGMENTS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def ball(own: np.ndarray, width: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, index into ``own``) of the cells each vector stands in, so that any two within distance ``reach`` share one.

    Those are all cells within half the distance, rounded up; one step is only taken upwards if ``reach`` is 1.
    """
    radius = (reach + 1) // 2
    # by steps left to take; later segments only, so no cell comes twice
    at = [[] for _ in range(radius)] + [[(own, np.arange(len(own)))]]
    for s in range(width):
        for left in range(1, radius + 1):
            for cell, who in list(at[left]):
                v = cell >> np.uint64(2 * s) & np.uint64(3)
                for step in range(1, min(left, 2) + 1):
                    move = np.uint64(step << 2 * s)
                    up, down = v + np.uint64(step) <= 2, v >= step
                    at[left - step].append((cell[up] + move, who[up]))
                    if reach > 1:
                        at[left - step].append((cell[down] - move, who[down]))
            at[left] = [tuple(map(np.concatenate, zip(*at[left])))] if len(at[left]) > 1 else at[left]
    cell, who = zip(*(x for level in at for x in level))
    return np.concatenate(cell), np.concatenate(who)


def cells(fps: DataFrame, most: int, groups: int | None = None) -> DataFrame:
    """(grp, cell, fp): each fingerprint in the cells of every grid that are near enough for its links to meet it."""
    grids = grid_groups(most, groups)
    reach = most // len(grids)

    def run(batches):
        for b in batches:
            every = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(every), PLACED):
                fp = every[at:at + PLACED]
                e = embed(fp)
                for g, (first, width) in enumerate(grids):
                    cell, who = ball(e >> np.uint64(2 * first) & np.uint64((1 << 2 * width) - 1), width, reach)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cell), g, np.int32)), pa.array(cell.view(np.int64)), pa.array(fp[who].view(np.int64))], names=["grp", "cell", "fp"])

    return fps.select("fp").mapInArrow(run, "grp int, cell long, fp long")


def small_cells(fp: np.ndarray, begin: np.ndarray, size: np.ndarray, most: int):
    """Linked pairs of the cells [begin, begin + size), all pairs of a cell tested, some PAIRS at a time."""
    row = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    left = np.repeat(begin + size, size) - row - 1
    done = 0
    total = np.cumsum(left)
    while done < len(row):
        upto = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + PAIRS, "right")))
        n = left[done:upto]
        a = np.repeat(row[done:upto], n)
        b = a + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        hit = linked(fp[a], fp[b], most)
        yield fp[a[hit]], fp[b[hit]]
        done = upto


def large_cell(fp: np.ndarray, most: int):
    """Links that connect what a cell connects: each taken fingerprint is compared with those not yet reached."""
    rest = fp
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            x = todo.pop()
            hit = linked(rest, np.broadcast_to(x, rest.shape), most)
            if len(hit):
                found = rest[hit]
                yield np.broadcast_to(x, found.shape), found
                todo.extend(found)
                rest = np.delete(rest, hit)


def cell_links(fps: DataFrame, most: int, groups: int | None = None) -> DataFrame:
    """(a, b): links whose closure is that of all pairs of distinct fingerprints within ``most`` bits."""
    placed = cells(fps, most, groups)
    # cells over CELL_ROWS rows: their blocks meet pairwise, in tasks of their own
    big = durable(placed.groupBy("grp", "cell").count().where(F.col("count") > CELL_ROWS)
                  .select("grp", "cell", F.ceil(F.col("count") / (CELL_ROWS // 2)).cast("int").alias("blocks")))
    if big.isEmpty():
        rows = placed.select("grp", "cell", F.lit(0).alias("i"), F.lit(0).alias("j"), "fp")
    else:
        # at most 1 in CELL_ROWS of the placed rows' cells; left to the planner
        rows = placed.join(big, ["grp", "cell"], "left")
        block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        meet = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(block, o).alias("i"), F.greatest(block, o).alias("j")))
        none = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
        rows = rows.select("grp", "cell", "fp", F.explode(F.when(F.col("blocks").isNull(), none).otherwise(meet)).alias("x")).select("grp", "cell", "x.i", "x.j", "fp")
    key = ["grp", "cell", "i", "j"]

    def run(batches):
        forest: dict[int, int] = {}

        def take(cols):
            fp = cols[4].view(np.uint64)
            new = np.ones(len(fp), bool)
            new[1:] = np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(fp)))
            small = (size > 1) & (size <= SMALL_CELL)
            for a, b in small_cells(fp, begin[small], size[small], most):
                union_forest(a.view(np.int64).tolist(), b.view(np.int64).tolist(), forest)
            for at, n in zip(begin[size > SMALL_CELL].tolist(), size[size > SMALL_CELL].tolist()):
                for a, b in large_cell(fp[at:at + n], most):
                    union_forest(a.view(np.int64).tolist() if a.flags.c_contiguous else np.ascontiguousarray(a).view(np.int64).tolist(), b.view(np.int64).tolist(), forest)

        held: list[list[np.ndarray]] = []
        for b in batches:
            cols = [c.to_numpy() for c in b.columns]
            if not len(cols[0]):
                continue
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
            cut = int(new[-1]) if len(new) else 0
            same = held and all(held[0][k][-1] == cols[k][0] for k in range(4))
            if cut or (held and not same):
                if held and not same:
                    take([np.concatenate(x) for x in zip(*held)])
                    held = []
                if cut:
                    take([np.concatenate(x) for x in zip(*held, [c[:cut] for c in cols])])
                    held = []
            held.append([c[cut:].copy() for c in cols])
        if held:
            take([np.concatenate(x) for x in zip(*held)])
        links = [(x, up) for x, up in forest.items() if x != up]
        if links:
            a, b = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "a long, b long")


def near_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, most: int = 4, groups: int | None = None) -> DataFrame:
    """(id, fp, component_id): one row per input row; texts link when their fingerprints differ in ``most`` bits or fewer.

    component_id is the smallest id that links lead to, the row's own included; null ids don't count
    (null if there is no other). Texts without words share fingerprint 0, which links like any other.
    Equal fingerprints are one node, so copies in any number cost one row; repeated rows are alike.
    """
    return components(df, id_col, text_col, shingle, most, groups).select("id", "fp", "component_id")


def components(df: DataFrame, id_col: str, text_col: str, shingle: int, most: int, groups: int | None = None) -> DataFrame:
    """(id, fp, component_id, root_fp): ``near_groups`` with a fingerprint that names the component, null ids or not."""
    known = durable(fingerprints(df, id_col, text_col, shingle))
    nodes = durable(known.groupBy("fp").agg(F.min("id").alias("low")))
    # nodes that carry their smallest id order by it, so a component's root names the component
    node = F.struct(F.col("low").isNull().alias("none"), F.col("low").alias("low"), F.col("fp").alias("fp"))
    carried = nodes.select(F.col("fp").alias("f"), node.alias("node"))
    edges = cell_links(nodes, most, groups)
    for end in ("a", "b"):
        edges = edges.join(carried, edges[end] == carried["f"]).withColumn(end, F.col("node")).drop("f", "node")
    roots = connected_components(edges)
    r = roots.select(F.col("node.fp").alias("f"), F.col("root.low").alias("root_low"), F.col("root.fp").alias("root_of"))
    # a hot fingerprint's rows meet one row of ``label``. Adaptive execution splits them only if both sides of
    # the join are dealt anew; ``of`` is an expression, so the dealing by fp so far isn't taken over
    label = nodes.join(r, nodes["fp"] == r["f"], "left").select(
        F.col("fp").bitwiseXOR(F.lit(0).cast("long")).alias("of"),
        F.when(F.col("f").isNotNull(), F.col("root_low")).otherwise(F.col("low")).alias("component_id"),
        F.coalesce("root_of", "fp").alias("root_fp"))
    return known.join(label, known["fp"] == label["of"]).select("id", "fp", "component_id", "root_fp")


def fp_hex(c: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(c)), 16, "0"))


def near_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, most: int = 4) -> DataFrame:
    """One row of ``df`` for each component, with its own columns: that of the smallest id, a null id if there is no other."""
    def tags(texts):
        return pa.array(fingerprints_of(texts, shingle))

    groups = components(df, id_col, text_col, shingle, most).select(
        "id", F.col("fp").alias("tag"), F.col("root_fp").alias("grp"), F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
    return one_per_group(df, text_col, id_col, tags, groups)
