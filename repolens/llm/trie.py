"""Prefix trie of conversations: adaptive radix trees over fixed-width big-endian turn ids.

A turn's id is the first 16 bytes of SHA-256 over its role and text, a conversation's key is the sequence of
its ids. Equal keys collapse first. The distinct keys are range-sorted, so a task holds neighbours: it puts
runs of them into adaptive radix trees (node layouts of 4, 16, 48 and 256 children that grow as needed, compressed
paths) and emits a node at each byte depth where a turn ends, inside a compressed path too; byte depths within
a turn emit nothing. Members, leaves and saved code points of a subtree are sums, taken on the way up.

Only nodes on the path of a run's first or last key can have members in another run. They are few (two paths a
run) and are finished in Spark: grouped by the hash of their path, then what a path adds to its ancestors is
a running sum from its end, and the sums of all paths through a node meet in it.

Texts never travel: a turn is its id and its number of code points. One conversation's ids are one value.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import col, durable

WIDTH = 16
#: Bytes of keys in one tree; bounds a task's memory, never what is counted.
RUN_BYTES = 8 << 20
EMPTY = hashlib.sha256(b"").hexdigest()


def sequences(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv long, steps array of (id hex, chars)): each conversation's turns by turn (null first), ties by id.

    Null role or text counts as empty, repeated rows are repeated turns, rows with a null conversation belong to none.
    """
    role, text = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    # the role's length keeps role and text apart
    name = F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = df.select(col(conv_col).cast("long").alias("conv"), col(turn_col).alias("turn"), F.substring(name, 1, 2 * WIDTH).alias("id"), F.char_length(text).alias("chars"))
    steps = F.sort_array(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "id", "chars")))
    return rows.where("conv IS NOT NULL").groupBy("conv").agg(F.transform(steps, lambda s: F.struct(s["id"].alias("id"), s["chars"].alias("chars"))).alias("steps"))


def rebuilt(talks: DataFrame, span: int = 100, most: int = 6) -> DataFrame:
    """Each conversation c begins with the first h turns of conversation c - c % span, then has its own from turn h on; h = crc32(c) % most."""
    talks = durable(talks)
    heads = talks.where(F.col("conv") % span == 0).select(F.col("conv").alias("head"), F.slice("steps", 1, most - 1).alias("first"))
    h = (F.crc32(F.col("conv").cast("string")) % most).cast("int")
    none = F.slice("steps", 1, F.lit(0))
    return (talks.join(heads, F.col("conv") - F.col("conv") % span == F.col("head"), "left")
            .select("conv", F.concat(F.slice(F.coalesce("first", none), F.lit(1), h), F.slice("steps", h + 1, F.size("steps"))).alias("steps")))


class Node:
    """A radix tree node: ``path`` is the compressed string after its branch byte; it grows through four layouts."""

    __slots__ = ("path", "layout", "bytes", "kids", "end", "n", "conv", "any", "next", "saved", "leaves")

    def __init__(self, path: bytes):
        self.path, self.layout, self.end = path, 4, None
        self.bytes, self.kids = bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            i = self.bytes.find(byte)
            return self.kids[i] if i >= 0 else None
        if self.layout == 48:
            i = self.bytes[byte]
            return self.kids[i - 1] if i else None
        return self.kids[byte]

    def put(self, byte: int, kid: Node) -> None:
        """Set the child of a byte, growing where the layout is full."""
        if self.layout <= 16:
            i = self.bytes.find(byte)
            if i >= 0:
                self.kids[i] = kid
                return
            if len(self.kids) < self.layout:
                i = bisect_left(self.bytes, byte)
                self.bytes.insert(i, byte)
                self.kids.insert(i, kid)
                return
            if self.layout == 4:
                self.layout = 16
            else:
                index = bytearray(256)
                for i, b in enumerate(self.bytes):
                    index[b] = i + 1
                self.layout, self.bytes = 48, index
            self.put(byte, kid)
        elif self.layout == 48:
            i = self.bytes[byte]
            if i:
                self.kids[i - 1] = kid
            elif len(self.kids) < 48:
                self.kids.append(kid)
                self.bytes[byte] = len(self.kids)
            else:
                wide = [self.kids[i - 1] if i else None for i in self.bytes]
                self.layout, self.bytes, self.kids = 256, bytearray(), wide
                wide[byte] = kid
        else:
            self.kids[byte] = kid

    def ordered(self) -> list[Node]:
        """Children in byte order."""
        if self.layout <= 16:
            return self.kids
        if self.layout == 48:
            return [self.kids[i - 1] for i in self.bytes if i]
        return [k for k in self.kids if k is not None]


def insert(root: Node, key: bytes, value: int) -> None:
    """Put ``value`` at ``key``; ``root`` has no path, so it stays the root."""
    node, at = root, 0
    while at < len(key):
        kid = node.child(key[at])
        if kid is None:
            kid = Node(key[at + 1:])
            kid.end = value
            node.put(key[at], kid)
            return
        path, start = kid.path, at + 1
        if key.startswith(path, start):
            node, at = kid, start + len(path)
            continue
        same = 0
        while start + same < len(key) and path[same] == key[start + same]:
            same += 1
        fork = Node(path[:same])
        fork.put(path[same], kid)
        kid.path = path[same + 1:]
        node.put(key[at], fork)
        node, at = fork, start + same
    node.end = value


CLOSED = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("depth", T.LongType()), T.StructField("parent_conv_id", T.LongType()),
                       T.StructField("n_convs", T.LongType()), T.StructField("n_children", T.LongType()), T.StructField("n_leaves", T.LongType()),
                       T.StructField("saved_tokens", T.LongType()), T.StructField("ends_sha256", T.StringType()),
                       # of nodes on a run's first or last path, and of their children
                       T.StructField("node", T.BinaryType()), T.StructField("parent", T.BinaryType()), T.StructField("path", T.BinaryType()),
                       T.StructField("chars", T.LongType())])


def path_nodes(key: bytes) -> list[bytes]:
    """The hash of each prefix of whole turns, the empty one first."""
    h, out = hashlib.sha256(), []
    out.append(h.digest()[:16])
    for at in range(0, len(key), WIDTH):
        h.update(key[at:at + WIDTH])
        out.append(h.copy().digest()[:16])
    return out


def tree_rows(keys: list[bytes], chars: list[list[int]], counts: list[int], convs: list[int], ends: list[str]):
    """The trie nodes of sorted distinct keys, as rows of ``CLOSED``.

    Nodes on the first and the last key's path have partial values: own members, and what their closed
    subtrees add; a node on both paths has them in the first one's row.
    """
    root = Node(b"")
    for i, key in enumerate(keys):
        insert(root, key, i)
    # up: members and sums, children before parents
    order, stack = [], [(root, 0, 0, True, True)]  # node, bytes above it, bytes to its end, on the first key's path, on the last's
    while stack:
        node, above, depth, first, last = item = stack.pop()
        order.append(item)
        kids = node.ordered()
        for j, kid in enumerate(kids):
            stack.append((kid, depth, depth + 1 + len(kid.path), first and j == 0 and node.end is None, last and j == len(kids) - 1))
    paths = [path_nodes(keys[0]), path_nodes(keys[-1])]
    rows = []
    for node, above, depth, first, last in reversed(order):
        kids = node.ordered()
        own = node.end is not None
        node.n = sum(k.n for k in kids) + (counts[node.end] if own else 0)
        node.conv = min([k.conv for k in kids] + ([convs[node.end]] if own else []))
        node.any = node.end if own else kids[0].any
        # next: trie nodes met first from here down, and their subtrees' sums; a path's node counts as none, Spark adds it
        node.next, node.saved, node.leaves = (sum(getattr(k, f) for k in kids) for f in ("next", "saved", "leaves"))
        if node is root or depth // WIDTH > above // WIDTH:
            top = chars[node.any]
            low = 0 if node is root else above // WIDTH + 1
            for d in range(depth // WIDTH, low - 1, -1):
                n_children, closed_leaves = node.next, node.leaves
                if not (first or last):
                    node.saved += (node.n - 1) * top[d - 1] if d else 0
                    node.leaves = closed_leaves if n_children else 1
                here = ends[node.end] if own and d * WIDTH == depth else None
                rows.append((node, d, n_children, node.leaves, node.saved, here, first, last, top[d - 1] if d else 0))
                node.next = 0 if first or last else 1  # a path's node: Spark counts it once
    # down: who is whose parent
    parent = {}
    stack = [(root, None)]
    spine = {id(node): (first, last) for node, _, _, first, last in order if first or last}
    emits = {id(node) for node, above, depth, *_ in order if node is root or depth // WIDTH > above // WIDTH}
    while stack:
        node, up = stack.pop()
        parent[id(node)] = up
        mine = node if id(node) in emits else up
        stack.extend((kid, mine) for kid in node.ordered())
    lows = {id(node): (0 if node is root else above // WIDTH + 1) for node, above, *_ in order}
    for node, d, n_children, leaves, saved, here, first, last, size in rows:
        above = node if d > lows[id(node)] else parent[id(node)]
        if first or last:
            which = 0 if first else 1
            yield (node.conv, d, None, node.n, n_children, leaves, saved, here,
                   paths[which][d], paths[which][d - 1] if d else None, paths[which][-1], size)
            if first and last and paths[0][-1] != paths[1][-1]:  # the last path's share: nothing of its own here
                yield node.conv, d, None, 0, 0, 0, 0, None, paths[1][d], paths[1][d - 1] if d else None, paths[1][-1], size
        else:
            side = spine.get(id(above))
            open_parent = paths[0 if side[0] else 1][d - 1] if side else None
            yield node.conv, d, None if side else above.conv, node.n, n_children, leaves, saved, here or EMPTY, None, open_parent, None, None


def batches_of(rows, size: int = 1 << 14):
    out = []

    def made():
        columns = zip(*out) if out else [()] * len(CLOSED)
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array(list(c), types[f.dataType.typeName()]) for c, f in zip(columns, CLOSED)], names=CLOSED.names)

    for row in rows:
        out.append(row)
        if len(out) >= size:
            yield made()
            out = []
    yield made()


def end_digests(convs: DataFrame) -> DataFrame:
    """(seq, ends): SHA-256 of the decimal ids, ascending, comma-joined, of each ``seq`` in (seq binary, conv).

    Ids are range-sorted, so a sequence of very many copies is joined to strings in many tasks; the digest
    itself has to read them in order, and streams them.
    """
    def join(batches):
        for b in batches:
            seqs, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            out, at = [], 0
            for i in range(1, len(seqs) + 1):
                if i == len(seqs) or seqs[i] != seqs[at]:
                    out.append((seqs[at], ids[at], ",".join(map(str, ids[at:i]))))
                    at = i
            yield pa.RecordBatch.from_pylist([dict(zip(("seq", "low", "ids"), r)) for r in out],
                                             pa.schema([("seq", pa.binary()), ("low", pa.int64()), ("ids", pa.string())]))

    def digest(batches):
        schema = pa.schema([("seq", pa.binary()), ("ends", pa.string())])
        now, h = None, None
        for b in batches:
            out = []
            for seq, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if seq != now:
                    if now is not None:
                        out.append({"seq": now, "ends": h.hexdigest()})
                    now, h = seq, hashlib.sha256(ids.encode())
                else:
                    h.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist(out, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([{"seq": now, "ends": h.hexdigest()}], schema)

    pieces = convs.repartitionByRange("seq", "conv").sortWithinPartitions("seq", "conv").mapInArrow(join, "seq binary, low long, ids string")
    return pieces.repartition("seq").sortWithinPartitions("seq", "low").mapInArrow(digest, "seq binary, ends string")


def prefix_trie(talks: DataFrame, run_bytes: int = RUN_BYTES) -> DataFrame:
    """The trie of (conv long, steps): one row per distinct prefix, with members, children, leaves and saved code points.

    (conv_id, depth) names a node: the smallest member and the number of turns. A conversation without turns is
    a member of the root alone. No conversation: no row, not even the root.
    """
    made = talks.select("conv", F.unhex(F.array_join(F.transform("steps", lambda s: s["id"]), "")).alias("key"), F.transform("steps", lambda s: s["chars"].cast("long")).alias("chars"))
    made = durable(made.withColumn("seq", F.substring(F.unhex(F.sha2("key", 256)), 1, 16)))
    alone = made.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv").alias("conv"))
    alone = alone.join(end_digests(made.select("seq", "conv")), "seq")
    own = made.select("conv", "key", "chars")
    distinct = alone.join(own, "conv").select("key", "chars", "n", "conv", "ends")
    distinct = distinct.repartitionByRange("key").sortWithinPartitions("key")

    def grow(batches):
        def rows():
            run, held = [[] for _ in range(5)], 0
            for b in batches:
                for one in zip(*(c.to_pylist() for c in b.columns)):
                    for part, value in zip(run, one):
                        part.append(value)
                    held += len(one[0])
                    if held >= run_bytes:
                        yield from tree_rows(*run)
                        run, held = [[] for _ in range(5)], 0
            if run[0]:
                yield from tree_rows(*run)
        yield from batches_of(rows())

    return finished(durable(distinct.mapInArrow(grow, CLOSED)))


def finished(rows: DataFrame) -> DataFrame:
    """The rows of all runs with the nodes on their outer paths merged."""
    spine = rows.where("node IS NOT NULL")
    nodes = spine.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("closed"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("ends_sha256").alias("ends_sha256"), F.max("chars").alias("chars"), F.min("path").alias("path"))
    nodes = durable(nodes)
    kids = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("up")).agg(F.count("*").alias("more"))
    nodes = durable(nodes.join(kids, F.col("node") == F.col("up"), "left").withColumn("n_children", F.col("closed") + F.coalesce("more", F.lit(0))).drop("up", "more", "closed"))
    # what the merged nodes themselves add: each on one path, summed from the path's end up
    value = nodes.select("node", F.col("path").alias("own"), ((F.col("n_convs") - 1) * F.col("chars")).alias("v"), (F.col("n_children") == 0).cast("long").alias("leaf"))
    below = Window.partitionBy("path").orderBy(F.col("depth").desc())
    here = F.col("path") == F.col("own")
    sums = (spine.select("node", "path", "depth").join(value, "node")
            .select("node", F.sum(F.when(here, F.col("v")).otherwise(0)).over(below).alias("v"), F.sum(F.when(here, F.col("leaf")).otherwise(0)).over(below).alias("leaf"))
            .groupBy("node").agg(F.sum("v").alias("v"), F.sum("leaf").alias("leaf")))
    done = nodes.join(sums, "node").select(
        "conv_id", "depth", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children", (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("v")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"), "parent")
    every = rows.where("node IS NULL").select(done.columns).unionByName(done)
    ups = nodes.select(F.col("node").alias("up"), F.col("conv_id").alias("up_conv"))
    return every.join(ups, F.col("parent") == F.col("up"), "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "up_conv").alias("parent_conv_id"), *done.columns[3:8])
