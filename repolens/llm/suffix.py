"""Removal of repeated strings by sparse suffix arrays with deep-shallow sorting.

Every byte covered by a LENGTH-byte string that also starts earlier in the corpus goes. Two equal strings
hold the same anchor at the same place: the GRAM bytes of smallest hash in them, the leftmost of equals.
Anchors are 1 in about 39 positions, and each position belongs, as the start of a string, to one anchor.

1. Each anchor is a row (hash of the gram, hash of the bytes that its strings cover). Occurrences that agree
   in both have all their strings in common: within a map task, then within the gram's task, all but the
   earliest are marked. Grams that occur once are dropped; most do.
2. Where a gram comes in several surroundings, only their earliest occurrences go on. Their bytes are
   fetched and the strings at the same place of the gram are sorted: multikey quicksort by words of eight
   bytes to a shallow depth, then blind tries for groups that share a longer prefix. Equal strings are
   neighbours; all but the earliest are marked.
3. A document's marks are merged and its other bytes kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import durable, keyed_text, slices, steps

LENGTH, GRAM = 100, 24
#: Grams in a string; also the most strings that one anchor can stand for.
GRAMS = LENGTH - GRAM + 1
#: Bytes sorted by words before tries take over.
SHALLOW = 32
#: String starts of a document handled at a time; blocks overlap, none is left out.
BLOCK = 1 << 22
#: Bytes of surroundings sorted at a time; the surroundings of one gram stay together.
SORT_BYTES = 2 << 20
PLACE_BITS = 23
_M, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BYTE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ (np.arange(256, dtype=np.uint64) << np.uint64(29))
KEEP, GONE, APART = 0, 1, 2
#: A gram in more surroundings than this has its strings dealt out one by one, by their content.
MOST_TOGETHER = 4096
#: Grams this frequent in one of SAMPLE documents, and in at least one of FEW of its anchors, are dealt out by their
#: surroundings. The sample decides how work is dealt out, never a result; FEW bounds how many such grams there are.
SAMPLE, HOT_IN_SAMPLE, FEW = 64, 64, 100_000
#: Strings that a task remembers to drop repeats early; bounds memory, never what is compared.
MOST_SEEN = 200_000


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from each position on, by doubling widths."""
    h, m, width = _BYTE[data], _M, 1
    widths = {1: (h, m)}
    while 2 * width <= GRAM:
        h, m, width = h[:-width] * m + h[width:], m * m, 2 * width
        widths[width] = h, m
    at = width
    while at < GRAM:
        width = max(w for w in widths if w <= GRAM - at)
        more, power = widths[width]
        n = len(data) - at - width + 1
        h = h[:n] * power + more[at:at + n]
        at += width
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    have, low = 1, keys
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    return np.minimum(low[:len(keys) - width + 1], low[width - have:]) if have < width else low


def anchors(data: np.ndarray, at: np.ndarray):
    """(document, anchor's place, strings' first start, strings, gram hash, surroundings' hash) of a run of texts.

    Places are relative to the document. ``data`` holds at most BLOCK string starts, or one long document.
    """
    raw = data.tobytes()
    for begin in range(0, max(1, len(data) - LENGTH + 1), BLOCK):
        part = data[begin:begin + BLOCK + LENGTH - 1]
        if len(part) < LENGTH:
            continue
        gram = gram_hashes(part)
        low = sliding_min((gram >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(gram), dtype=np.uint64), GRAMS)
        place = (low & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        # string starts: all but the last LENGTH - 1 bytes of each document
        inside = np.zeros(len(data) + 1, np.int8)
        full = np.diff(at) >= LENGTH
        np.add.at(inside, at[:-1][full], 1)
        np.add.at(inside, at[1:][full] - LENGTH + 1, -1)
        start = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8)[begin:begin + len(place)])
        if not len(start):
            continue
        p = place[start]
        new = np.ones(len(p), bool)
        new[1:] = p[1:] != p[:-1]
        first = np.flatnonzero(new)
        i0, n, p = start[first] + begin, np.diff(np.append(first, len(p))), p[first]
        doc = np.searchsorted(at, i0, "right") - 1
        around = np.fromiter((xxhash.xxh3_64_intdigest(raw[a:b]) for a, b in zip(i0.tolist(), (i0 + n + LENGTH - 1).tolist())), np.uint64, len(i0))
        left = p + begin - i0
        yield doc, i0 + left - at[doc], left, n, gram[p], around * _M + left.astype(np.uint64)


def packed(place, left, n, kind):
    return place << 18 | left << 10 | n << 2 | kind


def unpacked(code: np.ndarray):
    """(first string start, end of the last string, anchor's place, strings, kind)."""
    place, left, n = code >> 18, code >> 10 & 255, code >> 2 & 255
    return place - left, place - left + n + LENGTH - 1, place, n, code & 3


def repeats_marked(h: np.ndarray, c: np.ndarray, doc: np.ndarray, code: np.ndarray):
    """Sorted columns, and where a new surrounding (h, c) and a new gram h begin: the first of each is the earliest."""
    order = np.lexsort((code, doc, c, h))
    h, c, doc, code = h[order], c[order], doc[order], code[order]
    new_h = np.ones(len(h), bool)
    new_h[1:] = h[1:] != h[:-1]
    new_c = new_h.copy()
    new_c[1:] |= c[1:] != c[:-1]
    return h, c, doc, code, new_h, new_c


def anchor_rows(src: DataFrame) -> DataFrame:
    """(h, c, id, code): anchors that are the earliest of their surroundings in a batch; the others as GONE spans."""
    names = ["h", "c", "id", "code"]

    def run(batches):
        with np.errstate(over="ignore"):
            for b in batches:
                ids = b.column(0).to_numpy(zero_copy_only=False)
                found = []
                for first, _, data, at in steps(b.column(1)):
                    for doc, place, left, n, h, c in anchors(data, at):
                        found.append((h, c, ids[doc + first].astype(np.int64), packed(place, left, n, KEEP)))
                if not found:
                    continue
                h, c, doc, code, _, new_c = repeats_marked(*(np.concatenate(x) for x in zip(*found)))
                h[~new_c] = doc[~new_c].view(np.uint64) * _M  # spread; their gram no longer matters
                code[~new_c] |= GONE
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(c.view(np.int64)), pa.array(doc), pa.array(code)], names=names)

    return src.mapInArrow(run, "h long, c long, id long, code long")


def hot_grams(docs: DataFrame) -> DataFrame:
    """(h): at most FEW hashes of grams that occur in very many documents."""
    some = docs if SAMPLE == 1 else docs.where(F.pmod(F.xxhash64("id"), F.lit(SAMPLE)) == 0)
    counts = durable(anchor_rows(some).where(F.col("code").bitwiseAND(3) == KEEP).groupBy("h").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return durable(counts.where(F.col("n") >= max(HOT_IN_SAMPLE, total // FEW)).select("h"))


def dealt_anchors(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """The rows with a flag ``hot``: a gram's rows in one task, those of a hot gram in one task for each surrounding."""
    if hot.isEmpty():
        return rows.withColumn("hot", F.lit(False)).repartition("h")
    known = F.broadcast(hot.select(F.col("h").alias("hot_h")))  # at most FEW longs
    flagged = rows.join(known, F.col("h") == F.col("hot_h"), "left").withColumn("hot", F.col("hot_h").isNotNull()).drop("hot_h")
    return flagged.repartition(F.when(F.col("hot"), F.xxhash64("h", "c")).otherwise(F.col("h")))


def gram_marks(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """(id, code): GONE spans, and as KEEP or APART the anchors whose strings have to be sorted."""
    def run(batches):
        held = [[c.to_numpy(zero_copy_only=False) for c in b.columns] for b in batches if b.num_rows]
        if not held:
            return
        h, c, doc, code, is_hot = (np.concatenate(x) for x in zip(*held))
        del held
        gone = (code & 3) == GONE
        none = np.zeros(0, np.int64)
        out = [(doc[gone], code[gone], np.zeros(int(gone.sum()), np.int64), np.ones(int(gone.sum()), bool))]
        for part in (~gone & ~is_hot, ~gone & is_hot):
            if not part.any():
                continue
            waits = bool(is_hot[part][0])
            x = repeats_marked(*(v[part] for v in (h, c, doc, code)))
            new_h, new_c = x[4:]
            if waits:
                go, kind = new_c, np.zeros(len(new_c), np.int64)  # how many surroundings there are is not known here
            else:
                gram = np.cumsum(new_h) - 1
                kinds = np.bincount(gram[new_c])[gram]
                go, kind = new_c & (kinds > 1), np.where(kinds > MOST_TOGETHER, APART, KEEP)
            gone_code = x[3][~new_c] & ~3 | GONE
            out.append((x[2][~new_c], gone_code, np.zeros(len(gone_code), np.int64), np.ones(len(gone_code), bool)))
            out.append((x[2][go], (x[3] | kind)[go], x[0][go], np.full(int(go.sum()), not waits)))
        doc, code, h, known = (np.concatenate(x) for x in zip(*out, (none, none, none, none.astype(bool))))
        for at in range(0, len(doc), 1 << 16):
            cut = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_arrays([pa.array(doc[cut]), pa.array(code[cut]), pa.array(h[cut], mask=known[cut])], names=["id", "code", "h"])

    marks = dealt_anchors(rows, hot).mapInArrow(run, "id long, code long, h long")
    if hot.isEmpty():
        return marks.select("id", "code")
    marks = durable(marks)
    waiting = marks.where(F.col("h").isNotNull())  # the earliest row of each surrounding of a hot gram
    kinds = waiting.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    code = F.when(F.col("kinds") > MOST_TOGETHER, F.col("code").bitwiseOR(F.lit(APART))).otherwise(F.col("code"))
    return marks.where(F.col("h").isNull()).select("id", "code").unionByName(waiting.join(F.broadcast(kinds), "h").select("id", code.alias("code")))


def surroundings(rows: DataFrame) -> DataFrame:
    """(h, id, start, left, text): the bytes of the anchors to be sorted; rows are (id, text, codes).

    The strings of an APART anchor are rows of their own, with a hash of the string as h: a passage that
    very many documents share then meets in as many tasks as it has strings, about once per task. A
    repeat of an earlier document's string is known to be one at once: left is minus the bytes gone, and text is empty.
    """
    names = ["h", "id", "start", "left", "text"]

    def apart(doc: int, text: bytes, begin: int, place: int, n: int, seen: dict[bytes, int], out: list) -> None:
        run = 0
        for k in range(begin, begin + n + 1):
            s = text[k:k + LENGTH] if k < begin + n else b""
            if s and seen.get(s, doc + 1) <= doc:
                run += 1
                continue
            if run:
                out.append(((doc * 31 + k + (1 << 63)) % (1 << 64) - (1 << 63), doc, k - run, -(run + LENGTH - 1), b""))
                run = 0
            if s:
                seen[s] = doc
                out.append((xxhash.xxh3_64_intdigest(s) - (1 << 63), doc, k, place - k, s))

    def run(batches):
        seen: dict[bytes, int] = {}  # string -> the smallest document of this task that has it
        with np.errstate(over="ignore"):
            for b in slices(batches, 1):
                out: list[tuple] = []
                if len(seen) > MOST_SEEN:
                    seen.clear()
                held = b.column(2).to_pylist()
                for i in np.argsort(b.column(0).to_numpy()).tolist():  # the earlier of two documents comes first
                    code = np.array(held[i] or (), np.int64)
                    code = code[(code & 3) != GONE]
                    if not len(code):
                        continue
                    doc, text = b.column(0)[i].as_py(), b.column(1)[i].as_py().encode("utf-8")
                    begin, end, place, n, kind = unpacked(code)
                    grams = np.frombuffer(b"".join(text[p:p + GRAM] for p in place.tolist()), np.uint8)
                    h = gram_hashes(grams)[::GRAM].view(np.int64)
                    order = np.argsort(begin)  # the earlier of two strings of a document comes first
                    for k in order.tolist():
                        if kind[k] == APART:
                            apart(doc, text, int(begin[k]), int(place[k]), int(n[k]), seen, out)
                        else:
                            out.append((int(h[k]), doc, int(begin[k]), int(place[k] - begin[k]), text[begin[k]:end[k]]))
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.binary())], names=names)

    return rows.mapInArrow(run, "h long, id long, start long, left long, text binary")


class BlindTrie:
    """Strings of one length by their branching bytes alone; equal strings share a leaf.

    A node is [depth, {byte: child}], a leaf a list of numbers. Insertion walks down without looking at
    skipped bytes, compares once with the leaf it ends in, and branches where the two differ.
    """

    def __init__(self, strings: list[bytes]):
        self.strings, self.root = strings, [0]
        for i in range(1, len(strings)):
            self.insert(i)

    @staticmethod
    def branches(node: list) -> bool:
        return len(node) == 2 and type(node[1]) is dict

    def insert(self, i: int) -> None:
        s, node = self.strings[i], self.root
        while self.branches(node):
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        if s == other:
            node.append(i)
            return
        differ = int.from_bytes(s) ^ int.from_bytes(other)
        depth = len(s) - (differ.bit_length() + 7) // 8
        above, edge, node = None, None, self.root
        while self.branches(node) and node[0] < depth:
            above, edge, node = node, s[node[0]], node[1][s[node[0]]]
        if self.branches(node) and node[0] == depth:
            node[1][s[depth]] = [i]
            return
        branch = [depth, {other[depth]: node, s[depth]: [i]}]
        if above is None:
            self.root = branch
        else:
            above[1][edge] = branch

    def leaves(self) -> list[list[int]]:
        """Numbers of equal strings, in the order of the strings."""
        out, todo = [], [self.root]
        while todo:
            node = todo.pop()
            if self.branches(node):
                todo += [node[1][k] for k in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def word_at(data: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes from ``depth`` on of each string, as a number that compares like them."""
    return np.lib.stride_tricks.sliding_window_view(data, 8)[start + depth].copy().view(">u8").ravel().astype(np.uint64)


def deep_shallow_sort(data: np.ndarray, start: np.ndarray, group: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW):
    """(order, same): the strings data[start:start + length] sorted within their groups, and whether each equals the one before.

    Multikey quicksort takes eight bytes at a time: what is still tied is sorted by the next word, and
    strings alone in their group leave. Groups tied at the shallow depth are sorted by blind tries; for
    two strings the trie is their first difference. Order in a set of equal strings is that of the input.
    """
    n = len(start)
    order = np.argsort(group, kind="stable")
    rank = group[order]  # rises with the final order; equal where still tied
    tied = np.zeros(n, bool)

    def again(rank):
        t = np.zeros(n, bool)
        eq = rank[1:] == rank[:-1]
        t[1:] |= eq
        t[:-1] |= eq
        return t

    fresh = np.ones(n, bool)
    fresh[1:] = rank[1:] != rank[:-1]
    rank = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    depth = 0
    tied = again(rank)
    while depth < min(shallow, length - 7) and tied.any():
        at = np.flatnonzero(tied)
        word, r = word_at(data, start[order[at]], depth), rank[at]
        by = np.lexsort((word, r))
        order[at], word = order[at[by]], word[by]
        fresh = np.ones(len(at), bool)
        fresh[1:] = (r[1:] != r[:-1]) | (word[1:] != word[:-1])
        rank[at] = np.maximum.accumulate(np.where(fresh, at, 0))
        depth += 8
        tied = again(rank)
    same = np.zeros(n, bool)
    at = np.flatnonzero(tied)
    if len(at):
        head = np.flatnonzero(np.diff(rank[at], prepend=-1))
        size = np.diff(np.append(head, len(at)))
        two = head[size == 2]
        if len(two):
            # two strings: the first difference after the shallow depth decides
            a, b = order[at[two]], order[at[two + 1]]
            swap, equal, i = np.zeros(len(two), bool), np.ones(len(two), bool), depth
            while i < length:
                j = min(i, length - 8)
                x, y = word_at(data, start[a], j), word_at(data, start[b], j)
                swap |= equal & (x > y)
                equal &= x == y
                i += 8
            order[at[two]], order[at[two + 1]] = np.where(swap, b, a), np.where(swap, a, b)
            same[at[two + 1][equal]] = True
        raw = data.tobytes()
        for h, k in zip(head[size > 2].tolist(), size[size > 2].tolist()):
            here = at[h:h + k]
            own = order[here]
            leaves = BlindTrie([raw[s:s + length] for s in start[own].tolist()]).leaves()
            numbers = [i for leaf in leaves for i in leaf]
            order[here] = own[numbers]
            lead = np.cumsum([0] + [len(leaf) for leaf in leaves[:-1]])
            more = np.ones(k, bool)
            more[lead] = False
            same[here[more]] = True
    return order, same


def sorted_marks(rows: DataFrame) -> DataFrame:
    """(id, span): spans (start << 9 | bytes) of strings that an earlier one equals."""
    def marks(cols):
        known = cols[3] < 0
        spans = cols[1][known], cols[2][known] << 9 | -cols[3][known]
        h, doc, first, left = (c[~known] for c in cols[:4])
        text = [t for t in cols[4] if t]
        if not text:
            return spans
        size = np.fromiter(map(len, text), np.int64, len(text))
        data = np.frombuffer(b"".join(text), np.uint8)
        n = size - LENGTH + 1
        row = np.repeat(np.arange(len(n)), n)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(np.cumsum(size) - size, n) + k
        # strings can only be equal at the same place of the same gram
        gram = np.cumsum(np.diff(h, prepend=h[0]) != 0)
        group = gram[row] * 256 + (left[row] - k)
        # rows come by (document, start), so the first of equal strings is the earliest
        order, same = deep_shallow_sort(data, start, group)
        gone = np.zeros(len(row) + 1, bool)
        gone[order[same]] = True
        edge = np.flatnonzero(gone[:-1] & np.concatenate(([True], ~gone[:-2] | (row[1:] != row[:-1]))))
        stop = np.flatnonzero(gone[:-1] & np.concatenate((~gone[1:-1] | (row[1:] != row[:-1]), [True])))
        r = row[edge]
        return tuple(np.concatenate(x) for x in zip(spans, (doc[r], (first[r] + k[edge]) << 9 | (k[stop] - k[edge] + LENGTH))))

    def run(batches):
        held, size = [], 0

        def flush(cols):
            doc, span = marks(cols)
            return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(span, pa.int64())], names=["id", "span"])

        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy() for c in b.columns[:4]] + [b.column(4).to_pylist()]
            # cut only where a new gram begins
            cuts = [0, *(np.flatnonzero(np.diff(cols[0])) + 1).tolist(), len(cols[0])]
            for x, y in zip(cuts, cuts[1:]):
                part = [c[x:y] for c in cols]
                if held and size > SORT_BYTES and part[0][0] != held[-1][0][-1]:
                    yield flush([np.concatenate(c) if i < 4 else [t for p in c for t in p] for i, c in enumerate(zip(*held))])
                    held, size = [], 0
                held.append(part)
                size += sum(map(len, part[4]))
        if held:
            yield flush([np.concatenate(c) if i < 4 else [t for p in c for t in p] for i, c in enumerate(zip(*held))])

    return rows.repartition("h").sortWithinPartitions("h", "id", "start").mapInArrow(run, "id long, span long")


def merged(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union; runs that touch are one."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    return begin[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)] if len(reach) else reach


def numbered(src: DataFrame) -> DataFrame:
    """(id, text, own): ids for rows whose own ids are null or repeat; they rise with (own id, null last, text)."""
    rows = src.select(F.col("id").alias("own"), "text").orderBy(F.col("own").asc_nulls_last(), "text")
    return durable(rows.withColumn("id", F.monotonically_increasing_id())).select("id", "text", "own")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, begins, ends[, kept]): one row per input row.

    Texts are UTF-8 bytes, null counts as empty, and strings never cross documents. ids are integers; a
    document is earlier if its id is smaller. Rows with null or repeated ids are documents of their own,
    ordered by id (null last), then text. begins and ends are the removed runs; ``kept`` (binary) what is left.
    """
    src = keyed_text(df, id_col, text_col).withColumn("id", F.col("id").cast("long"))
    seen = src.agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).first()
    unique = seen["n"] == seen["d"]
    known = src if unique else numbered(src)
    docs = known.select("id", "text")
    codes = durable(gram_marks(anchor_rows(docs), hot_grams(docs)).groupBy(F.col("id").alias("of")).agg(F.collect_list("code").alias("codes")))
    # both readers of ``held`` use the same columns of every document, so the texts are shuffled once
    held = docs.join(codes, docs["id"] == codes["of"], "left").select("id", "text", "codes")
    spans = sorted_marks(surroundings(held)).groupBy(F.col("id").alias("at")).agg(F.collect_list("span").alias("spans"))
    rows = held.join(spans, F.col("id") == F.col("at"), "left").select("id", "text", "codes", "spans")
    longs = T.ArrayType(T.LongType())
    fields = [("id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType()), ("begins", longs), ("ends", longs)]
    schema = T.StructType([T.StructField(*f) for f in fields + [("kept", T.BinaryType())] * kept_text])
    kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]

    def run(batches):
        for b in slices(batches, 1):
            out = []
            for doc, text, codes, spans in zip(*(c.to_pylist() for c in b.columns)):
                text = (text or "").encode("utf-8")
                begin, end, _, _, kind = unpacked(np.array(codes or (), np.int64))
                span = np.array(spans or (), np.int64)
                gone = kind == GONE
                begin, end = merged(np.concatenate((begin[gone], span >> 9)), np.concatenate((end[gone], (span >> 9) + (span & 511))))
                begins, ends = begin.tolist(), end.tolist()
                kept = b"".join([text[x:y] for x, y in zip([0, *ends], [*begins, len(text)])]) if begins else text
                out.append((doc, len(text), len(text) - len(kept), len(begins), hashlib.sha256(kept).hexdigest(), begins, ends, kept)[:len(fields) + kept_text])
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [()] * len(schema), kinds)], names=schema.names)

    out = rows.mapInArrow(run, schema)
    if unique:
        return out
    names = known.select(F.col("id").alias("number"), "own")
    return out.join(names, out["id"] == names["number"]).select(F.col("own").alias("id"), *out.columns[1:])
