"""Spelling variants by finite-state composition: vocabulary acceptor, one-edit transducer, acceptor again.

Two words are near if one inserted, deleted or replaced code point makes them equal. The words are dealt into
partitions, each the words that a known start and a known end share: what lies between is read from the
initial state of the partition's own minimised acceptor. Composing that acceptor with the one-edit transducer and
with itself, states are (left, edits, right); before the edit both sides have read the same string, after it
both must read the same rest, so a path is accepted where the right languages of two states meet. Longer and
shorter words have initial states of their own over shared states: replacements are paths within the longer
ones, deletions paths from the longer to the shorter ones.

A pair of lengths L and L or L - 1 differs in its first half or in what follows; in the latter case both words
share the first half, else the end. So every word is in four partitions (as longer and as shorter word, by
start and by end), and each near pair is accepted in just one of them, on one path: the deleted letter of a run of equal
letters is the last. A partition of more than ``most`` words is dealt again by halves of what lies between, until
it fits; where one code point is left, there are no more words than letters. No bucket is dropped or capped.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import col, durable

#: Words of a partition that one task composes; more are dealt again. Bounds memory, never results.
MOST_WORDS = 20_000
LETTERS = "A-Za-zÀ-ÿ"


def word_runs(df: DataFrame, id_col: str, text_col: str, least: int) -> DataFrame:
    """(id string, run): the maximal letter runs of at least ``least`` code points of each whole text, A-Z in lower case."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    text = F.translate(col(text_col).cast("string"), upper, lower)
    return df.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("id"),
                     F.explode(F.regexp_extract_all(text, F.lit(f"[{LETTERS}]{{{least},}}"), F.lit(0))).alias("run"))


def misspelt(runs: DataFrame, every: int) -> DataFrame:
    """(word): the runs, of which those whose crc32 of ``<id>:<run>`` ``every`` divides lose one code point."""
    at = "CAST(h % char_length(run) AS INT)"
    return runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run"))).select(
        F.expr(f"CASE WHEN h % {every} = 0 THEN concat(left(run, {at}), substring(run, {at} + 2)) ELSE run END").alias("word"))


def vocabulary(words: DataFrame, least: int, times: int) -> DataFrame:
    """(word, n): distinct words of at least ``least`` code points that occur ``times`` or more; null words don't count."""
    return (words.where(F.char_length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= times))


def partitions(vocab: DataFrame) -> DataFrame:
    """(size, pre, suf, rem, n): each word's four partitions, ``size`` the longer word's length, and its rest in them."""
    made = []
    for more in (0, 1):
        size = f"(char_length(word) + {more})"
        half = f"({size} div 2)"
        made += [F.expr(f"struct({size} AS size, left(word, CAST({half} AS INT)) AS pre, '' AS suf, substring(word, CAST({half} AS INT) + 1) AS rem, n)"),
                 F.expr(f"struct({size} AS size, '' AS pre, right(word, CAST({size} - {half} AS INT)) AS suf, "
                        f"left(word, CAST({half} AS INT) - {more}) AS rem, n)")]
    return vocab.select(F.explode(F.array(*made)).alias("p")).select("p.*")


def halved(rows: DataFrame) -> DataFrame:
    """The rows of partitions dealt again: by the first half of what lies between, and by the end of it."""
    left = "(size - char_length(pre) - char_length(suf))"  # of the longer words
    half = f"CAST({left} div 2 AS INT)"
    end = f"CAST({left} - {left} div 2 AS INT)"
    return rows.select(F.explode(F.array(
        F.expr(f"struct(size, concat(pre, left(rem, {half})) AS pre, suf, substring(rem, {half} + 1) AS rem, n)"),
        F.expr(f"struct(size, pre, concat(right(rem, {end}), suf) AS suf, left(rem, char_length(rem) - {end}) AS rem, n)"))).alias("p")).select("p.*")


def dealt(vocab: DataFrame, most: int) -> DataFrame:
    """All partitions' rows, none over ``most`` words unless a single code point is left between."""
    rows, done = partitions(vocab), []
    while True:
        key = F.xxhash64("size", "pre", "suf")
        hot = durable(rows.where("size - char_length(pre) - char_length(suf) > 1").groupBy(key.alias("k")).agg(F.count("*").alias("c"))
                      .where(F.col("c") > most).select("k"))
        if hot.isEmpty():
            done.append(rows)
            break
        tagged = rows.withColumn("k", key)
        wide = F.expr("size - char_length(pre) - char_length(suf) > 1")
        done.append(tagged.join(hot.withColumn("hot", F.lit(True)), "k", "left").where(~wide | F.col("hot").isNull()).select(*rows.columns))
        rows = durable(halved(tagged.where(wide).join(hot, "k", "left_semi").select(*rows.columns)))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


class Acceptor:
    """Minimised acyclic acceptor of sets of equally long strings, several initial states sharing its states.

    A state that accepts one string is that string; any other is a number, equal for equal right languages.
    """

    def __init__(self):
        self.register: dict[tuple, int] = {}
        self.arcs: list[dict[str, int | str]] = []
        self.met: dict[tuple[int, int], list[str]] = {}
        self.all: dict[int, list[str]] = {}

    def state(self, words: list[str], lo: int, hi: int, at: int) -> int | str:
        """The state that accepts what follows ``at`` in the sorted ``words[lo:hi]``."""
        if hi - lo == 1:
            return words[lo][at:]
        arcs = {}
        while lo < hi:
            c, end = words[lo][at], lo + 1
            while end < hi and words[end][at] == c:
                end += 1
            arcs[c] = self.state(words, lo, end, at + 1)
            lo = end
        return self.register_state(arcs)

    def register_state(self, arcs: dict) -> int:
        key = tuple(arcs.items())
        got = self.register.get(key)
        if got is None:
            got = self.register[key] = len(self.arcs)
            self.arcs.append(arcs)
        return got

    def accepts(self, p: int | str, word: str) -> bool:
        for i, c in enumerate(word):
            if type(p) is str:
                return p == word[i:]
            p = self.arcs[p].get(c)
            if p is None:
                return False
        return p == ""

    def language(self, p: int | str) -> list[str]:
        if type(p) is str:
            return [p]
        got = self.all.get(p)
        if got is None:
            got = self.all[p] = [c + s for c, q in self.arcs[p].items() for s in self.language(q)]
        return got

    def both(self, p: int | str, q: int | str) -> list[str]:
        """What two states both accept: the composed machine's paths after the edit."""
        if p == q:
            return self.language(p)
        if type(p) is str:
            return [p] if type(q) is int and self.accepts(q, p) else []
        if type(q) is str:
            return [q] if self.accepts(p, q) else []
        key = (p, q) if p < q else (q, p)
        got = self.met.get(key)
        if got is None:
            other = self.arcs[q]
            got = self.met[key] = [c + s for c, a in self.arcs[p].items() if c in other for s in self.both(a, other[c])]
        return got

    def replaced(self, p: int | str, read: str = ""):
        """(x, y), x < y: pairs of strings of one state that differ by one replaced letter."""
        if type(p) is str:
            return
        arcs = list(self.arcs[p].items())
        for i, (c, a) in enumerate(arcs):
            for d, b in arcs[i + 1:]:
                for s in self.both(a, b):
                    yield read + c + s, read + d + s
            yield from self.replaced(a, read + c)

    def follow(self, p: int | str) -> dict[str, int | str]:
        if type(p) is str:
            return {p[0]: p[1:]} if p else {}
        return self.arcs[p]

    def deleted(self, p: int | str, q: int | str, after: str, read: str = ""):
        """(x, y): x of ``p`` without one letter is y of ``q``; the letter is not the next one (``after`` follows the string)."""
        right = self.follow(q)
        for c, a in self.follow(p).items():
            for s in self.both(a, q):
                if (s or after)[:1] != c:
                    yield read + c + s, read + s
            if c in right:
                yield from self.deleted(a, right[c], after, read + c)


def group_pairs(machine: Acceptor, size: int, pre: str, suf: str, rems: list[str]):
    """The near pairs (rests) of one partition whose longer word has ``size`` code points."""
    length = size - len(pre) - len(suf)
    rems = sorted(rems)
    longer, shorter = [r for r in rems if len(r) == length], [r for r in rems if len(r) != length]
    if not longer:
        return
    p = machine.state(longer, 0, len(longer), 0)
    if len(longer) > 1:
        yield from machine.replaced(p)
    if shorter:
        yield from machine.deleted(p, machine.state(shorter, 0, len(shorter), 0), suf[:1])


def group_runs(batches):
    """((size, pre, suf), rests, counts) of each partition of at least two words, from rows sorted by it."""
    key, rems, counts = None, [], []
    for b in batches:
        for size, pre, suf, rem, n in zip(*(c.to_pylist() for c in b.columns)):
            if key is None or pre != key[1] or suf != key[2] or size != key[0]:
                if len(rems) > 1:
                    yield key, rems, counts
                key, rems, counts = (size, pre, suf), [], []
            rems.append(rem)
            counts.append(n)
    if len(rems) > 1:
        yield key, rems, counts


def together(rows: DataFrame) -> DataFrame:
    return rows.repartition("size", "pre", "suf").sortWithinPartitions("size", "pre", "suf")


#: States of a task's acceptor before it starts a new one; bounds memory only.
MOST_STATES = 200_000


def near_pairs(vocab: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """(a, b): each pair of near words of ``vocab`` (word, n) once; where lengths differ, ``a`` is the longer, else the smaller."""
    def pairs(batches):
        machine, a, b = Acceptor(), [], []
        for (size, pre, suf), rems, _ in group_runs(batches):
            for x, y in group_pairs(machine, size, pre, suf, rems):
                a.append(pre + x + suf)
                b.append(pre + y + suf)
                if len(a) >= 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                    a, b = [], []
            if len(machine.arcs) > MOST_STATES:
                machine = Acceptor()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return together(dealt(vocab, most)).mapInArrow(pairs, "a string, b string")


def near_forms(vocab: DataFrame, most: int = MOST_WORDS) -> DataFrame:
    """(word, n, n_near, best_n, best): each word's number of near words and the most frequent (ties: smallest) of them."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("n_near", T.LongType()),
                           T.StructField("best_n", T.LongType()), T.StructField("best", T.StringType())])

    def forms(batches):
        machine, out = Acceptor(), []
        for (size, pre, suf), rems, counts in group_runs(batches):
            known, found = dict(zip(rems, counts)), {}
            for pair in group_pairs(machine, size, pre, suf, rems):
                for x, y in (pair, pair[::-1]):
                    n, was = known[y], found.get(x)
                    if was is None:
                        found[x] = [1, n, y]
                    else:
                        was[0] += 1
                        if n > was[1] or n == was[1] and pre + y + suf < pre + was[2] + suf:
                            was[1:] = n, y
            out += [(pre + x + suf, near, n, pre + y + suf) for x, (near, n, y) in found.items()]
            if len(out) >= 1 << 15:
                yield batch(out)
                out = []
            if len(machine.arcs) > MOST_STATES:
                machine = Acceptor()
        yield batch(out)

    def batch(out):
        word, near, n, best = zip(*out) if out else ((), (), (), ())
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.nulls(len(out), pa.int64()), pa.array(near, pa.int64()),
                                           pa.array(n, pa.int64()), pa.array(best, pa.string())], names=schema.names)

    parts = together(dealt(vocab, most)).mapInArrow(forms, schema)
    own = vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    first = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("c"), F.col("best").alias("w"))))
    return own.unionByName(parts).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), first.alias("f")).select(
        "word", "n", "n_near", (-F.col("f.c")).alias("best_n"), F.col("f.w").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word with a form, of (word, form): where following forms ends.

    Each round doubles the steps taken. A form is at least ten times as frequent as its word, so chains have
    at most 19 words and five rounds end them.
    """
    now = durable(forms.select("word", F.col("form").alias("root")))
    while True:
        on = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = durable(now.join(on, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def variants(vocab: DataFrame, times: int = 10, most: int = MOST_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``vocab`` (word, n: each word once, n over 0).

    A word's form is its most frequent near word (ties: the smallest) where that occurs at least ``times`` as often.
    An empty vocabulary gives no rows; a word without near words has n_near 0, null form and itself as root.
    """
    vocab = durable(vocab.select("word", F.col("n").cast("long").alias("n")))
    has = F.expr(f"best_n div {times} >= n")
    found = durable(near_forms(vocab, most).select("word", F.when(has, F.col("best")).alias("form"), "n", "n_near", F.when(has, F.col("best_n")).alias("form_n")))
    ends = roots(found.where("form IS NOT NULL")).withColumnRenamed("word", "w")
    return found.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def document_words(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 31, least: int = 7, times: int = 2) -> DataFrame:
    """(word, n): the words of all whole texts after the stated misspellings. Null texts have none, a null id counts as empty."""
    return vocabulary(misspelt(word_runs(df, id_col, text_col, least), every), least, times)
