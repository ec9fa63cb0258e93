"""Toxicity by maximum-scoring segments of token log-odds.

Terms (words and word beginnings) get log-odds of toxic against clean documents under a Dirichlet prior
that is a share of the labelled sample's own counts; a term counts by its lower confidence bound, every other word
costs a little. One linear scan per text finds all maximal segments (Ruzzo and Tompa). What a segment's
total means depends on the text's length: totals of chance segments follow an extreme-value law, whose
two parameters come from clean documents. The p-value of the best segment, the number of significant
segments and their sum give the score through a logistic fit on labelled documents kept out of the terms.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import col, durable, keyed_text, slices, texts_of

#: At most so many labelled documents are learnt from (by the order of a hash of their ids).
FIT_ROWS = 20_000
#: Share of the sample's pooled counts in the prior, least z-value of a term, confidence of its bound in deviations.
PRIOR, LEAST_Z, BOUND = 0.1, 3.5, 1.5
#: Lengths of word beginnings that are terms; what a word without a term costs.
STEMS, WORD_COST = range(4, 9), 0.05
#: Segments below this total are no evidence.
LEAST_SEGMENT = 1.0
#: Running totals closer than this are equal.
EQUAL = 1e-9
#: Words whose score a worker remembers at a time.
CACHE_WORDS = 300_000
LETTERS = re.compile(r"[^\W\d_]+").findall


def terms_of(word: str) -> list[str]:
    """The word and, marked by ^, its beginnings."""
    return [word, *("^" + word[:k] for k in STEMS if k < len(word))]


@dataclass
class Model:
    """All that scoring needs; its terms are those of the labelled sample that pass their bound."""
    terms: dict[str, float] = field(default_factory=dict)
    rate: float = 1.0  # the extreme-value law's lambda and K
    k: float = 1.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)

    def __post_init__(self):
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "cache": {}}

    def word(self, word: str) -> float:
        found = max((s for t in terms_of(word) if (s := self.terms.get(t)) is not None), default=0.0)
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[word] = found
        return found

    def hits(self, text: str) -> tuple[int, list[tuple[int, float]]]:
        """Number of words, and (position, score) of those with a term."""
        words = LETTERS(text.lower())
        cache, slow = self.cache, self.word
        scores = [s if (s := cache.get(w)) is not None else slow(w) for w in words]
        return len(words), [(i, s) for i, s in enumerate(scores) if s]

    def features(self, text: str) -> tuple[float, float, float]:
        """-log p of the best segment, log of the significant segments' number and of their total."""
        n, hits = self.hits(text)
        totals = [s for _, _, s in segments(hits) if s >= LEAST_SEGMENT]
        if not totals:
            return 0.0, 0.0, 0.0
        expected = self.k * n * math.exp(-self.rate * max(totals))
        p = -math.expm1(-expected)
        return -math.log(max(p, 1e-30)), math.log1p(len(totals)), math.log1p(sum(totals))

    def score(self, text: str) -> float:
        x = self.weights[0] + sum(w * f for w, f in zip(self.weights[1:], self.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def segments(hits: list[tuple[int, float]]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last position, total) in one pass, words between hits costing WORD_COST.

    Kept per segment: the running total before (left) and after (right) it. A new hit joins the nearest
    earlier segment of smaller left if that one's right is smaller too; joined segments form a new hit.
    """
    found: list[tuple[int, int, float, float]] = []
    total, at = 0.0, -1
    for i, s in hits:
        total -= WORD_COST * (i - at - 1)
        first, left, right, at = i, total, total + s, i
        total = right
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= left - EQUAL:
                j -= 1
            if j < 0 or found[j][3] >= right - EQUAL:
                found.append((first, i, left, right))
                break
            first, left = found[j][0], found[j][2]
            del found[j:]
    return [(a, b, right - left) for a, b, left, right in found]


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, rows: int) -> DataFrame:
    """(of, toxic, part): at most ``rows`` labelled ids, the same for equal input; part 0 calibrates, others give terms."""
    one = labels.where(col(label_col).isNotNull() & col(id_col).isNotNull()).groupBy(col(id_col).alias("of")).agg(F.max(col(label_col)).cast("int").alias("toxic"))
    key = F.xxhash64(F.col("of").cast("string"))
    return one.withColumn("part", F.pmod(F.xxhash64(F.col("of").cast("string"), F.lit(1)), F.lit(4))).orderBy(key, "of").limit(rows)


def term_table(sample: DataFrame) -> DataFrame:
    """(term, toxic documents n1, clean documents n0) of the (text, toxic) rows that give terms."""
    def run(batches):
        for b in batches:
            found = (Counter(), Counter())
            toxic = b.column(1).to_pylist()
            for first, texts in texts_of(b.column(0)):
                for i, t in enumerate(texts, first):
                    found[toxic[i] == 1].update({x for w in set(LETTERS(t.decode("utf-8", "replace").lower())) for x in terms_of(w)})
            names = list(found[0].keys() | found[1].keys())
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([found[1][w] for w in names], pa.int64()), pa.array([found[0][w] for w in names], pa.int64())], names=["term", "n1", "n0"])

    return sample.select("text", "toxic").mapInArrow(run, "term string, n1 long, n0 long").groupBy("term").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))


def log_odds(table: DataFrame, d1: int, d0: int) -> DataFrame:
    """(term, odds, z): log-odds of the two document rates with a Dirichlet prior of PRIOR times the pooled counts."""
    n = F.col("n1") + F.col("n0")
    y1, y0 = F.col("n1") + n * (PRIOR * d1 / (d1 + d0)), F.col("n0") + n * (PRIOR * d0 / (d1 + d0))
    odds = F.log(y1 / d1) - F.log(y0 / d0)
    deviation = F.sqrt(1 / y1 + 1 / y0)
    return table.select("term", (odds - BOUND * deviation).alias("odds"), (odds / deviation).alias("z"))


def chance_law(words: int, scores: dict[float, int], totals: list[tuple[int, float]]) -> tuple[float, float]:
    """(lambda, K): lambda solves sum p(s) exp(lambda s) = 1 over clean words, K matches the clean segments seen.

    ``scores``: clean words by score (to a tenth), ``totals``: (words of the text, best segment or 0).
    """
    hit = {s: n + 0.5 for s, n in scores.items()} or {5.0: 0.5}
    p = {s: n / (words + 1) for s, n in hit.items()}
    rest = max(1e-9, 1 - sum(p.values()))
    low, high = 1e-6, 10.0
    for _ in range(80):
        mid = (low + high) / 2
        if rest * math.exp(-mid * WORD_COST) + sum(q * math.exp(min(700.0, mid * s)) for s, q in p.items()) < 1:
            low = mid
        else:
            high = mid
    rate = max(low, 0.05)
    seen = [s for _, s in totals if s >= LEAST_SEGMENT]
    room = sum(n for n, _ in totals)
    level = min(seen, default=LEAST_SEGMENT)
    return rate, max(len(seen), 0.5) / max(1.0, room * math.exp(-rate * level))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Newton's iterations of a logistic fit with an intercept; few rows, driver side."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    pull = ridge * np.eye(x.shape[1])
    pull[0, 0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull, x.T @ (y - p) - pull @ w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _clean_texts(sample: DataFrame, model: Model) -> DataFrame:
    """(n, top, hits): words, best segment and term scores of each text."""
    def run(batches):
        for b in slices(batches, 0):
            found = [model.hits(t.decode("utf-8", "replace")) for _, texts in texts_of(b.column(0)) for t in texts]
            top = [max((s for _, _, s in segments(h)), default=0.0) for _, h in found]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], pa.int64()), pa.array(top, pa.float64()),
                                              pa.array([[s for _, s in h] for _, h in found], pa.list_(pa.float64()))], names=["n", "top", "hits"])

    return sample.select("text").mapInArrow(run, "n long, top double, hits array<double>")


def _points(sample: DataFrame, model: Model) -> list:
    def run(batches):
        for b in batches:
            rows = [model.features(t.decode("utf-8", "replace")) for _, texts in texts_of(b.column(0)) for t in texts]
            f = np.array(rows, float).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array(f[:, i]) for i in range(3))], names=["toxic", "a", "b", "c"])

    return sample.select("text", "toxic").mapInArrow(run, "toxic int, a double, b double, c double").collect()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
          label_col: str = "toxic", fit_rows: int = FIT_ROWS, max_terms: int | None = None) -> Model:
    """The model of the labelled documents. The driver sees at most ``fit_rows`` rows of numbers, and the terms whose
    bound holds (all of them, unless ``max_terms`` says how many of the best): a share of the sample's words.

    Rows without an id, a label or a document teach nothing. With one class only, or no labels, every text
    scores the share of toxic labels, one half added to either class.
    """
    sample = F.broadcast(labelled_sample(labels, label_id, label_col, fit_rows))  # fit_rows rows of three numbers at most
    rows = durable(keyed_text(docs, id_col, text_col).join(sample, F.col("id") == F.col("of")).select("text", "toxic", "part"))
    size: dict[tuple[bool, bool], int] = {}
    for r in rows.groupBy("toxic", (F.col("part") == 0).alias("kept")).agg(F.count("*").alias("n")).collect():
        size[r["toxic"] == 1, r["kept"]] = size.get((r["toxic"] == 1, r["kept"]), 0) + r["n"]
    d1, d0 = size.get((True, False), 0), size.get((False, False), 0)
    all1, all0 = d1 + size.get((True, True), 0), d0 + size.get((False, True), 0)
    base = Model(weights=(math.log((all1 + 0.5) / (all0 + 0.5)), 0.0, 0.0, 0.0))
    if not d1 or not d0:
        return base
    found = log_odds(term_table(rows.where("part != 0")), d1, d0).where((F.col("z") >= LEAST_Z) & (F.col("odds") > 0))
    if max_terms is not None:
        found = found.orderBy(F.desc("z"), "term").limit(max_terms)
    model = Model(terms={r["term"]: r["odds"] for r in found.collect()})
    clean = durable(_clean_texts(rows.where("part = 0 and toxic != 1"), model))
    hits = clean.select(F.explode("hits").alias("s")).groupBy(F.round("s", 1).alias("s")).count().collect()  # a row for each tenth
    best = clean.select("n", "top").collect()
    model.rate, model.k = chance_law(sum(r["n"] for r in best), {r["s"]: r["count"] for r in hits}, [(r["n"], r["top"]) for r in best])
    points = _points(rows.where("part = 0"), model)
    y = np.array([r["toxic"] == 1 for r in points], float)
    if not 0 < y.sum() < len(y):
        model.weights = (base.weights[0], 0.0, 0.5, 1.0)
        return model
    model.weights = tuple(logistic(np.array([(r["a"], r["b"], r["c"]) for r in points]), y).tolist())
    return model


def score_texts(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", passages: bool = False) -> DataFrame:
    """(id, score): one row per input row; null and empty texts score like texts without a term.

    With ``passages`` also an array of (first word, last word, total) of each significant segment.
    """
    src = keyed_text(df, id_col, text_col)
    fields = [src.schema["id"], T.StructField("score", T.DoubleType())]
    if passages:
        item = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType()), T.StructField("total", T.DoubleType())])
        fields.append(T.StructField("passages", T.ArrayType(item)))
    schema = T.StructType(fields)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("total", pa.float64())]))

    def run(batches):
        for b in slices(batches, 1):
            texts = [t.decode("utf-8", "replace") for _, ts in texts_of(b.column(1)) for t in ts]
            cols = [b.column(0), pa.array([model.score(t) for t in texts], pa.float64())]
            if passages:
                cols.append(pa.array([[dict(zip(("first", "last", "total"), s)) for s in segments(model.hits(t)[1]) if s[2] >= LEAST_SEGMENT] for t in texts], kind))
            yield pa.RecordBatch.from_arrays(cols, names=schema.names)

    return src.mapInArrow(run, schema)
