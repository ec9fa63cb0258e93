import random

import numpy as np
from pyspark.sql import functions as F

from repolens.llm import toxicity as X
from tests.llm.data import empty, frame, odd, prose


def brute_segments(scores):
    """All maximal scoring subsequences by their definition: take the best (shortest, leftmost), go on at its sides."""
    out = []

    def split(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-9 or abs(total - best[0]) <= 1e-9 and j - i < best[2] - best[1]):
                    best = (total, i, j)
        if best:
            split(a, best[1])
            out.append((best[1], best[2], round(best[0], 6)))
            split(best[2] + 1, b)
    split(0, len(scores))
    return out


def test_segments_equal_their_definition():
    rng = random.Random(8)
    for _ in range(200):
        n = rng.randrange(1, 30)
        hits = [(i, rng.choice([0.03, 0.07, 0.11, 0.23])) for i in range(n) if rng.random() < 0.4]
        scores = [-X.WORD_COST] * n
        for i, s in hits:
            scores[i] = s
        got = [(a, b, round(t, 6)) for a, b, t in X.segments(hits)]
        assert got == brute_segments(scores)


def corpus(spark, docs=400):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(docs):
        toxic = i % 5 == 0
        words = prose(rng, rng.randrange(40, 300), 3000).split()
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(["awfulword", "nastything", "badterm"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_separates_what_labels_mark(spark):
    docs, labels = corpus(spark)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = X.learn(docs, labels.where(~held))
    assert {"awfulword", "nastything", "badterm"} <= model.terms.keys()
    out = X.score_texts(docs, model, passages=True).join(labels, F.col("id") == labels["doc_id"]).withColumn("held", held).collect()
    test = [r for r in out if r.held]
    assert np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in test]) > 0.95
    assert all(0 <= r.score <= 1 for r in out)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in out:  # each passage begins and ends with a term
        words = X.LETTERS(texts[r.doc_id].lower())
        for p in r.passages:
            assert model.word(words[p["first"]]) > 0 and model.word(words[p["last"]]) > 0


def test_held_out_rows_teach_nothing(spark):
    docs, labels = corpus(spark)
    train = labels.where("doc_id % 2 = 0")
    changed = docs.withColumn("text", F.when(F.col("doc_id") % 2 == 1, F.lit("awfulword")).otherwise(F.col("text")))
    assert X.learn(docs, train) == X.learn(changed, train)


def test_held_out_accuracy_on_the_given_tables(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = X.learn(docs, labels.where(~held))
    rows = X.score_texts(docs, model).join(labels.where(held), F.col("id") == labels["doc_id"]).collect()
    hit = [(r.score >= 0.5, r.toxic == 1) for r in rows]
    assert sum(p and t for p, t in hit) >= 0.85 * sum(t for _, t in hit)
    assert sum(p and not t for p, t in hit) <= 0.01 * len(hit)


def test_odd_rows_and_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 1)], "doc_id long, toxic int")):
        model = X.learn(odd(spark), labels)
        assert X.score_texts(odd(spark), model).count() == odd(spark).count()
    assert X.score_texts(empty(spark), X.Model()).collect() == []
    docs, labels = corpus(spark)
    model = X.learn(docs, labels)
    scores = {r.id: r.score for r in X.score_texts(frame(spark, [None, "", "awfulword awfulword badterm"]), model).collect()}
    assert scores[0] == scores[1] < 0.5 < scores[2]
    assert X.learn(empty(spark), labels) == X.Model(weights=(0.0, 0.0, 0.0, 0.0))
