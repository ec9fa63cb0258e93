import hashlib
import random

import numpy as np
import pytest

from repolens.llm import suffix as S
from tests.llm.data import empty, odd, odd_rows


def brute(rows):
    """rows of (id, text) in document order."""
    seen, out = set(), []
    for i, text in rows:
        t = (text or "").encode()
        gone = np.zeros(len(t) + 1, np.int64)
        for k in range(len(t) - S.LENGTH + 1):
            if t[k:k + S.LENGTH] in seen:
                gone[k] += 1
                gone[k + S.LENGTH] -= 1
            else:
                seen.add(t[k:k + S.LENGTH])
        gone = np.cumsum(gone[:-1]) > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def result(df):
    return [tuple(r)[:5] for r in S.remove_repeats(df).collect()]


def shared_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (14, 15, 16, 17, 40, 200)] + ["ab" * 120, "z" * 300]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(5)):
            parts.append(rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randrange(40))))
        texts.append(" ".join(parts))
    texts += [texts[3], texts[4], texts[4][1:], "q" + texts[5], passages[5][:99], passages[5][7:107], passages[5][30:131]]
    return texts


@pytest.mark.parametrize("seed", range(3))
def test_removals_equal_brute_force(spark, seed):
    rows = list(enumerate(shared_texts(seed)))
    df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    assert sorted(result(df)) == brute(rows)


def test_small_steps_and_blocks_change_nothing(spark, monkeypatch):
    from repolens.llm import common
    data = np.frombuffer(" ".join(shared_texts(4)).encode(), np.uint8)
    with np.errstate(over="ignore"):
        whole = [np.concatenate(x) for x in zip(*S.anchors(data, np.array([0, len(data)])))]
        monkeypatch.setattr(S, "BLOCK", 1000)
        parts = [np.concatenate(x) for x in zip(*S.anchors(data, np.array([0, len(data)])))]
    # every string start is covered once, by the same anchor
    cover = lambda a: {(int(p - left + k), int(p)) for p, left, n in zip(a[1], a[2], a[3]) for k in range(n)}
    assert cover(whole) == cover(parts) and len(cover(whole)) == len(data) - S.LENGTH + 1
    assert common.STEP_BYTES > 0


def test_equal_strings_share_their_anchor():
    rng = random.Random(9)
    s = "".join(rng.choice("ab") for _ in range(100))
    with np.errstate(over="ignore"):
        found = set()
        for _ in range(20):
            before, after = ("".join(rng.choice("ab") for _ in range(rng.randrange(300))) for _ in range(2))
            data = np.frombuffer((before + s + after).encode(), np.uint8)
            for _, place, left, n, h, _ in S.anchors(data, np.array([0, len(data)])):
                start = place - left
                hit = np.flatnonzero((start <= len(before)) & (len(before) < start + n))
                found.update((int(place[i]) - len(before), int(h[i])) for i in hit)
    assert len(found) == 1


@pytest.mark.parametrize("letters", [1, 2, 4, 26])
def test_deep_shallow_sort(letters):
    rng = random.Random(letters)
    for _ in range(25):
        n = rng.randrange(110, 900)
        data = bytes(rng.randrange(97, 97 + letters) for _ in range(n))
        if rng.random() < 0.5:
            data = (data[:rng.randrange(1, 150)] * 900)[:n]
        m = n - S.LENGTH + 1
        group = np.array([rng.randrange(3) for _ in range(m)])
        order, same = S.deep_shallow_sort(np.frombuffer(data, np.uint8), np.arange(m), group)
        key = [(group[i], data[i:i + S.LENGTH], i) for i in order]
        assert key == sorted(key)
        assert same.tolist() == [i > 0 and key[i][:2] == key[i - 1][:2] for i in range(m)]


def test_blind_trie_orders_strings():
    rng = random.Random(5)
    strings = [bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(300)]
    leaves = S.BlindTrie(strings).leaves()
    assert [strings[x[0]] for x in leaves] == sorted(set(strings))
    assert all(len({strings[i] for i in x}) == 1 and x == sorted(x) for x in leaves)


def test_odd_rows(spark):
    # repeated and null ids: documents of their own, by id (null last), then text
    rows = sorted((r[:2] for r in odd_rows()), key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert sorted(result(odd(spark)), key=str) == sorted(brute(rows), key=str)
    assert S.remove_repeats(empty(spark)).collect() == []


def test_kept_text(spark):
    text = "".join(chr(97 + i * i % 23) + chr(97 + i * 7 % 19) for i in range(80))
    df = spark.createDataFrame([(1, text + " end of one"), (2, "begin " + text)], "doc_id long, text string")
    rows = {r.id: r for r in S.remove_repeats(df, kept_text=True).collect()}
    assert rows[1].kept.decode() == text + " end of one" and rows[2].kept == b"begin " and (rows[2].begins, rows[2].ends) == ([6], [6 + len(text)])


@pytest.mark.parametrize("most", [0, 3])  # 0: every gram in several surroundings is dealt out by strings
def test_strings_dealt_apart(spark, monkeypatch, most):
    monkeypatch.setattr(S, "MOST_TOGETHER", most)
    rng = random.Random(7)
    passage = " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(30))
    texts = shared_texts(1) + [f"{rng.random()} {passage} {rng.random()}" for _ in range(50)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string").repartition(5)
    assert sorted(result(df)) == brute(rows)


def test_strings_dealt_apart_with_wide_ids(spark, monkeypatch):
    monkeypatch.setattr(S, "MOST_TOGETHER", 1)
    rng = random.Random(7)
    passage = " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(30))
    texts = [f"{rng.random()} {passage} {rng.random()}" for _ in range(24)]
    rows = [((1 << 63) - 100 + i if i % 2 else i - (1 << 63), t) for i, t in enumerate(texts)]
    rows.sort()
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string").repartition(2)
    assert sorted(result(df)) == sorted(brute(rows))


@pytest.mark.parametrize("most,frequent", [(1, 2), (3, 3), (4096, 2)])
def test_hot_grams_dealt_by_surroundings_change_nothing(spark, monkeypatch, most, frequent):
    monkeypatch.setattr(S, "SAMPLE", 1)
    monkeypatch.setattr(S, "HOT_IN_SAMPLE", frequent)
    monkeypatch.setattr(S, "MOST_TOGETHER", most)
    rows = list(enumerate(shared_texts(7), -20))
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string").repartition(7)
    assert not S.hot_grams(df.withColumnRenamed("doc_id", "id")).isEmpty()
    assert sorted(result(df)) == brute(rows)
    assert sorted(result(odd(spark)), key=str) and S.remove_repeats(empty(spark)).collect() == []


def test_a_passage_of_a_third_of_all_documents_meets_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "SAMPLE", 1)
    rng = random.Random(5)
    line = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = line(160)
    rows = [(i, line(60) + passage + line(60) if i % 3 == 0 else line(120)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(6)
    anchors = S.anchor_rows(docs)
    hot = S.hot_grams(docs)
    most = lambda df: max(r["count"] for r in df.withColumn("p", S.F.spark_partition_id()).groupBy("h", "p").count().collect())
    keep = S.F.col("code").bitwiseAND(3) == S.KEEP
    hottest = max(r["count"] for r in anchors.where(keep).groupBy("h").count().collect())
    assert hottest > 500 and 0 < hot.count() < 100
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small partitions would be put together
    try:
        assert most(S.dealt_anchors(anchors, hot).where(keep)) < hottest / 2
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    # all but the first document's copy goes, wherever the strings end
    got = {r[0]: r[2] for r in S.remove_repeats(docs.withColumnRenamed("id", "doc_id")).collect()}
    assert all((got[i] >= 160) == (i % 3 == 0 and i > 0) for i in got)
