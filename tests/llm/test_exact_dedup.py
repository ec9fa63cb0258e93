import hashlib
import random
import re
from collections import defaultdict

import pytest

from repolens.llm import exact_dedup as D
from tests.llm.data import empty, frame, odd, odd_rows, prose


def brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for i, t in rows:
        text = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        ids = groups[text]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def result(df, **how):
    return sorted(map(tuple, D.exact_groups(df, **how).select("id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


@pytest.mark.parametrize("key_bytes", [1, 16])  # with one byte most keys stand for several chunks
def test_groups_equal_brute_force(spark, key_bytes):
    rng = random.Random(3)
    base = [prose(rng, rng.choice([3, 50, 900, 4000])) for _ in range(25)]
    texts = base + [rng.choice(base).replace(" ", rng.choice([" ", "  ", "\n"])) for _ in range(40)]
    texts += [t + "x" for t in base] + ["x" + t for t in base]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    assert result(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), key_bytes=key_bytes) == brute(rows)


def test_chunks_concatenate_and_shift_with_the_content():
    rng = random.Random(1)
    text = prose(rng, 30_000).encode()
    chunks = D.chunks_of(text)
    assert b"".join(chunks) == text and max(map(len, chunks)) <= D.MOST_CHUNK
    shifted = D.chunks_of(b"some words before " + text)
    assert len(set(chunks) & set(shifted)) > 0.8 * len(chunks)
    assert D.chunks_of(b"") == [] and b"".join(D.chunks_of(b"a" * 100_000)) == b"a" * 100_000


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    assert result(odd(spark)) == brute(rows)


def test_empty_table(spark):
    assert D.exact_groups(empty(spark)).collect() == []


def test_dedup_keeps_columns(spark):
    df = odd(spark)
    out = D.exact_dedup(df)
    assert out.schema.names == df.schema.names
    texts = [re.sub(r"\s+", " ", r.text or "") for r in out.where("doc_id is not null").collect()]
    assert {t for t in texts} == {re.sub(r"\s+", " ", r.text or "") for r in df.where("doc_id is not null").collect()}


def test_ids_of_another_type(spark):
    df = frame(spark, ["a b", "a  b", "c"]).selectExpr("concat('k', doc_id) AS doc_id", "text")
    assert {(r.id, r.keep_id) for r in D.exact_groups(df).collect()} == {("k0", "k0"), ("k1", "k0"), ("k2", "k2")}


def test_dedup_keeps_one_row_of_each_text(spark):
    one = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    odd_ids = [(None, "a copy"), (2, "a copy"), (None, "alone"), (7, "text A"), (9, "text  A"), (3, "text B"), (7, "text B"),
               (None, "no ids"), (None, "no ids"), (None, "no\tids"), (5, "twice"), (5, "twice")]
    for rows in (odd_ids, [r[:2] for r in odd_rows()]):
        best = {}
        for i, t in rows:
            known = best.get(one(t))
            best[one(t)] = i if known is None else known if i is None else min(i, known)
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        got = [(one(r.text), r.doc_id) for r in D.exact_dedup(df).collect()]
        assert sorted(got, key=str) == sorted(best.items(), key=str)
