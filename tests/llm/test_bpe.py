import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from repolens.llm import bpe
from tests.llm.data import ODD_TEXTS, empty, frame, odd

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def expected(t, text):
    ids = t.encode(text or "", add_special_tokens=False).ids
    return ids, t.decode(ids, skip_special_tokens=False)


def test_fuzz_against_the_library(library):
    rng = random.Random(6)
    parts = list("abXYZ '’.,!<|>0129\n\t\r\x0b\x0c\x1c\x85\xa0　​ÀéßİΣς日本한글العربية😀ǅﬁ½²Ⅷ́­﻿") + ["<|startoftext|>", "<|endoftext|>", "<|START", "'s", "'LL", "don't", "é", "the ", "tokenization "]
    mine = bpe.WordBpe(PATH)
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        ids, decoded = expected(library, text)
        assert mine.encode(text) == ids and mine.decode(ids) == decoded
        assert mine.digest(text) == (len(ids), " ".join(map(str, ids)), decoded)


def test_letters_that_python_lacks(library):
    mine = bpe.WordBpe(PATH)
    newer = sorted(bpe.newer_letters())
    assert newer
    # all with a lower case that the library knows, and every twentieth of the others
    chosen = [c for c in newer if mine.normal(c) != c] + newer[::20]
    texts = [t.replace("_", c) for c in chosen for t in ("a_b", "!_! 1_2", "_ <|endoftext|>_É x")]
    for text, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        decoded = library.decode(e.ids, skip_special_tokens=False)
        assert mine.encode(text) == e.ids and mine.digest(text) == (len(e.ids), " ".join(map(str, e.ids)), decoded)
    plain = "a b! É 日本"
    assert mine.digest(plain)[1] == " ".join(map(str, expected(library, plain)[0]))  # nothing wrong was remembered


def test_forgotten_words_are_encoded_alike(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 6)
    mine = bpe.WordBpe(PATH)
    text = " ".join(f"word{i % 9} other{i}" for i in range(300))
    assert mine.digest(text)[1] == " ".join(map(str, expected(library, text)[0]))


def test_merges_follow_rank_then_place():
    names = ["a", "b", "c", "d", "bc", "ab", "bcd", "aa", "aaaa"]
    number = {s: i for i, s in enumerate(names)}
    order = [("b", "c"), ("a", "b"), ("bc", "d"), ("a", "a"), ("aa", "aa")]
    merges = {number[a] << bpe.ID_BITS | number[b]: r << bpe.ID_BITS | number[a + b] for r, (a, b) in enumerate(order)}
    merged = lambda text: [names[i] for i in bpe.merge_word([number[c] for c in text], merges)]
    assert merged("abcd") == ["a", "bcd"] and merged("aaaaa") == ["aaaa", "a"] and merged("") == [] and merged("a") == ["a"]


def test_queries_equal_the_library(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: expected(library, r.text) for r in docs.collect()}
    for r in bpe.round_trip(docs, PATH).collect():
        ids, decoded = want[r.id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_encode_and_decode_tables(spark, library):
    df = frame(spark, ODD_TEXTS)
    ids = bpe.encode_texts(df, PATH)
    assert {r.id: list(r.ids) for r in ids.collect()} == {i: expected(library, t)[0] for i, t in enumerate(ODD_TEXTS)}
    assert {r.id: r.text for r in bpe.decode_ids(ids, PATH).collect()} == {i: expected(library, t)[1] for i, t in enumerate(ODD_TEXTS)}


def test_odd_rows(spark):
    assert bpe.round_trip(odd(spark), PATH).count() == odd(spark).count()
    assert bpe.round_trip(empty(spark), PATH).collect() == []
