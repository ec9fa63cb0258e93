import hashlib
from collections import Counter

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as C
from tests.llm import test_exact_dedup, test_mixing, test_quality, test_simhash
from tests.llm.data import empty, odd


def kept_by_rules(text):
    n, chars, symbols, dup, rep, lines, upper = test_quality.brute(text)
    return not (n < 50 or 100 * rep > 50 * n or 10 * symbols > 3 * n or 10 * dup > 4 * lines or 10 * upper > 3 * chars or chars > 12 * n or chars < 2 * n)


def test_stages_equal_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    step = [r for r in rows if kept_by_rules(r[1])]
    now = C.quality_rules(spark, docs, sf_dir)
    assert ids(now) == sorted(r[0] for r in step) and now.schema.names == docs.schema.names
    stays = {i for i, keep, *_ in test_exact_dedup.brute([r[:2] for r in step]) if i == keep}
    step = [r for r in step if r[0] in stays]
    now = C.exact_copies(spark, now, sf_dir)
    assert ids(now) == sorted(stays) and now.schema.names == docs.schema.names
    stays = {i for i, _, c in test_simhash.components([r[:2] for r in step]) if i == c}
    step = [r for r in step if r[0] in stays]
    now = C.near_copies(spark, now, sf_dir)
    assert ids(now) == sorted(stays) and now.schema.names == docs.schema.names
    size = {i: len((t or "").split()) for i, t, _ in step}
    total = Counter()
    for i, _, s in step:
        total[s] += size[i]
    mixed = C.source_mix(spark, now, sf_dir)
    copies = Counter(ids(mixed))
    assert mixed.schema.names == docs.schema.names and copies.keys() <= stays and max(copies.values()) <= 2
    for s, goal in test_mixing.brute_targets(dict(total)).items():
        got = sum(n * size[i] for i, n in copies.items() if dict((r[0], r[2]) for r in step)[i] == s)
        assert abs(got - goal) <= 0.05 * goal + max(size.values()) / 2
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r[0]: r[1] for r in step}
    want = []
    for i, n in copies.items():
        t = library.encode(texts[i], add_special_tokens=False).ids
        row = (i, len(t), hashlib.sha256(" ".join(map(str, t)).encode()).hexdigest(), hashlib.sha256(library.decode(t, skip_special_tokens=False).encode()).hexdigest())
        want += [row] * n
    assert sorted(map(tuple, C.tokens(spark, mixed, sf_dir).collect())) == sorted(want)
    assert sorted(map(tuple, C.run(spark, sf_dir).collect())) == sorted(want)


def test_odd_and_empty_tables(spark):
    for df in (odd(spark), empty(spark)):
        now = df
        for name, stage in C.STAGES:
            out = stage(spark, now, "unused")
            if stage is not C.tokens:
                assert out.schema.names == df.schema.names, name
                now = out
        out.collect()


def test_copies_fall_to_one_and_clean_texts_stay(spark):
    text = " ".join(f"word{i * 37 % 101}x{i}" for i in range(200))
    other = " ".join(f"other{i * 13 % 89}y{i}" for i in range(200))
    near = text.replace("word0x0 ", "changed ")
    rows = [(5, text, "en", "a", 1), (3, text.replace(" ", "\n", 3), "en", "a", 1), (9, near, "en", "a", 1), (7, other, "en", "b", 1), (8, "too short", "en", "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES[:3]:
        df = stage(spark, df, "unused")
    ids = sorted(r.doc_id for r in df.collect())
    assert ids in ([3, 7], [3, 7, 9]) and (9 in ids) == ((test_simhash.fingerprint(near) ^ test_simhash.fingerprint(text)).bit_count() > 4)
