import re
from collections import Counter

from repolens.llm import quality as Q
from tests.llm.data import empty, frame, odd, odd_rows


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = Counter(zip(words, words[1:], words[2:]))
    rep = {i + k for i in range(len(words) - 2) if seen[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), len(lines), len(re.findall("[A-Z]", t)))


def test_measurements_equal_brute_force(spark):
    texts = [r[1] for r in odd_rows()] + ["a b c a b c a b", "x\nx\n \nx", "A#B|c <d> $", "a b a b a", "q w e r q w e"]
    df = frame(spark, texts)
    got = {r.id: tuple(r)[1:] for r in Q.measurements(df).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_many_distinct_words_use_the_pair_numbers(monkeypatch):
    words = [b"%d" % i for i in range((1 << 20) + 10)] + [b"1", b"2", b"3"]
    assert Q.repeated_words(words) == 6


def test_policies_and_ablations(spark):
    good = " ".join(f"word{i}" for i in range(80))
    df = frame(spark, [good, "short", " ".join(["again"] * 80), good.upper(), "# " * 60 + good, "\n".join(["a line of words that repeats " + good[:60]] * 9), None])
    book = Q.ledger(df)
    rows = {r.id: r for r in book.withColumn("base", Q.passes("base")).withColumn("v2", Q.passes("v2")).collect()}
    assert [i for i, r in sorted(rows.items()) if r.v2] == [0]
    assert [i for i, r in sorted(rows.items()) if r.base] == [0, 3, 4]
    table = {(r.policy, r.rule): r for r in Q.ablations(book).collect()}
    for (policy, rule), r in table.items():
        bit = 1 << next(x.bit for x in Q.RULES if x.name == rule)
        fails = [x.fail_bits & Q.mask_of(policy) for x in rows.values()]
        assert (r.kept, r.kept_without, r.only_rule) == (fails.count(0), sum(f & ~bit == 0 for f in fails), fails.count(bit))
    assert len(table) == sum(map(len, Q.POLICIES.values()))


def test_odd_rows_and_columns(spark):
    df = odd(spark)
    assert Q.ledger(df).count() == df.count()
    out = Q.quality_filter(df)
    assert out.schema == df.schema and Q.ledger(empty(spark)).collect() == [] and Q.quality_filter(empty(spark)).collect() == []
    assert {r.text for r in out.collect()} == {r[1] for r in odd_rows() if (m := brute(r[1]))[0] >= 50 and 2 * m[4] <= m[0]}


def test_labelled_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    x = Q.ledger(docs).withColumn("kept", Q.passes("v2")).join(labels, Q.F.col("id") == labels["doc_id"])
    rows = x.where("n_words >= 50").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in rows}
    assert n.get((1, False), 0) <= 0.01 * n[1, True] and n.get((0, True), 0) <= 0.01 * n[0, False]
