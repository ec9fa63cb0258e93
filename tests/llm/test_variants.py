import random
import re
import zlib
from collections import Counter

import pytest

from repolens.llm import variants as V
from .data import empty, odd, odd_rows


def one_edit(x, y):
    if len(x) < len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(x) == len(y) + 1 and any(x[:i] + x[i + 1:] == y for i in range(len(x)))


def brute(counts, times=10):
    """(word, form, root, n, n_near, form_n) over all pairs."""
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def words_of(rows, every=31, least=7, times=2):
    seen = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= least and n >= times}


def result(spark, counts, **more):
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return sorted(map(tuple, V.variants(vocab, **more).collect()))


def random_words(rng, n, letters, low, high):
    out = {}
    for _ in range(n):
        w = "".join(rng.choice(letters) for _ in range(rng.randrange(low, high)))
        out[w] = rng.choice([1, 2, 3, 30, 400, 5000])
    return out


@pytest.mark.parametrize("letters,low,high,most", [("ab", 1, 7, 3), ("ab", 5, 9, 1), ("abc", 7, 9, 4), ("abcé", 2, 6, V.MOST_WORDS), ("a", 1, 30, 2)])
def test_brute_force_and_partitions_dealt_again(spark, letters, low, high, most):
    counts = random_words(random.Random(low * most), 150, letters, low, high)
    want = brute(counts)
    assert result(spark, counts, most=most) == want
    vocab = spark.createDataFrame(list(counts.items()), "word string, n long")
    pairs = [tuple(r) for r in V.near_pairs(vocab, most).collect()]
    assert len(pairs) == len(set(pairs)) and sum(r[4] for r in want) == 2 * len(pairs)
    assert all(one_edit(a, b) and (len(a) > len(b) or len(a) == len(b) and a < b) for a, b in pairs)


def test_acceptor_is_minimal_and_accepts_its_words():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(6)) for _ in range(40)})
    machine = V.Acceptor()
    start = machine.state(words, 0, len(words), 0)
    assert sorted(machine.language(start)) == words and all(machine.accepts(start, w) for w in words)
    assert not machine.accepts(start, words[0][:-1]) and not machine.accepts(start, words[0] + "a")
    languages = [tuple(machine.language(i)) for i in range(len(machine.arcs))]
    assert len(languages) == len(set(languages))


def test_chains_and_ties(spark):
    counts = {"aaaaaaa": 10 ** 9, "aaaaaab": 10 ** 8, "aaaaabb": 10 ** 7, "aaaabbb": 10 ** 6, "aaabbbb": 10, "zzzzzzz": 10, "zzzzzzy": 100, "zzzzzzx": 100, "alone": 1}
    got = {r[0]: r for r in result(spark, counts)}
    assert got["aaaabbb"][2] == got["aaabbbb"][2] == "aaaaaaa" and got["zzzzzzz"][1] == "zzzzzzx" and got["alone"][1:3] == (None, "alone")
    assert sorted(got.values()) == brute(counts)


def test_words_of_documents(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["Wortlaut", "wortlaut", "ÄPFELCHEN", "äPFELCHEN", "short", "a", "mid7word", "×÷×÷×÷×", "straßenbahn!straßenbahn"]) for _ in range(50))) for i in range(60)]
    for rows in (rows, [r[:2] for r in odd_rows()]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert {r.word: r.n for r in V.document_words(df).collect()} == words_of(rows)
    assert {r.word: r.n for r in V.document_words(odd(spark)).collect()} == words_of([r[:2] for r in odd_rows()])


def test_empty_tables(spark):
    assert V.document_words(empty(spark)).collect() == []
    none = spark.createDataFrame([], "word string, n long")
    assert V.variants(none).collect() == [] and V.near_pairs(none).collect() == []
