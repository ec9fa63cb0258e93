import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from repolens.llm import trie as R

SCHEMA = "conv_id long, turn long, role string, text string, id string, depth int, path string"


def brute(rows, span=100):
    """Every node of the trie of rebuilt conversations, from all prefixes in a dict."""
    own = defaultdict(list)
    for c, turn, role, text in (r[:4] for r in rows):
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, name, role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    talks = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        head = c - (c % span if c >= 0 else -(-c % span))
        talks[c] = own.get(head, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in talks.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(cs) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(talks[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, **more):
    df = spark.createDataFrame([(*r[:4], "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, R.prefix_trie(R.rebuilt(R.sequences(df)), **more).collect()), key=str)


def talks(rng, n, turns, texts):
    return [(c, t, rng.choice(["user", "assistant"]), rng.choice(texts)) for c in range(n) for t in range(rng.randrange(1, turns))]


@pytest.mark.parametrize("run_bytes", [1, 40, 400, R.RUN_BYTES])
def test_brute_force_in_runs_of_any_size(spark, run_bytes):
    rng = random.Random(run_bytes)
    rows = talks(rng, 230, 9, ["a", "bb", "", "ccc é"])
    rows += [(c, t, "user", "all the same") for c in range(300, 340) for t in range(3)]
    assert result(spark, rows, run_bytes=run_bytes) == brute(rows)


def test_nodes_grow_through_all_layouts():
    rng = random.Random(1)
    keys = sorted({bytes(rng.randrange(256) for _ in range(16)) * rng.randrange(1, 4) for _ in range(3000)} | {bytes([i]) + bytes(15) for i in range(256)})
    root = R.Node(b"")
    for i, key in rng.sample(list(enumerate(keys)), len(keys)):
        R.insert(root, key, i)
    found, layouts, stack = [], set(), [(root, b"")]
    while stack:
        node, at = stack.pop()
        layouts.add(node.layout)
        if node.end is not None:
            assert keys[node.end] == at
            found.append(node.end)
        kids = [(b, node.child(b)) for b in range(256) if node.child(b) is not None]
        assert [k for _, k in kids] == node.ordered() and (len(kids) != 1 or node.end is not None or node is root)
        stack += [(k, at + bytes([b]) + k.path) for b, k in kids]
    assert sorted(found) == list(range(len(keys))) and {4, 16, 256} <= layouts
    few = R.Node(b"")
    for i in range(40):
        R.insert(few, bytes([i]) + bytes(15), i)
    assert few.layout == 48 and [k.end for k in few.ordered()] == list(range(40))


def test_one_long_and_many_equal_conversations(spark):
    rows = [(7, t, "user", f"turn {t % 50}") for t in range(200)] + [(8, t, "user", f"turn {t % 50}") for t in range(199)]
    rows += [(c, t, "user", f"turn {t}") for c in range(100, 400) for t in range(2)]
    assert result(spark, rows, run_bytes=1000) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (None, None, None, None), (1, 1, "assistant", "same"), (1, 1, "assistant", "same"), (2, 0, "system", "only"), (2, None, None, None),
            (2, None, "", ""), (0, 5, "u", "ab"), (0, 5, "ua", "b"), (3, 4, "assistant", "long " * 3000), (101, 0, "user", "no head"), (-7, 0, "user", "x"), (-7, 1, "user", "y"), (2 ** 62, 1, "u", "far")]
    assert result(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert result(spark, []) == [] and result(spark, [(None, 1, "user", "x")]) == []
