import hashlib
import random
from collections import defaultdict

import pytest

from repolens.llm import chat as C
from tests.llm.data import prose

SCHEMA = "conv_id long, turn long, role string, text string"


def talks(seed=1, convs=25):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        turn = 0
        if rng.random() < 0.5:
            rows.append((c, turn, "system", prose(rng, rng.randrange(1, 30))))
            turn += 1
        for _ in range(rng.choice([0, 1, 3, 8, 40])):
            for role in ("user", "assistant"):
                rows.append((c, turn, role, rng.choice([None, "", r"\### Assistant: </turn> ok", prose(rng, rng.randrange(1, 60)), "a\nb\\h\\"])))
                turn += rng.choice([1, 1, 1, 700])
    return rows


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for c, turns in by.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(r[3] or "" for r in turns if r[2] == "assistant")
        digest = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in turns).encode()).hexdigest()
        out[c] = (len(turns), digest, len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history,block", [(1024, 256, 1024), (200, 50, 4), (150, 0, 1), (300, 140, 7)])
def test_round_trip_budget_and_masks(spark, monkeypatch, budget, history, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rows = talks()
    made = C.windows(spark.createDataFrame(rows, SCHEMA).repartition(4), budget=budget, history=history).cache()
    assert {r.conv: tuple(r)[1:5] for r in C.read_back(made).collect()} == expected(rows)
    cost = lambda t: len(t[1].split()) + C.MARKS
    system = {r[0]: r[3] for r in rows if r[2] == "system"}
    last = {}
    for w in sorted(made.collect(), key=lambda w: (w.conv, w.stripe, w.part)):
        turns = C.parse(w.text)
        assert len(turns) == w.n_turns
        fresh = turns[w.repeated + w.new_system:]
        if w.conv in system:
            assert turns[0] == ("system", system[w.conv])
        s = cost(turns[0]) if w.conv in system else 0
        old = turns[bool(s):w.repeated + w.new_system]
        assert sum(map(cost, old)) <= history
        room = max(budget - history - s, C.LEAST_ROOM, min(history, budget))
        assert sum(map(cost, fresh)) <= room or len(fresh) == 1
        if old:  # history is what came just before
            assert last[w.conv][-len(old):] == old
        targets = [t for r, t in fresh if r == "assistant"]
        assert [C.unescape(w.text[x["begin"]:x["end"]]) for x in w.loss] == targets
        last[w.conv] = last.get(w.conv, []) + fresh
    if budget < 400:
        assert made.where("part > 0 or stripe > 0").count() and (not history or made.where("repeated > 1").count())


def test_escapes_are_reversible_and_hide_the_marks():
    rng = random.Random(2)
    for _ in range(500):
        role, text = ("".join(rng.choice("\\#<h l:cn\n/turn>x") for _ in range(rng.randrange(20))) for _ in range(2))
        piece, a, b = C.render(role, text)
        assert C.parse(piece + C.render("user", "x")[0]) == [(role, text), ("user", "x")]
        assert C.unescape(piece[a:b]) == text and "</turn>" not in piece[a:b] and "#" not in piece[a:b]


def test_one_long_conversation(spark):
    rng = random.Random(3)
    rows = [(5, t, ("user", "assistant")[t % 2], prose(rng, rng.randrange(1, 20))) for t in range(6000)]
    made = C.windows(spark.createDataFrame(rows, SCHEMA), budget=256, history=64)
    assert {r.conv: tuple(r)[1:5] for r in C.read_back(made).collect()} == expected(rows)


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (None, None, None, None), (1, 1, "assistant", "same"), (1, 1, "assistant", "same"), (2, 0, "system", "only"),
            (3, 4, "assistant", "long " * 3000), (3, 5, "system", "late"), (4, -3, "we:ird\n#", "t"), (4, 2**62, "assistant", "far")]
    made = C.windows(spark.createDataFrame(rows, SCHEMA))
    assert {r.conv: tuple(r)[1:5] for r in C.read_back(made).collect()} == expected(rows)
    assert C.windows(spark.createDataFrame([], SCHEMA)).collect() == [] and C.read_back(C.windows(spark.createDataFrame([], SCHEMA))).collect() == []
    with pytest.raises(ValueError):
        C.windows(spark.createDataFrame([], SCHEMA), budget=10, history=10)
