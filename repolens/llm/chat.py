"""Chat formatting in budgeted windows.

Prefix sums of turn tokens say where each turn begins in its conversation. They are summed in blocks of
turns, so a conversation of any length is spread over many tasks. The token axis is cut into stripes as
long as a window's room for new turns; a turn belongs to the stripe in which it begins, and within a
stripe windows take whole turns while they fit. Every window starts with the system turn and with as many
of the turns just before it as the history allows; only its own new assistant turns are trained on, so a
repeated turn is masked. Every turn is new in exactly one window.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import col

#: Turn numbers of a block that one window function sums.
BLOCK = 1024
#: Tokens that a turn's marks count; also the least a turn can have.
MARKS = 4
#: Room for new turns that is kept however long the system turn is.
LEAST_ROOM = 128
ASSISTANT, SYSTEM = "assistant", "system"
ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c", "\n": "\\n"}
PLAIN = {v[1]: k for k, v in ESCAPES.items()}
_TEXT, _ROLE, _BACK = re.compile(r"[\\#<]"), re.compile(r"[\\#<:\n]"), re.compile(r"\\(.)", re.S)
END = "</turn>\n"


def escape(text: str, role: bool = False) -> str:
    """No mark of the template occurs in the result; ``unescape`` gives the text back."""
    return (_ROLE if role else _TEXT).sub(lambda m: ESCAPES[m[0]], text)


def unescape(text: str) -> str:
    return _BACK.sub(lambda m: PLAIN[m[1]], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where its text begins and ends in it."""
    head, body = f"### {escape(role, True)}: ", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(window: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted window."""
    turns = []
    for piece in window.split(END)[:-1]:
        role, _, text = piece.removeprefix("### ").partition(": ")
        turns.append((unescape(role), unescape(text)))
    return turns


def placed_turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, budget: int, history: int) -> DataFrame:
    """(conv, stripe, part_of, idx, role, text, tokens, before, room, keep): where each turn goes."""
    rows = df.select(col(conv_col).alias("conv"), col(turn_col).cast("long").alias("turn"),
                     F.coalesce(col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tokens", F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long") + MARKS)
    rows = rows.withColumn("blk", F.floor(F.col("turn") / BLOCK))
    inner = Window.partitionBy("conv", "blk").orderBy("turn", "role", "text")
    rows = rows.withColumn("n_in", F.row_number().over(inner)).withColumn(
        "t_in", F.coalesce(F.sum("tokens").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row a block: a block's turns and tokens before it
    outer = Window.partitionBy("conv").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv", "blk").agg(F.count("*").alias("n"), F.sum("tokens").alias("t")).select(
        F.col("conv").alias("c"), F.col("blk").alias("b"), F.coalesce(F.sum("n").over(outer), F.lit(0)).alias("n_before"), F.coalesce(F.sum("t").over(outer), F.lit(0)).alias("t_before"))
    rows = rows.join(blocks, F.col("conv").eqNullSafe(F.col("c")) & F.col("blk").eqNullSafe(F.col("b"))).select(
        "conv", (F.col("n_before") + F.col("n_in")).alias("idx"), "role", "text", "tokens", (F.col("t_before") + F.col("t_in")).alias("at"))
    first = rows.where((F.col("idx") == 1) & (F.col("role") == SYSTEM)).select(F.col("conv").alias("c"), F.col("text").alias("system"), F.col("tokens").alias("s_tokens"))
    rows = rows.join(first, F.col("conv").eqNullSafe(F.col("c")), "left").drop("c").withColumn("s_tokens", F.coalesce("s_tokens", F.lit(0)))
    room = F.greatest(F.lit(budget - history) - F.col("s_tokens"), F.lit(max(LEAST_ROOM, min(history, budget))))
    rows = rows.withColumn("room", room).withColumn("at", F.greatest(F.col("at") - F.col("s_tokens"), F.lit(0))).withColumn("stripe", F.floor(F.col("at") / F.col("room")))
    own, later = F.struct(F.col("stripe"), F.lit(False).alias("old")), F.struct((F.col("stripe") + 1).alias("stripe"), F.lit(True).alias("old"))
    is_first = F.col("system").isNotNull() & (F.col("idx") == 1)
    reaches = ~is_first & (F.col("at") >= (F.col("stripe") + 1) * F.col("room") - history)
    return rows.withColumn("x", F.explode(F.when(reaches, F.array(own, later)).otherwise(F.array(own)))).select(
        "conv", F.col("x.stripe").alias("stripe"), "idx", F.col("x.old").alias("old"), "role", "text", "tokens", "at", "room", "system", is_first.alias("is_first"))


def _stripe_windows(rows: list[tuple], history: int):
    """(repeated, turns) of a stripe's windows; rows: (idx, old, role, text, tokens, at, room, system, is_first)."""
    earlier: list[tuple] = []  # turns before the window, for its history
    window: list[tuple] = []
    fixed = [r for r in rows if r[8]]
    system = rows[0][7]
    used = 0

    def done():
        start = window[0][5]
        old = [r for r in earlier if r[5] >= start - history]
        lead = list(fixed) if fixed else [] if system is None else [(0, True, SYSTEM, system)]
        # the system turn is new in the conversation's first window only
        new_system = bool(fixed)
        fixed.clear()
        return len(lead) + len(old) - new_system, new_system, [*lead, *old, *window]

    for r in rows:
        if r[8]:
            continue
        if r[1]:
            earlier.append(r)
            continue
        if window and used + r[4] > r[6]:
            yield done()
            earlier += window
            window, used = [], 0
        window.append(r)
        used += r[4]
    if window:
        yield done()
    elif fixed:  # a conversation of its system turn alone
        yield 0, True, list(fixed)


def windows(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
            budget: int = 1024, history: int = 256) -> DataFrame:
    """(conv, stripe, part, text, new_system, repeated, n_turns, loss): formatted windows of all conversations.

    ``repeated`` turns at the window's begin (after a new system turn) are history or the retained system
    turn; ``loss`` holds the (begin, end) code points trained on. A window has at most ``budget`` tokens
    unless one turn, or the system turn, is too long by itself: turns are never cut. Null roles and texts
    count as empty, null turns come first, equal turn numbers go by role and text, repeated rows are
    turns like others; rows with a null conversation form one. No rows give no windows.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be at least 0 and less than the budget")
    rows = placed_turns(df, conv_col, turn_col, role_col, text_col, budget, history)
    names = ["idx", "old", "role", "text", "tokens", "at", "room", "system", "is_first"]
    rows = rows.repartition("conv", "stripe").sortWithinPartitions("conv", "stripe", "idx").select("conv", "stripe", *names)
    span = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([rows.schema["conv"], T.StructField("stripe", T.LongType()), T.StructField("part", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("new_system", T.BooleanType()), T.StructField("repeated", T.LongType()), T.StructField("n_turns", T.LongType()), T.StructField("loss", span)])
    kinds = [None, pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]

    def of_stripe(key, group):
        for part, (repeated, new_system, turns) in enumerate(_stripe_windows(group, history)):
            text, loss, at = [], [], 0
            for i, t in enumerate(turns):
                piece, a, b = render(t[2], t[3])
                if t[2] == ASSISTANT and i >= repeated + new_system:
                    loss.append({"begin": at + a, "end": at + b})
                text.append(piece)
                at += len(piece)
            yield (*key, part, "".join(text), new_system, repeated, len(turns), loss)

    def run(batches):
        key, group, kind = None, [], None
        for b in batches:
            kind = b.column(0).type
            out = []
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if row[:2] != key:
                    if group:
                        out += of_stripe(key, group)
                    key, group = row[:2], []
                group.append(row[2:])
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k or kind) for c, k in zip(zip(*out), kinds)], names=schema.names)
        if group and (out := list(of_stripe(key, group))):
            yield pa.RecordBatch.from_arrays([pa.array(c, k or kind) for c, k in zip(zip(*out), kinds)], names=schema.names)

    return rows.mapInArrow(run, schema)


def read_back(made: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the formatted windows alone.

    The digests are over a whole conversation in order, so its windows pass through one task, one at a time.
    """
    schema = T.StructType([made.schema["conv"], T.StructField("n_turns", T.LongType()), T.StructField("turns_sha256", T.StringType()),
                           T.StructField("loss_chars", T.LongType()), T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType())])
    rows = made.repartition("conv").sortWithinPartitions("conv", "stripe", "part").select("conv", "text", "new_system", "repeated", "loss")

    def run(batches):
        key, state, kind = None, None, None

        def closed():
            return key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

        def packed(out):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()))], names=schema.names)

        for b in batches:
            kind, out = b.column(0).type, []
            for conv, text, new_system, repeated, loss in zip(*(c.to_pylist() for c in b.columns)):
                if state is None or conv != key:
                    if state is not None:
                        out.append(closed())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                turns = parse(text)
                for role, said in (turns[:1] if new_system else []) + turns[repeated + new_system:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8"))
                for s in loss:
                    said = unescape(text[s["begin"]:s["end"]])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8"))
                state[4] += len(text)
            if out:
                yield packed(out)
        if state is not None:
            yield packed([closed()])

    return rows.mapInArrow(run, schema)
