"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text; the ledger stores the measurements and one bit per failed rule.
Policies are named versions of a bit mask over those rules: applying one, comparing two or asking what a
single rule costs (ablation) reads the ledger's bits alone, never the texts again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import keyed_text, texts_of

SYMBOLS = b"#*$%&|<>"
NOT_SYMBOL = bytes(i for i in range(256) if i not in SYMBOLS)
NOT_UPPER = bytes(i for i in range(256) if not 0x41 <= i <= 0x5A)
# continuation bytes of UTF-8 and white space don't count as characters of words
NOT_COUNTED = bytes([0x20, *range(0x09, 0x0E), *range(0x80, 0xC0)])
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` is its fixed place in the ledger."""
    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", 3, "10 * n_dup_lines > 4 * n_lines"),
    Rule("upper_case", 4, "10 * n_upper > 3 * word_chars"),
    Rule("long_words", 5, "word_chars > 12 * n_words"),
    Rule("short_words", 6, "word_chars < 2 * n_words"),
)
#: Versions are never changed, only added.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": ("few_words", "repeated_words", "symbols", "repeated_lines", "upper_case", "long_words", "short_words"),
}


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three words that the text holds twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    at = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) < 1 << 20:
        window = (at[:-2] << 40) + (at[1:-1] << 20) + at[2:]
    else:  # three numbers don't fit in 64 bits: number the pairs first
        pair = np.unique((at[:-1] << 32) + at[1:], return_inverse=True)[1]
        window = (pair[:-1].astype(np.int64) << 31) + at[2:]
    order = np.argsort(window, kind="stable")
    same = window[order[1:]] == window[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    covered = twice.copy()
    covered[1:] |= twice[:-1]
    covered[2:] |= twice[:-2]
    return int(covered.sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The MEASURES of one text."""
    words = text.split()
    lines = dup = 0
    seen: set[bytes] = set()
    for line in text.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    return (len(words), len(text.translate(None, NOT_COUNTED)), len(text.translate(None, NOT_SYMBOL)), dup,
            repeated_words(words), lines, len(text.translate(None, NOT_UPPER)))


def _table(texts: pa.Array) -> list[pa.Array]:
    found = [measure(t) for _, run in texts_of(texts) for t in run]
    table = np.array(found, np.int64).reshape(-1, len(MEASURES))
    return [pa.array(table[:, i]) for i in range(len(MEASURES))]


def measurements(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, MEASURES...) of every whole text in one pass; a null or empty text measures 0 everywhere."""
    src = keyed_text(df, id_col, text_col)
    schema = T.StructType([src.schema["id"], *(T.StructField(m, T.LongType()) for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *_table(b.column(1))], names=schema.names)

    return src.mapInArrow(run, schema)


def failure_bits(rules: tuple[Rule, ...] = RULES) -> Column:
    out = F.lit(0).cast("long")
    for r in rules:
        out = out + F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(0)
    return out


def mask_of(policy: str, rules: tuple[Rule, ...] = RULES) -> int:
    bit = {r.name: 1 << r.bit for r in rules}
    return sum(bit[name] for name in POLICIES[policy])


def ledger(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, MEASURES..., fail_bits): one row per input row, repeated rows and null ids included."""
    return measurements(df, id_col, text_col).withColumn("fail_bits", failure_bits(rules))


def passes(policy: str, bits: str = "fail_bits") -> Column:
    return F.col(bits).bitwiseAND(F.lit(mask_of(policy))) == 0


def ablations(book: DataFrame) -> DataFrame:
    """(policy, rule, kept, kept_without, only_rule): what each rule costs each policy.

    The ledger is reduced to its distinct bit masks first (at most two to the power of the number of
    rules), so no text or document is read again. ``only_rule`` counts rows that this rule alone rejects.
    """
    counts = book.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cases = [(p, r.name, mask_of(p), 1 << r.bit) for p, names in POLICIES.items() for r in RULES if r.name in names]
    rows = F.explode(F.array(*(F.struct(F.lit(p).alias("policy"), F.lit(r).alias("rule"), F.lit(m).alias("mask"), F.lit(b).alias("bit")) for p, r, m, b in cases)))
    x = counts.withColumn("x", rows).select("fail_bits", "n", "x.*")
    failed = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return x.groupBy("policy", "rule").agg(
        total(failed == 0).alias("kept"),
        total((failed == 0) | (failed == F.col("bit"))).alias("kept_without"),
        total(failed == F.col("bit")).alias("only_rule"))


def quality_filter(df: DataFrame, text_col: str = "text", policy: str = "v2", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that the policy keeps, with its own columns; each row is judged by its own text.

    Rows pass through the one measuring pass whole, so nothing is joined or shuffled.
    """
    src = df.select(F.struct(*("`" + c.replace("`", "``") + "`" for c in df.columns)).alias("row"))
    at = df.columns.index(text_col)
    schema = T.StructType([src.schema["row"], *(T.StructField(m, T.LongType()) for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(0).field(at).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column(0), *_table(texts)], names=schema.names)

    judged = src.mapInArrow(run, schema).withColumn("fail_bits", failure_bits(rules))
    return judged.where(passes(policy)).select("row.*")
