"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point alone. An n-gram is bound from the
vectors of its letters, each shifted by its place in the gram, by multiplying them; a text's vector bundles
(adds up) its n-grams. A language's prototype bundles the n-grams of its labelled texts, each text with the
same weight. A text gets the language whose prototype has the largest cosine with the text's vector.

Letters are those of Unicode, in lower case; marks (vowel signs) count as letters of a word, all else parts
words. N-grams stay inside a word and its two ends. Counts are exact integers, so no result depends on how rows are
dealt out.

Null texts, and texts without a letter, are ``und`` with score 0. Null labels teach nothing. Without any
labelled letter the prototypes are empty and every text is ``und``. Equal cosines: the smaller language name.
"""

from __future__ import annotations

from functools import cache
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import col, durable, keyed_text, steps

DIM = 1024
#: Languages a model may hold: it is DIM floats a language and travels to every task.
MOST_LANGS = 10_000
#: Documents and distinct n-grams that meet in one matrix product; bounds memory only.
DOCS_AT_ONCE, GRAMS_AT_ONCE = 1024, 4096
UNIT = 1 << 20
MASK = 0xFFFFFFFFFFFFFFFF


@cache
def symbols() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the symbol (lower case; 0 parts words), and whether it is a letter."""
    fold, letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            fold[i], letter[i] = ord(chr(i).lower()[0]), True
        elif kind == "M":
            fold[i] = i
    return fold, letter


def letter_vectors(codes: np.ndarray, dim: int) -> np.ndarray:
    """One row of +1 and -1 for each code point: the bits of a mixed counter (splitmix64), 64 places a draw."""
    with np.errstate(over="ignore"):
        z = codes.astype(np.uint64)[:, None] * np.uint64(1 << 20) + np.arange(1, dim // 64 + 1, dtype=np.uint64)
        z = z * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    bits = np.unpackbits(z.astype("<u8").view(np.uint8), axis=1, bitorder="little")
    return bits.astype(np.float32) * 2 - 1


def numbered(values: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values (under ``top``) in order, and the number of each value among them."""
    if top > 1 << 22:
        return np.unique(values, return_inverse=True)
    there = np.zeros(top, bool)
    there[values] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[values]


class Grams:
    """The n-grams (n at least 3) of a run of texts: ``doc`` and ``gram`` (a number into the distinct ones) of every occurrence."""

    def __init__(self, data: np.ndarray, at: np.ndarray, n: int):
        if n < 3:
            raise ValueError("n-grams have at least 3 symbols")
        fold, letter = symbols()
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        ends = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[at]
        docs = len(at) - 1
        marks = letter[points]
        seen = np.concatenate(([0], np.cumsum(marks)))
        self.has_letter = seen[ends[1:]] > seen[ends[:-1]]
        # one 0 before each text and after the last, then runs of 0 become one
        text = np.concatenate((np.insert(fold[points], ends[:-1], 0), np.zeros(1, np.uint32)))
        doc = np.concatenate((np.insert(np.repeat(np.arange(docs), np.diff(ends)), ends[:-1], np.arange(docs)), [docs - 1]))
        keep = text != 0
        keep[1:] |= text[:-1] != 0
        keep[0] = True
        text, doc = text[keep], doc[keep]
        self.codes, small = numbered(text, int(text.max()) + 1)
        k, m = len(self.codes), max(len(text) - n + 1, 0)
        inside = np.ones(m, bool)  # no word end but at the gram's own two ends
        for j in range(1, n - 1):
            inside &= text[j:j + m] != 0
        whole = np.zeros(m, np.int64)
        for j in range(n):
            whole = whole * k + small[j:j + m]
        self.doc = doc[1:1 + m][inside]
        distinct, self.gram = numbered(whole[inside], k ** n)
        self.places = np.stack([distinct // k ** (n - 1 - j) % k for j in range(n)])

    def bound(self, dim: int):
        """(first number, vectors) of the distinct grams, some at once: the product of their letters' shifted vectors."""
        letters = letter_vectors(self.codes, dim)
        n = len(self.places)
        shifted = [np.roll(letters, n - 1 - j, axis=1) for j in range(n)]
        for at in range(0, self.places.shape[1], GRAMS_AT_ONCE):
            part = self.places[:, at:at + GRAMS_AT_ONCE]
            vec = shifted[0][part[0]]
            for j in range(1, n):
                vec *= shifted[j][part[j]]
            yield at, vec

    def bundle(self, rows: np.ndarray, n_rows: int, dim: int, weight: np.ndarray | None = None) -> np.ndarray:
        """(n_rows, dim): the sum of the vectors of each row's grams, ``rows`` saying whose each occurrence is (-1: nobody's)."""
        out = np.zeros((n_rows, dim))
        kind = np.float32 if weight is None else np.float64
        for at, vec in self.bound(dim):
            own = (self.gram >= at) & (self.gram < at + len(vec)) & (rows >= 0)
            cell = rows[own] * len(vec) + self.gram[own] - at
            counts = np.bincount(cell, None if weight is None else weight[own], n_rows * len(vec))
            # exact: float32 up to 2^24 of one gram in one text, beyond that float64
            use = kind if counts.max(initial=0) * len(vec) < 1 << 24 or weight is not None else np.float64
            out += counts.reshape(n_rows, -1).astype(use) @ vec.astype(use, copy=False)
        return out


def runs(texts: pa.Array):
    """(first row, end row, bytes, offsets) of whole texts, a bounded number at once."""
    for first, end, data, at in steps(texts):
        for a in range(0, end - first, DOCS_AT_ONCE):
            b = min(a + DOCS_AT_ONCE, end - first)
            yield first + a, first + b, data[at[a]:at[b]], at[a:b + 1] - at[a]


def learn(df: DataFrame, text_col: str = "text", lang_col: str = "lang", n: int = 3, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages in order of their names and their unit prototypes, from every row with a label.

    Each task adds up one vector a language; Spark adds those, so the driver only gets the sums (``dim`` numbers
    a language, at most ``MOST_LANGS`` of them).
    """
    src = df.where(col(lang_col).isNotNull()).select(col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"))
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("sums", T.ArrayType(T.LongType()))])

    def out(sums: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "sums"])

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for first, end, data, at in runs(b.column(1)):
                grams = Grams(data, at, n)
                names, which = np.unique(np.array(b.column(0).slice(first, end - first).to_pylist(), object), return_inverse=True)
                size = np.bincount(grams.doc, minlength=end - first)
                weight = np.rint(UNIT / np.maximum(size, 1))
                made = grams.bundle(which[grams.doc], len(names), dim, np.maximum(weight, 1)[grams.doc]).astype(np.int64)
                for name, vec in zip(names, made):
                    sums[name] = sums[name] + vec if name in sums else vec
                if len(sums) > 256:
                    yield out(sums)
                    sums = {}
        if sums:
            yield out(sums)

    parts = durable(src.mapInArrow(count, schema))
    if (found := parts.select("lang").distinct().limit(MOST_LANGS + 1).count()) > MOST_LANGS:
        raise ValueError(f"{lang_col} holds over {found - 1} values; it names no languages")
    rows = parts.select("lang", F.posexplode("sums").alias("at", "v")).groupBy("lang", "at").agg(F.sum("v").alias("v")).collect()
    langs = sorted({r["lang"] for r in rows})
    place = {name: i for i, name in enumerate(langs)}
    proto = np.zeros((len(langs), dim))
    for r in rows:
        proto[place[r["lang"]], r["at"]] = r["v"]
    size = np.sqrt((proto ** 2).sum(axis=1))
    known = size > 0  # a language all of whose texts have no letter has no profile
    return [name for name, k in zip(langs, known) if k], proto[known] / size[known][:, None]


def identify(df: DataFrame, model: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text", n: int = 3) -> DataFrame:
    """(id, lang_pred string, score double): the language of largest cosine and that cosine (0 where negative)."""
    langs, proto = model
    src = keyed_text(df, id_col, text_col)
    schema = T.StructType([src.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches):
        for b in batches:
            best, score = [], []
            for first, end, data, at in runs(b.column(1)):
                if not langs:
                    best += [-1] * (end - first)
                    score += [0.0] * (end - first)
                    continue
                grams = Grams(data, at, n)
                vec = grams.bundle(grams.doc, end - first, proto.shape[1])
                size = np.sqrt((vec ** 2).sum(axis=1))
                cos = vec @ proto.T / np.where(size, size, 1)[:, None]
                # equal but for the last bits counts as equal: the first name wins
                top = np.argmax(cos >= cos.max(axis=1, keepdims=True) - 1e-12, axis=1)
                found = np.clip(cos[np.arange(end - first), top], 0, 1)
                best += np.where(grams.has_letter, top, -1).tolist()
                score += np.where(grams.has_letter, found, 0.0).tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([langs[i] if i >= 0 else "und" for i in best], pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return src.mapInArrow(predict, schema)
