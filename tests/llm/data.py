"""Small tables shared by the tests: odd rows that every operator must take, and random prose."""

import random

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(20_000))
ODD_TEXTS = [None, "", " ", "\n\t\n", "one", "two words", "Anna said so", "x" * 30_000, LONG, LONG, "same text here", "same  text\there", "same text here",
             "žluťoučký kůň 日本語 🙂 é", "<|endoftext|> ### User: </turn> \\ #", "a a a a a a a a", "1234"]
SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # names that the operators use inside
                       *(T.StructField(n, T.StringType()) for n in ("id", "fp", "kept", "keep_id", "size", "row", "own", "dropped_id", "mix_id", "component_id"))])


def odd_rows():
    """Null ids, null sources, repeated rows, repeated ids with other texts, every text of ODD_TEXTS."""
    rows = [(i, t, "en", f"s{i % 3}" if i % 5 else None, len(t or ""), *["z"] * 10) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[3], rows[8], (None, "no id", None, None, None, *[None] * 10), (None, "no id", None, None, None, *[None] * 10),
             (None, "same text here", "en", "s1", 3, *["z"] * 10), (4, "an id again, other text", "en", "s1", 3, *["z"] * 10)]
    return rows


def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice(['', '', '.', ','])}" for _ in range(words))


def frame(spark, texts, first=0):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts, first)], "doc_id long, text string")
