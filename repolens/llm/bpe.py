"""BPE encoding and decoding with a public tokenizer file.

The file's steps are applied as it lists them: special strings, NFC, white space to one blank, lower
case, the word pattern, bytes as printable characters, merges. A word is merged with a priority queue
of merge ranks over a doubly linked list of symbols: the queue may hold entries whose symbols have since
been merged away; those are skipped. Decoding concatenates the vocabulary's strings with the separator
of the file's decoder (a blank where it has none).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from repolens.llm.common import col, keyed_text, texts_of

#: Words whose tokens a worker remembers; beyond it the older half is forgotten and encoded anew.
CACHE_WORDS = 320_000
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
TEXT_BYTES = 1 << 20


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 itself, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def merge_word(symbols: list[int], merges: dict[int, int]) -> list[int]:
    """Merge the pair of lowest rank, leftmost first, until no pair of neighbours can be merged.

    ``merges``: left << ID_BITS | right -> rank << ID_BITS | merged. A queue entry is rank << 32 | place of
    the left symbol; it is stale once that place no longer begins a pair of that rank.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    find = merges.get
    queue = [m >> ID_BITS << 32 | i for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if (m := find(a << ID_BITS | b)) is not None]
    heapq.heapify(queue)
    while queue:
        entry = heapq.heappop(queue)
        i = entry & 0xFFFFFFFF
        j = after[i]
        if j >= n or symbols[i] < 0:
            continue  # stale: merged into its left neighbour, or nothing follows any more
        m = find(symbols[i] << ID_BITS | symbols[j])
        if m is None or m >> ID_BITS != entry >> 32:
            continue  # stale: one of the two has grown since
        symbols[i], symbols[j] = m & ID_MASK, -1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (m := find(symbols[i] << ID_BITS | symbols[k])) is not None:
                heapq.heappush(queue, m >> ID_BITS << 32 | i)
        h = before[i]
        if h >= 0 and (m := find(symbols[h] << ID_BITS | symbols[i])) is not None:
            heapq.heappush(queue, m >> ID_BITS << 32 | h)
    return [s for s in symbols if s >= 0]


class NewerLetter(ValueError):
    """A word holds a character of :func:`newer_letters`."""


@cache
def newer_letters() -> frozenset[str]:
    """Letters and numbers of ``regex`` that Python's own Unicode table lacks.

    The tokenizers library may class them otherwise, or know their lower case; it agrees on all other characters.
    """
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")


class WordBpe:
    """A tokenizer file of kind BPE with word ends, read once per worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.merges = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.merges[self.vocab[a] << ID_BITS | self.vocab[b]] = rank << ID_BITS | self.vocab[a + b]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern).findall
        # for texts with newer letters: the library's own lower case and classes
        self.newer = newer_letters()
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str
        self.split = pre_tokenizers.Split(Regex(pattern), "removed", invert=True).pre_tokenize_str
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        letters = byte_letters()
        # ids of a byte inside a word and at its end; -1 for a symbol that the file lacks
        self.inner = [self.vocab.get(c, -1) for c in letters]
        self.last = [self.vocab.get(c + self.end, -1) for c in letters]
        self.cache: dict[str, tuple[int, str, str]] = {}
        self.older: dict[str, tuple[int, str, str]] = {}

    def word_ids(self, word: str) -> list[int]:
        """Token ids of one word of the pattern. Symbols without an id are left out, as there is no unknown token."""
        data = word.encode("utf-8")
        symbols = [self.inner[b] for b in data[:-1]]
        symbols.append(self.last[data[-1]])
        return merge_word([s for s in symbols if s >= 0], self.merges)

    def word(self, word: str) -> tuple[int, str, str]:
        """(number of tokens, ids joined by a blank, strings joined by a blank), remembered."""
        found = self.cache.get(word) or self.older.get(word)
        if found is None:
            ids = self.word_ids(word)
            found = (len(ids), " ".join(map(str, ids)), self.decode(ids))
        if len(word) <= 64 and not self.has_newer(word):
            if len(self.cache) >= CACHE_WORDS // 2:
                self.cache, self.older = {}, self.cache
            self.cache[word] = found
        return found

    def has_newer(self, text: str) -> bool:
        return not text.isascii() and not self.newer.isdisjoint(text)

    def checked(self, word: str) -> tuple[int, str, str]:
        """``word()`` of what the fast pattern found; such words are never remembered, so each comes by here."""
        if self.has_newer(word):
            raise NewerLetter(word)
        return self.word(word)

    @staticmethod
    def lower(text: str) -> str:
        """NFC, then each character's own lower case (sigma has no final form here)."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3").lower()

    def pieces(self, text: str):
        """Words of the text in order; a special string is one piece, marked by its id."""
        for part in self.cut.split(text) if any(s in text for s in self.special) else (text,):
            if (i := self.special.get(part)) is not None:
                yield i
            elif self.has_newer(part):
                yield from (part[a:b] for part in [self.normal(part)] for _, (a, b) in self.split(part))
            elif part:
                # white space is dropped by the pattern, so one blank or several make no difference
                yield from self.words(self.lower(part))

    def encode(self, text: str) -> list[int]:
        return [i for p in self.pieces(text) for i in ((p,) if isinstance(p, int) else self.word_ids(p))]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.strings[i] for i in ids if i in self.strings])

    def digest(self, text: str) -> tuple[int, str, str]:
        """(number of tokens, ids joined by a blank, decoded text) through the remembered words."""
        known, slow = self.cache.get, self.checked
        try:
            found = None if any(s in text for s in self.special) else [known(w) or slow(w) for w in self.words(self.lower(text))]
        except NewerLetter:
            found = None
        if found is None:
            found = [(1, str(p), self.strings[p]) if isinstance(p, int) else self.word(p) for p in self.pieces(text)]
        n, ids, decoded = zip(*found) if found else ((), (), ())
        if 0 in n:  # words none of whose bytes the file has
            return sum(n), " ".join(filter(None, ids)), " ".join(d for d, k in zip(decoded, n) if k)
        return sum(n), " ".join(ids), " ".join(decoded)


_LOADED: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def _per_text(df: DataFrame, id_col: str, text_col: str, fields: list[T.StructField], make) -> DataFrame:
    src = keyed_text(df, id_col, text_col)
    schema = T.StructType([src.schema["id"], *fields])

    def run(batches):
        for b in batches:
            rows, last = [], None
            for _, texts in texts_of(b.column(1), TEXT_BYTES):
                for t in texts:  # copies that a mix took stand side by side: made once
                    rows.append(rows[-1] if t == last else make(t.decode("utf-8", "replace")))
                    last = t
            cols = list(zip(*rows)) if rows else [()] * len(fields)
            kinds = {"bigint": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, kinds[f.dataType.simpleString()]) for c, f in zip(cols, fields))], names=schema.names)

    return src.mapInArrow(run, schema)


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): whole texts; null and empty texts have no tokens. ``path`` lies on every machine."""
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    return _per_text(df, id_col, text_col, fields, lambda t: (tokenizer(path).encode(t),))


def decode_ids(df: DataFrame, path: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of (id, ids) rows, special tokens included; ids that the file lacks are left out, null counts as none."""
    src = df.select(col(id_col).alias("id"), col(ids_col).cast("array<int>").alias("ids"))
    schema = T.StructType([src.schema["id"], T.StructField("text", T.StringType())])

    def run(batches):
        for b in batches:
            texts = [tokenizer(path).decode(ids or []) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=schema.names)

    return src.mapInArrow(run, schema)


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of the ids and of the text decoded from them.

    One row per input row, repeated rows and null ids included; null text counts as empty. The decoded
    text of a document is the concatenation of its words' decoded strings, as decode() gives for all ids.
    """
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]

    def make(text: str):
        n, ids, decoded = tokenizer(path).digest(text)
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode("utf-8")).hexdigest()

    return _per_text(df, id_col, text_col, fields, make)
