"""PII replacement by surrogates.

Entities are found in whole texts; each distinct one, brought to a canonical form, gets one surrogate of
its type: a keyed hash fills the entity's own shape, so digits stay digits of their script, letters keep
script and case, cards and IBANs keep their check digits right, given names keep gender. The table of all
distinct entities is checked: a surrogate that another entity has, or that is itself an entity of the
texts, is drawn again, so distinct entities stay distinct and equal ones equal everywhere.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from collections.abc import Iterator
from itertools import count

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import durable, keyed_text, slices, texts_of

# fixed values: titles and given names by gender
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Monsieur Madame Mme Mlle Señor Señora Sr Sra Don Doña Signor Signora Господин Госпожа Κύριος Κυρία".split()
MALE = ("James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven George Kenneth Andrew "
        "Peter Hans Klaus Jürgen Wolfgang Dieter Stefan Pierre Jean Michel Jacques François Louis José Juan Carlos Luis Miguel Pedro Pablo "
        "Иван Сергей Дмитрий Алексей Николай Γιώργος Νίκος Κώστας").split()
FEMALE = ("Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Lisa Sandra Ashley Emily Anna Emma Olivia "
          "Ursula Monika Petra Sabine Claudia Heike Marie Nathalie Isabelle Sylvie Camille María Carmen Ana Isabel Lucía Elena Rosa "
          "Анна Мария Елена Ольга Наталья Μαρία Ελένη Κατερίνα").split()
GENDER = {**{n: "male" for n in MALE}, **{n: "female" for n in FEMALE}}
#: Syllables and endings of made-up names, by script and gender (None: a surname).
SYLLABLES = {"LATIN": "ba be bi da de di fa fe ga go ka ke la le li lo ma me mi na ne no pa ra re ri ro sa se ta te ti va ve za".split(),
             "CYRILLIC": "ба бе ва ве га да де за ка ла ле ли ма ме на не по ра ре ро са се та те".split(),
             "GREEK": "βα βε γα δα δε ζα κα λα λε λι μα με να νε πα ρα ρε ρο σα σε τα τε".split()}
ENDINGS = {("LATIN", "male"): ["n", "rt", "s", "o"], ("LATIN", "female"): ["na", "ra", "lia", "tte"], ("LATIN", None): ["r", "nd", "x", "ss"],
           ("CYRILLIC", "male"): ["н", "р", "м", "й"], ("CYRILLIC", "female"): ["на", "ра", "ля", "ия"], ("CYRILLIC", None): ["ко", "ич", "юк", "ян"],
           ("GREEK", "male"): ["ος", "ης", "ας"], ("GREEK", "female"): ["νη", "ρα", "λια"], ("GREEK", None): ["κης", "λου", "δης"]}

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NUMBERS = re.compile("|".join((
    r"(?P<email>[\w.+%-]*[\w+%-]@[\w-]+(?:\.[\w-]+)+)",
    r"(?P<mac>\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b)",
    r"(?P<ipv4>(?<![\w.])" + OCTET + r"(?:\." + OCTET + r"){3}(?![\w]|\.\d))",
    r"(?P<ipv6>(?<![\w:])(?=[0-9A-Fa-f:]*::|(?:[0-9A-Fa-f]{1,4}:){7})[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![\w:]))",
    r"(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)",
    r"(?P<secret>\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_\w{36}|sk-[\w-]{20,}|eyJ[\w-]+\.[\w-]+\.[\w-]+|[0-9a-fA-F]{32,})\b)",
    r"(?P<card>(?<![\w.-])(?:\d{13,19}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}[ -]\d{6}[ -]\d{5})(?![\w-]))",
    r"(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))",
    r"(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?|\(\d{2,4}\)[ .-]?|\d{3}[ .-](?=\d{3}[ .-]\d{4}))\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?![\w]))",
)))
ASSIGNED = re.compile(r"\b(?:api[_-]?key|access[_-]?key|token|secret|password|passwd|pwd)\b[\"']?\s*[:=]\s*(?:\"([^\"\n]{6,})\"|'([^'\n]{6,})'|([^\s\"',;]{8,}))", re.I)
_CAP = r"[^\W\d_a-z]\w+"
# one group of literals first, so the scan stops at their first letters only; the rest is checked on a match
NAMES = re.compile(r"(?P<word>" + "|".join(sorted([*TITLES, *GENDER], key=len, reverse=True)) + r")(?P<dot>\.?)[ \u00a0](?:(?P<given>"
                   + "|".join(sorted(GENDER, key=len, reverse=True)) + r")[ \u00a0])?(?P<surname>" + _CAP + r"(?:-" + _CAP + r")?)\b")
HINT = re.compile(r"[\d@]")
#: What a pattern without a digit or @ begins with or holds.
MARKS = ("AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "eyJ", "::")
ASSIGNED_WORDS = ("key", "token", "secret", "passw", "pwd")
#: Characters looked at on either side of a digit or @, then on to the next white space.
MARGIN = 80

#: Draws that keep an entity's shape; later ones come from a space that grows with each draw, so no kind runs out.
SHAPED = 8

Entity = tuple[int, int, str, str]  # begin, end, type, canonical form


def digits_of(text: str) -> str:
    return "".join(str(unicodedata.decimal(c)) for c in text if c.isdecimal())


def luhn(number: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(number))) % 10 == 0


def iban_rest(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def country_digits(text: str) -> int:
    """Digits of a phone number's country code, which stays."""
    m = re.match(r"\+(\d{1,3})(?=[ .(-])", text)
    return len(m[1]) if m else 1 if text.startswith("+") else 0


def canonical(kind: str, text: str) -> str | None:
    """The form that equal entities share; None if it is no entity of this type."""
    if kind == "email":
        return unicodedata.normalize("NFC", text).lower()
    if kind in ("card", "ssn"):
        return digits_of(text)
    if kind == "phone":
        d = digits_of(text)
        return d[country_digits(text):] if 7 <= len(d) <= 15 else None
    if kind == "iban":
        c = text.replace(" ", "")
        return c if iban_rest(c) == 1 else None
    if kind in ("ipv4", "ipv6"):
        try:
            return str(ipaddress.ip_address(text))
        except ValueError:
            return None
    return text.lower() if kind in ("mac", "male", "female", "surname") else text


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Stretches that hold every digit and @ with what may belong to it, cut at white space."""
    if any(m in text for m in MARKS):
        yield 0, len(text)
        return
    done, begin, end = 0, None, 0

    def cut():
        a = max(done, text.rfind(" ", 0, max(begin, 0)) + 1, text.rfind("\n", 0, max(begin, 0)) + 1)
        b = min(x if (x := text.find(c, end)) >= 0 else len(text) for c in " \n")
        return a, b

    for m in HINT.finditer(text):
        at = m.start()
        if begin is None:
            begin = at - MARGIN
        elif at - MARGIN > end:
            w = cut()
            yield w
            done, begin = w[1], at - MARGIN
        end = at + MARGIN
    if begin is not None:
        yield cut()


def find(text: str) -> list[Entity]:
    """Entities in order, none overlapping: named secrets first, then the patterns as listed, then names."""
    found: list[Entity] = []
    folded = text.lower()
    if any(w in folded for w in ASSIGNED_WORDS):
        for m in ASSIGNED.finditer(text):
            g = m.lastindex
            found.append((m.start(g), m.end(g), "secret", m[g]))
    for begin, end in windows(text):
        for m in NUMBERS.finditer(text, begin, end):
            c = canonical(m.lastgroup, m[0])
            if c is not None:
                found.append((m.start(), m.end(), m.lastgroup, c))
    surnames = set()
    for m in NAMES.finditer(text):
        name = m["surname"]
        if m.start() and (text[m.start() - 1].isalnum() or text[m.start() - 1] == "_") or name.isupper() or not name[0].isupper():
            continue
        if m["word"] in GENDER:
            if m["dot"]:
                continue
            found.append((m.start("word"), m.end("word"), GENDER[m["word"]], m["word"].lower()))
        if m["given"]:
            found.append((m.start("given"), m.end("given"), GENDER[m["given"]], m["given"].lower()))
        found.append((m.start("surname"), m.end("surname"), "surname", name.lower()))
        surnames.add(name)
    if surnames:  # the same person by surname alone
        for m in re.finditer(r"\b(?:" + "|".join(map(re.escape, sorted(surnames, key=len, reverse=True))) + r")\b", text):
            found.append((m.start(), m.end(), "surname", m[0].lower()))
    found.sort(key=lambda e: (e[0], -e[1], e[2] != "secret"))
    out: list[Entity] = []
    for e in found:
        if not out or e[0] >= out[-1][1]:
            out.append(e)
    return out


class Draw:
    """Numbers drawn from a keyed hash of what is replaced."""

    def __init__(self, key: bytes, *what: str):
        self.key, self.what, self.turn, self.left = key, "\0".join(what).encode("utf-8"), 0, 0
        self.bits = 0

    def below(self, n: int) -> int:
        if self.left < 1 << 32:
            self.bits = self.bits << 256 | int.from_bytes(hmac.new(self.key, self.what + b"\0%d" % self.turn, hashlib.sha256).digest())
            self.left = max(self.left, 1) << 256
            self.turn += 1
        self.bits, out = divmod(self.bits, n)
        self.left //= n
        return out

    def pick(self, items):
        return items[self.below(len(items))]

    def char(self, c: str, hexa: bool = False) -> str:
        """A character of the same kind: digit, or letter of the same case and script."""
        if c.isdecimal():
            return chr(ord(c) - unicodedata.decimal(c) + self.below(10))
        if not c.isalpha():
            return c
        if hexa:
            return self.pick("abcdef" if c.islower() else "ABCDEF")
        if c.isascii():
            return chr((97 if c.islower() else 65) + self.below(26))
        row, kind = ord(c) & ~0xF, unicodedata.category(c)
        return self.pick([x for i in range(16) if unicodedata.category(x := chr(row + i)) == kind and x.isalpha()])

    def shape(self, text: str, hexa: bool = False) -> str:
        return "".join(self.char(c, hexa) for c in text)


def script_of(text: str) -> str:
    name = unicodedata.name(text[0], "")
    return next((s for s in SYLLABLES if name.startswith(s)), "LATIN")


def surrogate(kind: str, form: str, attempt: int, key: bytes) -> str:
    """The canonical form of the replacement; attempts differ from each other.

    From attempt SHAPED on it is longer by a character a draw (digits for numbers, hexadecimal pairs for MACs,
    letters for the rest); an IPv4 address comes from 10.0.0.0/8, then from the private IPv6 range. A secret without letters
    or digits becomes letters.
    """
    d = Draw(key, kind, form, str(attempt))
    wider = max(0, attempt - SHAPED + 1)
    if kind == "email":
        local, _, domain = form.partition("@")
        name, dot, top = domain.rpartition(".")
        return d.shape(local + "x" * wider) + "@" + Draw(key, "domain", domain, "0").shape(name) + dot + top
    if kind in ("card", "ssn", "phone"):
        out = (form[0] if kind == "card" else str(1 + d.below(9)) if form[0] != "0" else "0") + d.shape("0" * (len(form) - 1 + wider))
        if kind == "card":
            out = next(x for i in range(10) if luhn(x := out[:-1] + str((int(out[-1]) + i) % 10)) == luhn(form))
        return out
    if kind == "iban":
        body = d.shape(form[4:] + "0" * wider)
        return f"{form[:2]}{98 - iban_rest(form[:2] + '00' + body):02d}{body}"
    if kind == "ipv4":
        if wider > SHAPED:
            return str(ipaddress.ip_address((0xFD << 120) | d.below(1 << 120)))
        old = ipaddress.ip_address("10.0.0.0" if wider else form)
        for net in ("10.0.0.0/8", "192.168.0.0/16", "172.16.0.0/12", "127.0.0.0/8", "169.254.0.0/16"):
            if old in (n := ipaddress.ip_network(net)):
                return str(n[1 + d.below(n.num_addresses - 2)])
        while True:
            new = ipaddress.ip_address(d.below(0xE0000000))
            if new.is_global:
                return str(new)
    if kind == "ipv6":
        return str(ipaddress.ip_address((int(ipaddress.ip_address(form)) >> 96 << 96) | (d.below(1 << 30) << 66) | (d.below(1 << 30) << 36) | d.below(1 << 30)))
    if kind in ("male", "female", "surname"):
        s = script_of(form)
        end = d.pick(ENDINGS[s, None if kind == "surname" else kind])
        kept = next((e for e in ("ova", "eva", "ов", "ова", "ев", "ева") if kind == "surname" and form.endswith(e)), end)
        return "".join(d.pick(SYLLABLES[s]) for _ in range(2 + attempt)) + kept
    mark = next((m for m in MARKS if kind == "secret" and form.startswith(m)), "")
    form = form[len(mark):]
    if kind == "mac" and wider:
        return ":".join(f"{d.below(256):02x}" for _ in range(6 + wider))
    if not any(c.isdecimal() or c.isalpha() for c in form):
        form = "x" * len(form)
    form += "x" * wider
    return mark + d.shape(form, kind == "mac" or re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", form) is not None)


def render(kind: str, old: str, new: str) -> str:
    """The replacement in the layout, script and case of what stood there; what is longer goes on at its end."""
    if kind in ("card", "ssn", "phone"):
        keep, left = country_digits(old) if kind == "phone" else 0, iter(new)
        out = []
        for c in old:
            if c.isdecimal():
                keep -= 1
                c = c if keep >= 0 else chr(ord(c) - unicodedata.decimal(c) + int(next(left, "0")))
            out.append(c)
        return "".join(out) + "".join(left)
    if kind == "iban":
        left = iter(new)
        return "".join(c if c == " " else next(left) for c in old) + "".join(left)
    if kind in ("male", "female", "surname"):
        return new.upper() if old.isupper() and len(old) > 1 else new[:1].upper() + new[1:] if old[:1].isupper() else new
    if kind in ("email", "mac") and len(old) == len(new):
        return "".join(n.upper() if o.isupper() else n for o, n in zip(old, new))
    return new


def occurrences(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, kind, form): each entity once per text."""
    src = keyed_text(df, id_col, text_col)
    schema = T.StructType([src.schema["id"], T.StructField("kind", T.StringType()), T.StructField("form", T.StringType())])

    def run(batches):
        for b in batches:
            rows = [(i, k, f) for first, texts in texts_of(b.column(1)) for i, t in enumerate(texts, first)
                    for k, f in sorted({e[2:] for e in find(t.decode("utf-8", "replace"))})]
            if rows:
                at, kind, form = zip(*rows)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array(kind), pa.array(form)], names=schema.names)

    return src.mapInArrow(run, schema)


def assign(entities: DataFrame, key: bytes, attempts: int | None = None) -> DataFrame:
    """(kind, form, new, attempt) for distinct (kind, form) rows: no two of a kind share ``new``, and no ``new`` is a form.

    Each round draws for the rows still open; of equal draws the smallest form wins, the others and those
    that hit a form or an earlier surrogate draw again. Only open rows take part in further rounds. Surrogates grow with the rounds, so all
    rows are settled in the end; ``attempts`` limits the rounds for a caller who prefers an error.
    """
    def generate(batches):
        for b in batches:
            new = [surrogate(k, f, a, key) for k, f, a in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(new, pa.string())], names=["kind", "form", "attempt", "new"])

    todo, settled = entities.withColumn("attempt", F.lit(0)), []
    taken = entities.select(F.col("kind").alias("k"), F.col("form").alias("n"))
    for attempt in count() if attempts is None else range(attempts):
        drawn = durable(todo.mapInArrow(generate, "kind string, form string, attempt int, new string"))
        free = drawn.join(taken, (F.col("kind") == F.col("k")) & (F.col("new") == F.col("n")), "left_anti")
        won = durable(free.groupBy("kind", "new").agg(F.min("form").alias("form")).select("kind", "form", "new", F.lit(attempt).alias("attempt")))
        settled.append(won)
        todo = durable(drawn.join(won.select("kind", "form"), ["kind", "form"], "left_anti").select("kind", "form", (F.col("attempt") + 1).alias("attempt")))
        if todo.isEmpty():
            out = settled[0]
            for s in settled[1:]:
                out = out.union(s)
            return out
        taken = taken.union(won.select("kind", "new"))
    raise ValueError("a kind of entity has fewer surrogates than entities")


def replace(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", most_again: int = 100_000) -> DataFrame:
    """(id, text, n_entities, kinds): one row per input row with every entity replaced.

    ``kinds`` lists the types found, sorted and joined by commas ('' for none). Texts without entities come
    back as they are, null as null; null and repeated ids are rows like others.

    A surrogate follows from the key, the entity and the number of draws, which is 0 unless draws met. If at
    most ``most_again`` entities were drawn again (counted), that short list goes along and the texts are
    rewritten where they are read; beyond it each text is joined with its own entities' draws.
    """
    seen = occurrences(df, id_col, text_col)
    entities = durable(seen.select("kind", "form").distinct())
    again = assign(entities, key).where("attempt > 0").select("kind", "form", "attempt")
    again = durable(again)
    short = again.limit(most_again + 1).count() <= most_again
    draws = {(r["kind"], r["form"]): r["attempt"] for r in again.collect()} if short else {}
    rows = keyed_text(df, id_col, text_col)
    if short:
        rows = rows.withColumn("own", F.lit(None).cast("array<struct<kind:string,form:string,attempt:int>>"))
    else:
        t = again.select(F.col("kind").alias("k"), F.col("form").alias("f"), "attempt")
        # an entity in very many texts meets one row of the list: adaptive execution splits that side
        own = seen.join(t, (F.col("kind") == F.col("k")) & (F.col("form") == F.col("f"))).dropDuplicates(["id", "kind", "form"])
        own = own.groupBy(F.col("id").alias("of")).agg(F.collect_list(F.struct("kind", "form", "attempt")).alias("own"))
        rows = rows.join(own, F.col("id").eqNullSafe(F.col("of")), "left").select("id", "text", "own")
    schema = T.StructType([rows.schema["id"], T.StructField("text", T.StringType()), T.StructField("n_entities", T.LongType()), T.StructField("kinds", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], str] = {}
        for b in slices(batches, 1):
            out, n, kinds = [], [], []
            for text, own in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                hits = find(text) if text else []
                more = {(o["kind"], o["form"]): o["attempt"] for o in own or ()}
                at, parts = 0, []
                for begin, end, kind, form in hits:
                    new = known.get((kind, form))
                    if new is None:
                        if len(known) >= 100_000:
                            known.clear()
                        new = known[kind, form] = surrogate(kind, form, more.get((kind, form)) or draws.get((kind, form), 0), key)
                    parts += text[at:begin], render(kind, text[begin:end], new)
                    at = end
                out.append("".join(parts) + text[at:] if hits else text)
                n.append(len(hits))
                kinds.append(",".join(sorted({h[2] for h in hits})))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string()), pa.array(n, pa.int64()), pa.array(kinds, pa.string())], names=schema.names)

    return rows.mapInArrow(run, schema)
