"""Main-text extraction by the maximum-scoring subsequence of a page's tokens.

A page is a sequence of words and tags. Words score positive, tags negative, words of menus, adverts,
scripts and the like are struck out; a linear scan finds the contiguous run of highest total, which is the
article. The weights are the log-odds of lying inside or outside the article, counted with Spark over all
pages that carry one article or main element, which labels them. A tag that marks the edge of articles
thus separates; paragraph tags hardly cost anything. The label itself only teaches: reading a page, the scan alone decides.

An element is struck out by its name or by the head word of a class, id or role ("main-nav", "ad-box"; not
"has-sidebar" or "search-result"), as far as HTML lets it reach: a tag that is optional ends at the next
sibling or the parent's end. Elements around the page's only articles stay.
"""

from __future__ import annotations

import html
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import keyed_text, slices, texts_of

# fixed values of HTML: elements without text of the page, without an end tag, and those that start a block
RAW = ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
                   "search section summary table tbody tfoot thead tr ul caption".split())
SPACES = frozenset("br td th wbr".split())
#: Elements, and words of class, id or role, that never belong to an article.
STRUCK_TAGS = frozenset("head nav header footer aside form menu button select datalist dialog svg math canvas object audio video map".split())
STRUCK_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs toolbar topbar pagination pager "
    "header masthead footer bottom copyright sidebar aside widget widgets related recommended recommendations "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall "
    "share sharing social comment comments disqus replies respond reply login signup search hidden".split())
#: Words that a class name may end with after the word that says what it is, and those that say it is about something else.
TAIL_WORDS = frozenset("area areas articles bar block bottom box btn button buttons body container content foot head inner item items left link links list "
                       "outer panel posts right section slot text title top unit wrap wrapper".split())
OTHER_WORDS = frozenset("has have in is no non not with without".split())
OWN = frozenset(("html", "body"))  # never struck
#: Tags that end an element whose own end tag may be left out.
ENDED_BY = {"p": BLOCKS, "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option", "optgroup")),
            **dict.fromkeys(("td", "th"), frozenset(("td", "th", "tr", "tbody", "tfoot", "thead"))), "tr": frozenset(("tr", "tbody", "tfoot", "thead"))}
LABELS = ("article", "main")
#: Cost of any tag, of a unit of log-odds against a tag, and the range of a word's score.
TAG_COST, TAG_UNIT, WORD_SCORE = 0.05, 10.0, (0.5, 2.0)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(RAW) + r")\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|</?\Z|</[^a-zA-Z>][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

Weights = dict[str, float]
WORD_CLASSES = {"word", "link word"}


def tokens(page: str) -> list[tuple[str, str]]:
    """('', text) with references decoded, ('+name', attributes) and ('-name', ''), in page order."""
    out, at = [], 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            out.append(("", html.unescape(page[at:m.start()])))
        at = m.end()
        if m["tag"]:
            out.append((("-" if m["end"] else "+") + m["tag"].lower(), m["attrs"]))
        elif m[0].startswith("<![CDATA["):
            out.append(("", m[0][9:].removesuffix("]]>")))
    if at < len(page):
        out.append(("", html.unescape(page[at:])))
    return out


def strikes(name: str) -> bool:
    """Whether a class name's head word is a struck one: the last that isn't a mere part of the page."""
    words = [w.lower() for w in NAME_WORDS.findall(name)]
    if OTHER_WORDS.intersection(words):
        return False
    while len(words) > 1 and words[-1] in TAIL_WORDS and words[-1] not in STRUCK_WORDS:
        words.pop()
    return bool(words) and words[-1] in STRUCK_WORDS


def struck_by_class(attrs: str) -> bool:
    return any(strikes(name) for m in ATTRIBUTE.finditer(attrs) for name in (m[1] or m[2] or m[3] or "").split())


def reaches(seq: list[tuple[str, str]]) -> dict[int, tuple[int, bool]]:
    """Start tag's place -> (where its element ends, whether by its own end tag).

    An end tag ends what is open inside its element too; one without an open element counts for nothing.
    """
    out: dict[int, tuple[int, bool]] = {}
    stack: list[tuple[str, int]] = []
    count: Counter = Counter()

    def close(j: int, to: int) -> None:
        while len(stack) > to:
            name, i = stack.pop()
            count[name] -= 1
            out[i] = (j, False)

    for j, (kind, attrs) in enumerate(seq):
        name = kind[1:]
        if kind[:1] == "+":
            for open_name in ("p", "li", "dt", "dd", "option", "td", "th", "tr"):
                if count[open_name] and name in ENDED_BY[open_name]:
                    at = len(stack) - 1  # the nearest one, through anything but another block
                    while at >= 0 and stack[at][0] != open_name and stack[at][0] not in BLOCKS:
                        at -= 1
                    if at >= 0 and stack[at][0] == open_name:
                        close(j, at)
            if name not in VOID and not attrs.endswith("/"):
                stack.append((name, j))
                count[name] += 1
        elif kind[:1] == "-" and count[name]:
            at = len(stack) - 1
            while stack[at][0] != name:
                at -= 1
            close(j, at + 1)
            _, i = stack.pop()
            count[name] -= 1
            out[i] = (j + 1, True)
    close(len(seq), 0)
    return out


def struck(seq: list[tuple[str, str]]) -> list[bool]:
    """Which tokens lie in an element that never belongs to an article.

    One that isn't closed by its own end tag ends before the next article or main element. If every article or
    main element lay in something struck, what holds one stays: it is a wrapper.
    """
    ends = reaches(seq)
    labels, found = [], []
    for i in sorted(ends):
        name, attrs = seq[i][0][1:], seq[i][1]
        own = name not in OWN and bool(attrs) and struck_by_class(attrs)
        if name in LABELS and not own:
            labels.append(i)
        elif own or name in STRUCK_TAGS:
            found.append(i)
    spans = []
    for i in found:
        end, closed = ends[i]
        k = bisect_right(labels, i)
        if not closed and k < len(labels) and labels[k] < end:
            end = labels[k]
        spans.append((i, end, k < len(labels) and labels[k] < end))
    covered, free = 0, len(labels)
    for i, end, _ in spans:
        free -= max(0, bisect_left(labels, end) - bisect_left(labels, max(i, covered)))
        covered = max(covered, end)
    out = [False] * len(seq)
    covered = 0
    for i, end, holds in spans:
        if holds and not free:
            continue
        i = max(i, covered)
        if end > i:
            out[i:end] = [True] * (end - i)
            covered = end
    return out


def label_span(seq: list[tuple[str, str]], gone: list[bool]) -> tuple[int, int] | None:
    """Tokens of the page's only article (else only main) element that isn't struck out; an unclosed one ends with the page."""
    for name in LABELS:
        begins = [i for i, (k, _) in enumerate(seq) if k == "+" + name and not gone[i]]
        ends = [i for i, (k, _) in enumerate(seq) if k == "-" + name and not gone[i]]
        if len(begins) == 1 and len(ends) <= 1 and (not ends or begins[0] < ends[0]):
            return begins[0], ends[0] if ends else len(seq)
    return None


def page_counts(page: str) -> Counter:
    """(name, inside) -> tokens of a labelled page; the label's own tags count as outside."""
    seq = tokens(page)
    gone = struck(seq)
    span = label_span(seq, gone)
    found: Counter = Counter()
    if span:
        link = False
        for i, (kind, text) in enumerate(seq):
            if kind in ("+a", "-a"):
                link = kind == "+a"
            if not gone[i]:
                found[kind[1:] if kind else "link word" if link else "word", span[0] < i < span[1]] += 1 if kind else len(text.split())
    return found


def learn_weights(df: DataFrame, html_col: str = "html") -> Weights:
    """Token -> score from all labelled pages: grouped counts, one row per element name of HTML (others: 'other').

    Tags cost TAG_COST and TAG_UNIT for each unit of log-odds of lying outside; words score their log-odds of
    lying inside, within WORD_SCORE.
    Without labelled pages every tag costs TAG_COST.
    """
    src = df.select(F.lit(0).alias("id"), F.col("`" + html_col + "`").cast("string").alias("text"))
    known = BLOCKS | SPACES | VOID | STRUCK_TAGS | frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output progress q ruby rp rt s samp small span strike strong sub sup time tt u var".split()) | WORD_CLASSES

    def run(batches):
        for b in batches:
            found: Counter = Counter()
            for _, texts in texts_of(b.column(1)):
                for t in texts:
                    found.update(page_counts(t.decode("utf-8", "replace")))
            rows = Counter()
            for (name, inside), n in found.items():
                rows[name if name in known else "other", inside] += n
            if rows:
                keys, n = zip(*rows.items())
                name, inside = zip(*keys)
                yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(inside, pa.bool_()), pa.array(n, pa.int64())], names=["name", "inside", "n"])

    counts = src.mapInArrow(run, "name string, inside boolean, n long").groupBy("name").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"), F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("o"))
    out: Weights = {}
    for name, i, o in counts.collect():  # at most one row for each name in ``known``
        odds = math.log((i + 1) / (o + 1))
        out[name] = min(max(odds, WORD_SCORE[0]), WORD_SCORE[1]) if name in WORD_CLASSES else -TAG_COST + TAG_UNIT * min(odds, 0.0)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """[begin, end) of the contiguous run of highest total; (0, 0) if no score is positive."""
    best = total = 0.0
    begin = found = end = 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, found, end = total, begin, i + 1
    return found, end


def main_text(page: str, weights: Weights) -> str:
    """Blocks of the best run, white space inside as one blank, joined by line feeds."""
    seq = tokens(page)
    gone = struck(seq)
    usual = {"word": 1.0, "link word": 0.5}
    scores, link = [], False
    for i, ((kind, text), g) in enumerate(zip(seq, gone)):
        if kind in ("+a", "-a"):
            link = kind == "+a"
        if g:
            scores.append(-TAG_COST)
        elif kind:
            scores.append(weights.get(kind[1:], weights.get("other", -TAG_COST)))
        else:
            name = "link word" if link else "word"
            scores.append(len(text.split()) * weights.get(name, usual[name]))
    begin, end = best_run(scores)
    blocks, now = [], []
    for i in range(begin, end):
        kind, text = seq[i]
        if gone[i]:
            if kind[1:] in BLOCKS:
                blocks.append("".join(now))
                now = []
        elif not kind:
            now.append(text)
        elif kind[1:] in BLOCKS:
            blocks.append("".join(now))
            now = []
        elif kind[1:] in SPACES:
            now.append(" ")
    blocks.append("".join(now))
    return "\n".join(t for b in blocks if (t := " ".join(b.split())))


def extract(df: DataFrame, id_col: str = "page_id", html_col: str = "html", *more: str, weights: Weights | None = None) -> DataFrame:
    """(id, text, more...): the main text of every whole page; null, empty and wordless pages give ''.

    One row per input row, repeated rows and null ids included. Equal totals: the first run, without
    trailing tags. ``weights`` default to those learned from the pages of ``df`` itself.
    """
    known = learn_weights(df, html_col) if weights is None else weights
    src = keyed_text(df, id_col, html_col, *more)
    schema = T.StructType([src.schema["id"], T.StructField("text", T.StringType()), *src.schema.fields[2:]])

    def run(batches):
        for b in slices(batches, 1):
            found = [main_text(t.decode("utf-8", "replace"), known) for _, texts in texts_of(b.column(1)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string()), *b.columns[2:]], names=schema.names)

    return src.mapInArrow(run, schema)
