"""Case-folded substring rule chain that labels a pull request by its title."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The title rule chain. Evaluated top to bottom, first hit wins;
# a hit is a case-insensitive substring match (so "prefix" is a bug fix and
# "address" a feature). Order is part of the semantics.
TITLE_RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("bug fix", ("fix", "bug")),
    ("feature", ("feat", "add", "implement")),
    ("refactor", ("refactor", "clean")),
    ("test", ("test",)),
    ("documentation", ("doc",)),
)
FALLBACK_CLASS = "not clear"
CLASSES: tuple[str, ...] = tuple(label for label, _ in TITLE_RULES) + (FALLBACK_CLASS,)


def classify_title(title: Column | str, rules=TITLE_RULES, fallback: str = FALLBACK_CLASS) -> Column:
    """Build ``CASE WHEN lower(t) LIKE '%w%' ... END`` from an ordered rule list.

    A NULL title matches no rule and falls through to ``fallback``.
    """
    t = F.lower(F.col(title) if isinstance(title, str) else title)
    expr = None
    for label, words in rules:
        hit = None
        for w in words:
            c = t.contains(w)
            hit = c if hit is None else (hit | c)
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    return F.lit(fallback) if expr is None else expr.otherwise(F.lit(fallback))
