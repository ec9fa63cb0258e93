"""Column-level helpers (JVM-side expressions only; no Python UDFs)."""

from .classify import CLASSES, FALLBACK_CLASS, TITLE_RULES, classify_title
from .nested import (child_rows, field_names, nested_count, nested_to_json, topk_nested,
                     cap_nested)
from .numeric import round_half_away
from .timefmt import days_between, epoch_seconds, month_start, to_timestamp_strict, try_timestamp

__all__ = [
    "CLASSES", "FALLBACK_CLASS", "TITLE_RULES", "classify_title",
    "child_rows", "field_names", "nested_count", "nested_to_json", "topk_nested", "cap_nested",
    "round_half_away",
    "days_between", "epoch_seconds", "month_start", "to_timestamp_strict", "try_timestamp",
]
