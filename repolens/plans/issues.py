"""Issue cleaning - drop pull requests (P4), stamp (P3), cap per repository (W3), upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.filters import state_filter
from ..operators.windows import recent_n_per_key
from ..sinks.upsert import merge_latest


def clean_issues(issues: DataFrame, state: str = "all", max_per_repo: int | None = None,
                 existing: DataFrame | None = None) -> DataFrame:
    """Issues already filtered for the ``pull_request`` key (see ``sources.landing.read_issue_pages``).

    The cap counts after that filter and keeps the most recently updated
    (``0``/None = unlimited, negative = none); the result is merged by ``id``.
    """
    kept = state_filter(issues, state)
    capped = recent_n_per_key(kept, ["repository_full_name"],
                              [F.col("updated_at").desc_nulls_last(), F.col("id").desc_nulls_last()],
                              max_per_repo, rank_col=None)
    return merge_latest(existing, capped, ["id"], ["fetched_at"])
