"""M1, M2: silver pull requests (classified) and silver releases (latest per tag)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.classify import classify_title
from ..functions.nested import field_names, nested_to_json
from ..operators.filters import not_null
from ..operators.windows import latest_per_key

PR_COLUMNS = ["repository", "id", "number", "title", "description", "state", "additions", "deletions",
              "changed_files", "commits", "author", "base_branch", "head_branch", "labels_json",
              "labels_list", "url", "created_at", "closed_at", "merged_at", "fetched_at", "feat_classifier"]

RELEASE_COLUMNS = ["repository", "id", "release_name", "tag", "release_author", "published_at",
                   "created_at", "updated_at", "release_url", "body", "is_draft", "is_prerelease",
                   "fetched_at", "row_num"]


def silver_pull_requests(raw: DataFrame) -> DataFrame:
    """M1: rename, flatten ``user/base/head``, labels as JSON text and as a name list, classify."""
    return raw.select(
        F.col("repository_full_name").alias("repository"),
        "id", "number", "title",
        F.col("body").alias("description"),
        "state", "additions", "deletions", "changed_files", "commits",
        F.col("user.login").alias("author"),
        F.col("base.ref").alias("base_branch"),
        F.col("head.ref").alias("head_branch"),
        nested_to_json("labels").alias("labels_json"),
        field_names("labels", "name").alias("labels_list"),
        F.col("html_url").alias("url"),
        "created_at", "closed_at", "merged_at", "fetched_at",
        classify_title("title").alias("feat_classifier"),
    )


def silver_releases(raw: DataFrame) -> DataFrame:
    """M2: published releases only, one per (repository, tag): latest ``published_at``, then highest id."""
    published = not_null(raw, "published_at")
    shaped = published.select(
        F.col("repository_full_name").alias("repository"),
        "id",
        F.col("name").alias("release_name"),
        F.col("tag_name").alias("tag"),
        F.col("author.login").alias("release_author"),
        "published_at", "created_at", "updated_at",
        F.col("html_url").alias("release_url"),
        "body",
        F.col("draft").alias("is_draft"),
        F.col("prerelease").alias("is_prerelease"),
        "fetched_at",
    )
    return latest_per_key(shaped, ["repository", "tag"], ["published_at", "id"], rank_col="row_num")
