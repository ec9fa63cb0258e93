"""Explicit read-time schemas per entity (REST and GraphQL shapes).

Every column is nullable: list endpoints omit size counters and some dates.
Timestamps arrive as ISO-8601 text and are cast where models need them. Keys a
schema does not name survive in the record's JSON text, which the landing
reader keeps on request (``raw_col``).
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, BooleanType, DoubleType, LongType, StringType, StructField,
                               StructType)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


S, L, B, D = StringType(), LongType(), BooleanType(), DoubleType()

LOGIN = _s(("login", S))
REF = _s(("ref", S))
LABEL = _s(("name", S))

REST_PULL_REQUEST = _s(
    ("id", L), ("number", L), ("title", S), ("body", S), ("state", S),
    ("user", LOGIN), ("base", REF), ("head", REF), ("labels", ArrayType(LABEL)), ("html_url", S),
    ("additions", L), ("deletions", L), ("changed_files", L), ("commits", L),
    ("created_at", S), ("updated_at", S), ("closed_at", S), ("merged_at", S),
    ("repository_full_name", S), ("fetched_at", S))

REST_RELEASE = _s(
    ("id", L), ("tag_name", S), ("name", S), ("body", S), ("draft", B), ("prerelease", B),
    ("author", LOGIN), ("html_url", S), ("published_at", S), ("created_at", S), ("updated_at", S),
    ("repository_full_name", S), ("fetched_at", S))

REST_REPOSITORY = _s(
    ("id", L), ("name", S), ("full_name", S), ("description", S), ("owner", LOGIN), ("html_url", S),
    ("homepage", S), ("language", S), ("topics", ArrayType(S)), ("stargazers_count", L), ("forks_count", L),
    ("open_issues_count", L), ("size", L), ("default_branch", S), ("archived", B), ("fork", B), ("private", B),
    ("created_at", S), ("updated_at", S), ("pushed_at", S), ("fetched_at", S))

REST_ISSUE = _s(
    ("id", L), ("number", L), ("title", S), ("body", S), ("state", S), ("user", LOGIN),
    ("labels", ArrayType(LABEL)), ("assignees", ArrayType(LOGIN)), ("comments", L), ("html_url", S),
    ("created_at", S), ("updated_at", S), ("closed_at", S),
    ("repository_full_name", S), ("fetched_at", S))

_NAME_COLOR = _s(("name", S), ("color", S))

GQL_REPOSITORY = _s(
    ("databaseId", L), ("id", S), ("nameWithOwner", S), ("name", S), ("description", S), ("url", S),
    ("homepageUrl", S),
    ("createdAt", S), ("updatedAt", S), ("pushedAt", S), ("stargazerCount", L), ("forkCount", L),
    ("diskUsage", L), ("primaryLanguage", _NAME_COLOR),
    ("languages", _s(("totalSize", L), ("edges", ArrayType(_s(("size", L), ("node", _NAME_COLOR)))))),
    ("licenseInfo", _s(("key", S), ("name", S), ("spdxId", S))),
    ("repositoryTopics", _s(("nodes", ArrayType(_s(("topic", _s(("name", S)))))))),
    ("owner", _s(("login", S), ("name", S), ("description", S), ("bio", S), ("company", S), ("location", S),
                 ("websiteUrl", S), ("createdAt", S))),
    ("isArchived", B), ("isDisabled", B), ("isEmpty", B), ("isFork", B), ("isPrivate", B),
    ("hasIssuesEnabled", B), ("hasProjectsEnabled", B), ("hasWikiEnabled", B), ("hasDiscussionsEnabled", B),
    ("defaultBranchRef", LABEL))

GQL_PULL_REQUEST = _s(
    ("databaseId", L), ("number", L), ("title", S), ("body", S), ("bodyText", S), ("state", S), ("url", S),
    ("createdAt", S), ("updatedAt", S), ("closedAt", S), ("mergedAt", S), ("mergeable", S),
    ("additions", L), ("deletions", L), ("changedFiles", L), ("commits", _s(("totalCount", L))),
    ("author", _s(("login", S), ("name", S), ("email", S), ("company", S), ("location", S))),
    ("baseRefName", S), ("headRefName", S),
    ("labels", _s(("nodes", ArrayType(_s(("name", S), ("color", S), ("description", S)))))),
    ("assignees", _s(("nodes", ArrayType(_s(("login", S), ("name", S)))))),
    ("reviewRequests", _s(("nodes", ArrayType(_s(("requestedReviewer", _s(("login", S), ("name", S)))))))),
    ("reviews", _s(("nodes", ArrayType(_s(("author", LOGIN), ("state", S), ("createdAt", S)))))),
    ("milestone", _s(("title", S), ("state", S), ("dueOn", S))),
    ("repo", S))

GQL_RELEASE = _s(
    ("databaseId", L), ("name", S), ("tagName", S), ("description", S), ("url", S),
    ("createdAt", S), ("publishedAt", S), ("updatedAt", S), ("isLatest", B), ("isPrerelease", B),
    ("isDraft", B), ("author", _s(("login", S), ("name", S))),
    ("releaseAssets", _s(("nodes", ArrayType(_s(("name", S), ("size", L), ("downloadCount", L),
                                                 ("contentType", S), ("url", S)))))),
    ("repo", S))

ENTITY_SCHEMAS = {
    "pull_requests": REST_PULL_REQUEST,
    "releases": REST_RELEASE,
    "repositories": REST_REPOSITORY,
    "issues": REST_ISSUE,
    "gql_repositories": GQL_REPOSITORY,
    "gql_pull_requests": GQL_PULL_REQUEST,
    "gql_releases": GQL_RELEASE,
}
