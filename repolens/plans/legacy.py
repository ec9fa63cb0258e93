"""Legacy (GraphQL-shaped) enrichment of repositories, pull requests and releases.

Each is one plan: select repositories, then join the children to them (J4). Records keep all their fields;
the derived ones are added. Nested lists are complete unless a cap is asked for.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.nested import cap_nested, field_names, nested_count, nested_to_json, topk_nested
from ..operators.filters import repository_filter, search_terms, within
from ..operators.joins import fk_enrich, new_entities
from ..operators.project import default_if_missing
from ..sinks.upsert import read_current, upsert_parquet
from ..sinks.writers import layer, write_summary
from ..sources.landing import CORRUPT, REASON, read_pages
from ..sources.tables import is_missing
from .presets import RANGED_QUALIFIERS, split_qualifiers

# The author fields that become columns.
AUTHOR_FIELDS = ["login", "name", "email", "company", "location"]
#: Columns that the ranged search qualifiers test.
QUALIFIED = {"pushed": "pushedAt", "created": "createdAt", "stars": "stargazerCount", "forks": "forkCount"}


def _qualified(repos: DataFrame, quals: dict) -> DataFrame:
    for name, ranges in quals.items():
        if name in RANGED_QUALIFIERS:
            for r in ranges:
                kind = RANGED_QUALIFIERS[name]
                repos = repos.where(within(F.col(QUALIFIED[name]).cast(kind), as_type=kind, **r))
        elif name == "archived":
            repos = repos.where(F.coalesce(F.col("isArchived"), F.lit(False)) == quals[name])
        else:
            repos = repos.where(F.lower(F.col("primaryLanguage.name")) == quals[name].lower())
    return repos


def select_repositories(repos: DataFrame, existing: DataFrame | None, search: str | None = None,
                        max_repos: int | None = None, include_archived: bool = False, min_stars: int = 0,
                        pushed_after: str | None = None, collected_at: Column | None = None,
                        topics_cap: int | None = None, languages_cap: int | None = None) -> DataFrame:
    """Filter (P8, P9), cap by stars (O3, O4), skip already loaded (J1), derive fields.

    Skipped repositories still count toward ``max_repos`` (cap before anti join; 0 takes none).
    Qualifiers inside ``search`` (see :func:`.presets.split_qualifiers`) hold in addition to the
    arguments; ``archived:`` replaces ``include_archived``.
    """
    search, quals = split_qualifiers(search)
    cand = repository_filter(repos, include_archived or "archived" in quals, min_stars, pushed_after,
                             archived_col="isArchived", stars_col="stargazerCount", pushed_col="pushedAt")
    cand = _qualified(cand, quals)
    topics = field_names("repositoryTopics.nodes", "topic.name")
    if search:
        topic_text = F.concat_ws(" ", topics) if "repositoryTopics" in repos.columns else F.lit("")
        cand = search_terms(cand.withColumn("_topics_text", topic_text), search,
                            ["nameWithOwner", "description", "_topics_text"]).drop("_topics_text")
    order = [F.col("stargazerCount").desc_nulls_last(), F.col("databaseId").asc_nulls_last()]
    existing_keys = existing if existing is not None else repos.limit(0).select("nameWithOwner")
    out = new_entities(cand, existing_keys, "nameWithOwner", max_repos, order)
    out = out.withColumn("repo_database_id", F.col("databaseId"))
    if "repositoryTopics" in repos.columns:
        out = out.withColumn("topics", cap_nested(topics, topics_cap))
    if "languages" in repos.columns:
        languages = F.col("languages")
        if languages_cap is not None:
            languages = languages.withField("edges", topk_nested("languages.edges", "size", languages_cap))
        out = out.withColumn("languages_data", languages)
    if collected_at is not None:
        out = out.withColumn("collected_at", collected_at)
    return out


def enrich_pull_requests(prs: DataFrame, repos: DataFrame, collected_at: Column | None = None,
                         labels_cap: int | None = None, assignees_cap: int | None = None) -> DataFrame:
    """M9: every field of the record, plus J4 repository join, P13 author, P14 commit default, P15 aliases, N1/N3/N4 lists."""
    joined = fk_enrich(prs, repos, "repo", "nameWithOwner", {"databaseId": "repo_database_id"})
    labels = cap_nested("labels.nodes", labels_cap)
    out = joined.select(
        *prs.columns, "repo_database_id", F.col("databaseId").alias("database_id"),
        *[F.col(f"author.{f}").alias(f"author__{f}") for f in AUTHOR_FIELDS],
        F.col("baseRefName").alias("base_branch"), F.col("headRefName").alias("head_branch"),
        default_if_missing("commits.totalCount", 0).cast("long").alias("commit_count"),
        field_names(labels, "name").alias("labels_list"),
        nested_to_json(labels).alias("labels_json"),
        F.col("milestone.title").alias("milestone_title"),
        field_names(cap_nested("assignees.nodes", assignees_cap), "login").alias("assignees_list"),
    )
    return out.withColumn("collected_at", collected_at) if collected_at is not None else out


def enrich_releases(releases: DataFrame, repos: DataFrame, collected_at: Column | None = None,
                    assets_cap: int | None = None) -> DataFrame:
    """Every field of the record, plus J4 repository join, P13 author, P15 aliases, N5 asset count and list."""
    joined = fk_enrich(releases, repos, "repo", "nameWithOwner", {"databaseId": "repo_database_id"})
    assets = cap_nested("releaseAssets.nodes", assets_cap)
    out = joined.select(
        *releases.columns, "repo_database_id", F.col("databaseId").alias("database_id"),
        F.col("tagName").alias("tag_name"),
        F.col("author.login").alias("author__login"), F.col("author.name").alias("author__name"),
        nested_count(assets).alias("assets_count"),
        assets.alias("assets_data"),
    )
    return out.withColumn("collected_at", collected_at) if collected_at is not None else out


def _rejected(rows: DataFrame, reason: str) -> DataFrame:
    return rows.select("_source_file", F.to_json(F.struct(*[c for c in rows.columns if c != "_source_file"])).alias(CORRUPT), F.lit(reason).alias(REASON))


def run_legacy_job(spark, landing: str, warehouse: str, search: str | None = None,
                   max_repos: int | None = None, include_archived: bool = False, min_stars: int = 0) -> dict:
    """The legacy runner in one pass: select repositories (skipping stored ones), enrich pull
    requests and releases against the selected and stored repositories, upsert all three by
    ``database_id``. The reference needed a second run for the children; here the join sees
    the repositories selected in the same run. Returns rows per stored table (S9).

    What isn't stored is a reject with a reason, written to ``<warehouse>/rejects/<table>``: records that don't parse,
    children whose repository isn't stored, rows without an id. Rows and rejects by reason are the
    table ``<warehouse>/summary``. Repositories that the selection leaves out are no rejects.
    """
    root, outcomes = warehouse.rstrip("/"), []

    def store(name: str, rows: DataFrame, rejects: DataFrame) -> int:
        kept = layer(rejects, f"{root}/rejects/{name}")
        reasons = kept.groupBy(REASON).agg(F.count("*").alias("n")).collect()  # a handful
        outcomes.extend((name, r[REASON], r["n"]) for r in reasons)
        done = upsert_parquet(spark, f"{root}/{name}", rows, ["database_id"], ["collected_at"])
        outcomes.append((name, "stored", done.rows))
        return done.rows

    stored = read_current(spark, f"{root}/repositories")
    existing = stored.select("nameWithOwner") if stored is not None else spark.createDataFrame(
        [], StructType([StructField("nameWithOwner", StringType())]))
    repos_in, bad = read_pages(spark, landing, "gql_repositories", stage=f"{root}/parsed/repositories")
    no_id = F.col("databaseId").isNull()
    picked = select_repositories(repos_in.where(~no_id).drop("_source_file"), existing, search, max_repos, include_archived,
                                 min_stars, collected_at=F.current_timestamp())
    counts = {"repositories": store("repositories", picked.withColumn("database_id", F.col("databaseId")),
                                    bad.unionByName(_rejected(repos_in.where(no_id), "no id")))}
    repos_now = read_current(spark, f"{root}/repositories")
    if repos_now is None:  # nothing selected and nothing stored: every child is without a parent
        repos_now = spark.createDataFrame([], "nameWithOwner string, databaseId long")
    repos_now = repos_now.select("nameWithOwner", "databaseId")
    for entity, enrich in (("gql_pull_requests", enrich_pull_requests), ("gql_releases", enrich_releases)):
        name = entity.replace("gql_", "")
        try:
            children, bad = read_pages(spark, landing, entity, stage=f"{root}/parsed/{name}")
        except AnalysisException as e:
            if not is_missing(e):
                raise
            continue  # nothing landed for this entity
        with_id = children.where(~no_id)
        orphans = with_id.join(repos_now, F.col("repo") == F.col("nameWithOwner"), "left_anti")
        rejects = bad.unionByName(_rejected(children.where(no_id), "no id")).unionByName(_rejected(orphans, "no stored repository"))
        counts[name] = store(name, enrich(with_id.drop("_source_file"), repos_now, collected_at=F.current_timestamp()), rejects)
    write_summary(spark, root, outcomes)
    return counts
