"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame`` over the supplied tables.

Each entry drives one operator family of the survey inventory through the
adapters in :mod:`.adapters`; :mod:`.oracle` holds the equivalent SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import adapters as ad
from .gold import focus_vs_top_k, median_gap, monthly_counts
from .silver import silver_pull_requests, silver_releases
from .issues import clean_issues
from .maintained import (apply_load, compact_state, event_changes, kept_counts, kept_median_gap)
from .job import (BRONZE, BRONZE_TESTS, EXPORTED_MODELS, SILVER_TESTS, SOURCE_TESTS, data_tests, gold_models, run_job)
from .legacy import enrich_pull_requests, enrich_releases, select_repositories
from ..functions.numeric import round_half_away
from ..functions.timefmt import days_between
from ..functions.nested import cap_nested, child_rows, field_names, nested_count, nested_to_json, topk_nested
from ..operators.aggregates import distinct_keys, exact_quantile_by, row_count, top_k_groups
from ..operators.search import build_index, search_index
from ..operators.sketches import gap_sketches, kll_rank_error, rank_error, sketch_quantile, top_k_by_summary
from ..operators.filters import (allow_list, equals_folded, lacks_json_key, repository_filter, search_terms,
                                 state_filter)
from ..operators.joins import existence_flag, fk_enrich, new_entities, semi_join
from ..operators.ordering import first_n
from ..operators.project import default_if_missing, flatten_struct, split_owner_name, stamp_provenance
from ..operators.windows import lag_within, recent_n_per_key
from ..functions.classify import classify_title
from ..session import ensure_checkpoint_dir, open_writers
from ..sinks.upsert import merge_latest, read_changes, read_current, upsert_parquet
from ..sinks.writers import export_models, materialize, read_model
from ..schemas import ENTITY_SCHEMAS
from ..sources.discover import child_tables, discovered_schema, typed_records
from ..sources.landing import read_pages, repo_from_path
from ..sources.variant import path_value, read_typed, store_records, unknown_keys
from ..sources.tables import existing_or_empty, scan_parquet, table as catalog_table
from ..streaming.incremental import incremental_upsert

QueryFn = Callable[[SparkSession, str], DataFrame]

_PR_GOLD = dict(focus=ad.ADAPTER_FOCUS, focus_label=ad.ADAPTER_FOCUS_LABEL, k=10, member_label="top_10")


#: (group, month, value) columns of each gold model.
GOLD_COLUMNS = {
    "feature_prs_monthly": (None, "month", "feature_pr_count"),
    "feature_releases_monthly": (None, "release_month", "feature_release_count"),
    "feature_prs_lace_vs_top10": ("repo_group", "pr_month", "feature_pr_count"),
    "feature_releases_lace_vs_top10": ("repo_group", "release_month", "feature_release_count"),
    "median_feature_prs_lace_vs_top10": (None, None, "median_days_between_feature_prs"),
    "median_releases_lace_vs_top10": (None, None, "median_days_between_releases"),
}


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder under the shared checkpoint folder, for what a query lands and writes on its way."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid4().hex}"


def read_written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table written once."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _silver_prs(spark, sf_dir):
    return silver_pull_requests(ad.pull_requests_raw(spark, sf_dir))


def _silver_rel(spark, sf_dir):
    return silver_releases(ad.releases_raw(spark, sf_dir))


def q_classify_titles(spark, sf_dir):
    """F1-F3 + M1 (classification column only)."""
    return _silver_prs(spark, sf_dir).select("id", "repository", "title", "feat_classifier")


def q_silver_pull_requests(spark, sf_dir):
    """The full silver PR model."""
    return _silver_prs(spark, sf_dir)


def q_dedup_latest_release(spark, sf_dir):
    """Silver releases, one per (repository, tag)."""
    return _silver_rel(spark, sf_dir)


def q_monthly_counts(spark, sf_dir):
    """M3, A1, F5, F6, P6."""
    return monthly_counts(_silver_prs(spark, sf_dir), order=["repository", "month"])


def q_monthly_releases(spark, sf_dir):
    """M6."""
    return monthly_counts(_silver_rel(spark, sf_dir), ts_col="published_at", month_col="release_month",
                          count_col="feature_release_count", class_col=None,
                          order=["release_month", "repository"])


def q_topk_groups(spark, sf_dir):
    """A3, O2: the ten repositories with most feature PRs."""
    base = equals_folded(_silver_prs(spark, sf_dir), "feat_classifier", "feature")
    return top_k_groups(base, "repository", 10, out="feature_pr_count")


def q_topk_by_summary(spark, sf_dir):
    """A3, O2: the ten customers with most orders, from bounded summaries and a proof instead of a count of every key."""
    return top_k_by_summary(ad.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer")), "customer", 10, out="n_orders", counters=4000)


def q_median_gap_sketched(spark, sf_dir):
    """A4: each repository's exact median gap, and whether its monthly KLL sketches, merged, come as near as they promise."""
    prs = equals_folded(_silver_prs(spark, sf_dir), "feat_classifier", "feature").where("closed_at IS NOT NULL").select("repository", "closed_at")
    stored = read_written(gap_sketches(prs, "repository", "closed_at", 800), f"{scratch(spark, 'sketches')}/gaps")
    estimate = sketch_quantile(stored, ["repository"], 0.5, "estimate")
    gaps = lag_within(prs, ["repository"], "closed_at", out="prev").where("prev IS NOT NULL").select("repository", days_between("closed_at", "prev").alias("days"))
    gaps = read_written(gaps, f"{scratch(spark, 'sketches')}/all")
    exact = exact_quantile_by(gaps, ["repository"], "days", 0.5, out="m")
    off = rank_error(gaps, estimate, "repository", "days", "estimate")
    return (exact.join(off, "repository").join(estimate, "repository")
            .select("repository", "n", round_half_away("m", 2).alias("median_days"), (F.col("rank_error") <= 2 * kll_rank_error(800)).alias("sketch_within_bound")))


def q_focus_vs_topk_prs(spark, sf_dir):
    """M4, J5, A2, P10, F4."""
    return focus_vs_top_k(_silver_prs(spark, sf_dir), order=["pr_month", "repository"], **_PR_GOLD)


def q_focus_vs_topk_releases(spark, sf_dir):
    """M7."""
    return focus_vs_top_k(_silver_rel(spark, sf_dir), ts_col="published_at", month_col="release_month",
                          count_col="feature_release_count", class_col=None,
                          order=["repo_group", "repository"], **_PR_GOLD)


def q_median_gap_prs(spark, sf_dir):
    """M5, W2, F7, F8, A4, J2."""
    return median_gap(_silver_prs(spark, sf_dir), order=True, **_PR_GOLD)


def q_median_gap_releases(spark, sf_dir):
    """M8."""
    return median_gap(_silver_rel(spark, sf_dir), ts_col="published_at",
                      out_col="median_days_between_releases", class_col=None, order=True, **_PR_GOLD)


def q_existence_flag(spark, sf_dir):
    """Is the PR's repository among the ten busiest (three-valued IN)."""
    prs = _silver_prs(spark, sf_dir)
    top = top_k_groups(equals_folded(prs, "feat_classifier", "feature"), "repository", 10)
    return existence_flag(prs.select("id", "repository"), top, "repository", "in_top", small=True)


def q_new_entities_anti(spark, sf_dir):
    """Cap 500 repositories by stars, then skip those already loaded."""
    repos = ad.repositories_raw(spark, sf_dir)
    order = [F.col("stargazerCount").desc_nulls_last(), F.col("databaseId").asc_nulls_last()]
    out = new_entities(repos, ad.existing_repositories(spark, sf_dir), "nameWithOwner", 500, order)
    return out.select("databaseId", "nameWithOwner", "stargazerCount")


def q_fk_enrich(spark, sf_dir):
    """Orders (as pull requests) carry their customer (repository) id and name."""
    o = ad.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("database_id"), "o_custkey")
    c = ad.table(spark, sf_dir, "customer").withColumn("repo", F.concat(F.lit("cust/"), F.col("c_name")))
    out = fk_enrich(o, c, "o_custkey", "c_custkey",
                    {"c_custkey": "repo_database_id", "repo": "repo", "c_acctbal": "stars"})
    return out.drop("o_custkey")


def q_state_filter(spark, sf_dir):
    """Closed pull requests only."""
    return state_filter(_silver_prs(spark, sf_dir), "closed").select("id", "repository", "state")


def q_repo_filter(spark, sf_dir):
    """Not archived, at least 5000 stars."""
    out = repository_filter(ad.repositories_raw(spark, sf_dir), include_archived=False, min_stars=5000,
                            archived_col="isArchived", stars_col="stargazerCount")
    return out.select("databaseId", "nameWithOwner", "stargazerCount")


def q_allow_list(spark, sf_dir):
    """Pull requests of three named repositories."""
    out = allow_list(_silver_prs(spark, sf_dir), "repository", ["org/repo_1", "org/repo_2", "org/repo_3"])
    return out.select("id", "repository")


def q_search_terms(spark, sf_dir):
    """Every term of the query occurs in name, type or brand."""
    out = search_terms(ad.table(spark, sf_dir, "part"), "red widget", ["p_name", "p_type", "p_brand"])
    return out.select("p_partkey", "p_name")


def q_search_index(spark, sf_dir):
    """Repositories by name, description and topic, found in a trigram index built over all of them."""
    place = scratch(spark, "index")
    repos = ad.gql_repositories(spark, sf_dir).select("databaseId", "nameWithOwner", "description")
    build_index(repos, "databaseId", ["nameWithOwner", "description"], place)
    return search_index(spark, place, "Customer#00000001 mach")


def q_split_name(spark, sf_dir):
    """owner/name split; names with zero or two slashes are rejected."""
    c = ad.table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 10
    full = (F.when(k == 0, F.col("c_name"))
             .when(k == 1, F.concat(F.lit("a/b/"), F.col("c_name")))
             .otherwise(F.concat(F.lit("cust/"), F.col("c_name"))))
    good, _ = split_owner_name(c.select("c_custkey", full.alias("full_name")), "full_name")
    return good


def q_split_name_rejects(spark, sf_dir):
    """The names that have no owner or more than one, as landed."""
    c = ad.table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 10
    full = (F.when(k == 0, F.col("c_name")).when(k == 1, F.concat(F.lit("a/b/"), F.col("c_name"))).when(k != 2, F.concat(F.lit("cust/"), F.col("c_name"))))
    _, bad = split_owner_name(c.select("c_custkey", full.alias("full_name")), "full_name")
    return bad


def q_recent_n_per_key(spark, sf_dir):
    """The five most recent events of each user."""
    ev = ad.table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    return recent_n_per_key(ev, ["user_id"], [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()],
                            5, rank_col="rn")


def _nested(spark, sf_dir):
    return ad.nested_lists(spark, sf_dir)


def q_nested_names(spark, sf_dir):
    """Label names (NULL list -> empty list)."""
    return _nested(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                         field_names("labels", "name").alias("labels_list"))


def q_nested_json(spark, sf_dir):
    """Labels as JSON text keeping NULL fields (NULL list -> '[]')."""
    return _nested(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                         nested_to_json("labels").alias("labels_json"))


def q_nested_count(spark, sf_dir):
    """List lengths (NULL list -> 0)."""
    return _nested(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                         nested_count("labels").alias("label_count"),
                                         nested_count("edges").alias("edge_count"))


def q_nested_topk(spark, sf_dir):
    """Names of the two largest edges, largest first."""
    top = topk_nested("edges", "size", 2, by_is_first=True)   # edges are (size, node)
    return _nested(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                         F.transform(top, lambda x: x["node"]["name"]).alias("top_edges"))


def q_nested_cap(spark, sf_dir):
    """First two label names."""
    return _nested(spark, sf_dir).select("l_orderkey", "l_linenumber",
                                         cap_nested(field_names("labels", "name"), 2).alias("first_labels"))


def q_child_rows(spark, sf_dir):
    """One row per label with parent key and position (empty / NULL lists give none)."""
    n = _nested(spark, sf_dir).select("l_orderkey", "l_linenumber", field_names("labels", "name").alias("names"))
    return child_rows(n, ["l_orderkey", "l_linenumber"], "names", "pos", "label_name")


def _props_with_key(spark, sf_dir):
    ev = ad.table(spark, sf_dir, "events")
    eid = F.col("event_id")
    props = (F.when(eid % 5 == 0, F.regexp_replace("props", "}$", ', "pull_request": {"url": "x"}}'))
              .when(eid % 5 == 1, F.regexp_replace("props", "}$", ', "pull_request": null}'))
              .otherwise(F.col("props")))
    return ev.select("event_id", "user_id", props.alias("record"))


def q_key_presence_filter(spark, sf_dir):
    """Keep records without a ``pull_request`` key (an explicit null still counts as present)."""
    return lacks_json_key(_props_with_key(spark, sf_dir), "record", "pull_request")


def _orders_loads(spark, sf_dir):
    o = ad.table(spark, sf_dir, "orders")
    existing = o.select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("fetched_at"),
                        F.lit("base").alias("version"))
    incoming = o.where(F.col("o_orderstatus") == "O").select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("fetched_at"), F.lit("update").alias("version"))
    return existing, incoming


def q_upsert_latest(spark, sf_dir):
    """Merge a later load into an earlier one by key; the newer row wins."""
    existing, incoming = _orders_loads(spark, sf_dir)
    return merge_latest(existing, incoming, ["o_orderkey"], ["fetched_at"])


def q_null_safe_defaults(spark, sf_dir):
    """Flatten a possibly NULL author struct; commit count defaults to 0."""
    prs = ad.gql_pull_requests(spark, sf_dir)
    flat = flatten_struct(prs, "author", ["login", "name", "email", "company", "location"])
    return flat.select(F.col("databaseId").alias("database_id"), "author__login", "author__name", "author__email",
                       "author__company", "author__location",
                       default_if_missing("commits.totalCount", 0).cast("long").alias("commit_count"),
                       F.col("milestone.title").alias("milestone_title"))


def _raw_tables(spark, sf_dir):
    raw_repo = ad.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.concat(F.lit("cust/"), F.col("c_name")).alias("full_name"))
    return {"pull_requests": ad.pull_requests_raw(spark, sf_dir), "releases": ad.releases_raw(spark, sf_dir), "repositories": raw_repo}


def q_quality_checks(spark, sf_dir):
    """Q1-Q3: the 22 declared data tests over sources, written bronze copies and silver, one read of each."""
    place = scratch(spark, "bronze")
    raw = _raw_tables(spark, sf_dir)
    bronze = {name: read_written(raw[entity], f"{place}/{name}") for entity, name in BRONZE.items()}
    silver = {"stg_pull_requests": silver_pull_requests(bronze["stg_github_pull_requests"]),
              "stg_releases": silver_releases(bronze["stg_github_releases"])}
    return data_tests({**raw, **bronze, **silver}, SOURCE_TESTS + BRONZE_TESTS + SILVER_TESTS)


SUPPLIED_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                   "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def q_row_counts(spark, sf_dir):
    """Rows per supplied table, plus distinct repositories of the PR adapter."""
    parts = [row_count(ad.table(spark, sf_dir, t), t) for t in SUPPLIED_TABLES]
    repos = distinct_keys(_silver_prs(spark, sf_dir), ["repository"])
    parts.append(row_count(repos, "distinct_repositories"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _as_json(df: DataFrame, *cols: str) -> DataFrame:
    """Nested columns as JSON text (NULL stays NULL), which both engines write alike."""
    return df.withColumns({c: F.to_json(c, {"ignoreNullFields": "false"}) for c in cols})


def q_legacy_pr_enrichment(spark, sf_dir):
    """M9: GraphQL pull requests joined to their repositories: every field, flattened and listed."""
    out = enrich_pull_requests(ad.gql_pull_requests(spark, sf_dir), ad.gql_repositories(spark, sf_dir))
    return _as_json(out, "author", "commits", "labels", "assignees", "reviewRequests", "reviews", "milestone")


def q_legacy_release_enrichment(spark, sf_dir):
    """GraphQL releases joined to their repositories: every field, asset counts and assets."""
    out = enrich_releases(ad.gql_releases(spark, sf_dir), ad.gql_repositories(spark, sf_dir))
    return _as_json(out, "author", "releaseAssets", "assets_data")


def _selection(spark, sf_dir, **how):
    out = select_repositories(ad.gql_repositories(spark, sf_dir), ad.existing_repositories(spark, sf_dir), **how)
    cols = ["databaseId", "nameWithOwner", "stargazerCount", "pushedAt", "repo_database_id", "topics", "languages_data"]
    return _as_json(out.select(*cols), "languages_data")


def q_repo_selection(spark, sf_dir):
    """Search, filter, cap by stars, skip loaded repositories, derive topics and languages."""
    return _selection(spark, sf_dir, search="machinery", max_repos=100, min_stars=1000)


def q_repo_selection_qualifiers(spark, sf_dir):
    """Push dates and star ranges as search qualifiers, archived repositories included, no cap."""
    return _selection(spark, sf_dir, search="segment pushed:>=2023-03-01 pushed:<2023-12-24 stars:500..4000", include_archived=True)


def q_repo_pushed_after(spark, sf_dir):
    """Pushed after a date; the four largest languages of each."""
    return _selection(spark, sf_dir, pushed_after="2023-10-01", languages_cap=4)


def q_semi_join(spark, sf_dir):
    """Pull requests of the ten busiest repositories (IN-subquery)."""
    prs = _silver_prs(spark, sf_dir)
    top = top_k_groups(equals_folded(prs, "feat_classifier", "feature"), "repository", 10)
    return semi_join(prs.select("id", "repository"), top, "repository", small=True)


def q_newest_first(spark, sf_dir):
    """The 100 newest orders."""
    o = ad.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return first_n(o, [F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc_nulls_last()], 100)


#: Large landings are compressed as downloads are (at a level that costs little time); such a file is one task, so files are kept short.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 25_000}


def _land(df: DataFrame, place: str, entity: str, repo=None, **how) -> None:
    """JSON Lines pages per repository, as Spark's writer lands them; ``repo`` lands all in one folder, ``how`` are its options."""
    with open_writers(df.sparkSession):
        (df.withColumn("repo", F.lit(repo) if repo else F.regexp_replace("repository_full_name", "/", "__"))
           .write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").option("ignoreNullFields", "false")
           .options(**how).partitionBy("repo").mode("append").json(f"{place}/entity={entity}"))


def _land_bad(spark, place: str, entity: str, rows: DataFrame) -> None:
    """Bad records and one unreadable page beside the good ones: ids that are no numbers, a bare number, broken text."""
    n = F.col("id").cast("string")
    lines = F.concat(F.lit('{"id": "x'), n, F.lit('"}\n7\n{"id": ['), n, F.lit("]}"))
    for repo, text in (("org__repo_1", lines), ("org__repo_2", F.concat(F.lit('[{"id": '), n, F.lit("}, {broken")))):
        rows.select(text.alias("value"), F.lit(repo).alias("repo")).coalesce(1) \
            .write.partitionBy("repo").mode("append").text(f"{place}/entity={entity}")


def _read_back(df: DataFrame, times: list[str]) -> DataFrame:
    return df.withColumns({t: F.col(t).cast("timestamp_ntz") for t in times})


def q_landing_pull_requests(spark, sf_dir):
    """Pull requests landed as pages among bad ones, read back record by record."""
    place = scratch(spark, "landing")
    raw = ad.pull_requests_raw(spark, sf_dir)
    _land(raw, place, "pull_requests")
    _land_bad(spark, place, "pull_requests", raw.where("id % 1000 = 0").select("id"))
    records, _ = read_pages(spark, place, "pull_requests")
    out = _read_back(records, ["created_at", "closed_at", "merged_at", "fetched_at"])
    return out.select("id", "number", "title", "body", "state", F.col("user.login").alias("login"), F.col("head.ref").alias("head_ref"),
                      nested_to_json("labels").alias("labels_json"), "additions", "created_at", "closed_at", "merged_at", "repository_full_name", "fetched_at")


def q_landing_gql_pull_requests(spark, sf_dir):
    """GraphQL pull requests with their ``nodes`` landed among bad pages; each list as names, and the rejects by reason."""
    place = scratch(spark, "landing")
    raw = ad.gql_pull_requests(spark, sf_dir)
    # as text: a partition column would take the place of the records' own ``repo``
    record = F.to_json(F.struct(*raw.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"})
    folder = F.concat(F.lit("cust__group_"), (F.col("databaseId") % 20).cast("string"))
    with open_writers(spark):
        (raw.select(record.alias("value"), folder.alias("repo")).write.options(**PACKED)
            .partitionBy("repo").text(f"{place}/entity=gql_pull_requests"))
    bad = raw.where("databaseId % 700 = 0").select("databaseId")
    text = F.concat(F.lit('{"databaseId": '), F.col("databaseId").cast("string"), F.lit(', "labels": {"nodes": "none"}}\n{"databaseId": 1, "commits": [2]}'))
    bad.select(text.alias("value"), F.lit("cust__group_1").alias("repo")).coalesce(1).write.partitionBy("repo").mode("append").text(f"{place}/entity=gql_pull_requests")
    records, rejects = read_pages(spark, place, "gql_pull_requests", stage=f"{place}/parsed")
    names = lambda c, f: F.array_join(field_names(c, f), ",")
    good = records.select(
        F.lit("record").alias("outcome"), F.col("databaseId").alias("database_id"), "repo", "title", F.col("author.login").alias("author_login"),
        F.col("commits.totalCount").alias("commits"), names("labels.nodes", "name").alias("labels"), names("assignees.nodes", "login").alias("assignees"),
        nested_count("reviews.nodes").cast("long").alias("n_reviews"), F.col("milestone.title").alias("milestone"), F.col("closedAt").cast("timestamp_ntz").alias("closed_at"))
    why = rejects.groupBy(F.col("_reason").alias("outcome")).agg(F.count("*").alias("database_id"))
    return good.unionByName(why, allowMissingColumns=True)


def q_discovered_children(spark, sf_dir):
    """Releases landed as text and read without a schema; the table of the asset list that discovery finds."""
    place = scratch(spark, "discover")
    raw = ad.gql_releases(spark, sf_dir)
    # compressed as downloads are; such a file is one task, so files are kept short
    raw.select(F.to_json(F.struct(*raw.columns)).alias("_json")).write.option("maxRecordsPerFile", 100_000).text(place, compression="gzip")
    records = spark.read.text(place).withColumnRenamed("value", "_json")
    typed = typed_records(records, discovered_schema(records))
    assets = child_tables(typed, ["databaseId"], "releases")["releases__releaseAssets__nodes"]
    return assets.select("databaseId", F.col("releaseAssets__nodes_pos").cast("long").alias("position"), "name", "size", "contentType")


def q_landing_releases(spark, sf_dir):
    """Releases landed among bad pages; rows read and rejected, by reason."""
    place = scratch(spark, "landing")
    raw = ad.releases_raw(spark, sf_dir)
    _land(raw, place, "releases")
    _land_bad(spark, place, "releases", raw.where("id % 500 = 0").select("id"))
    records, rejects = read_pages(spark, place, "releases", stage=f"{place}/parsed")
    return (records.select(F.lit("record").alias("outcome"), F.col("repository_full_name").alias("repository"))
                   .unionByName(rejects.select(F.col("_reason").alias("outcome"), repo_from_path().alias("repository")))
                   .groupBy("outcome", "repository").agg(F.count(F.lit(1)).alias("n")))


def _stored_releases(spark, sf_dir):
    """Releases with two keys that no schema names, landed among bad pages and kept as VARIANT."""
    place = scratch(spark, "variant")
    raw = ad.releases_raw(spark, sf_dir)
    stops = F.struct(F.concat(F.lit("by-"), (F.col("id") % 3).cast("string")).alias("mode"), F.array("id", F.col("id") + 1).alias("stops"))
    _land(raw.withColumns({"delivery": stops, "score": F.when(F.col("id") % 7 > 0, F.col("id") % 7)}), place, "releases")
    _land_bad(spark, place, "releases", raw.where("id % 500 = 0").select("id"))
    return store_records(spark, place, "releases", f"{place}/stored")


def q_variant_records(spark, sf_dir):
    """Typed fields of releases kept as VARIANT, with two values at paths that the schema doesn't name."""
    records, _ = read_typed(_stored_releases(spark, sf_dir), ENTITY_SCHEMAS["releases"])
    return records.select("id", "tag_name", F.col("published_at").cast("timestamp_ntz").alias("published_at"), "repository_full_name",
                          path_value("$.delivery.mode", "string").alias("delivery_mode"), path_value("$.delivery.stops[1]", "bigint").alias("second_stop"))


def q_variant_unknown_keys(spark, sf_dir):
    """Keys of landed releases that the schema doesn't name, by kind, and the rejects by reason."""
    stored = _stored_releases(spark, sf_dir)
    _, rejects = read_typed(stored, ENTITY_SCHEMAS["releases"])
    why = rejects.groupBy(F.lit(None).cast("string").alias("key"), F.col("_reason").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return unknown_keys(stored.where(path_value("$.tag_name", "string").isNotNull()), ENTITY_SCHEMAS["releases"]).unionByName(why)


def q_upsert_persisted(spark, sf_dir):
    """Two persisted loads; the later one has fewer columns, equal and NULL stamps, and NULL keys."""
    o = ad.table(spark, sf_dir, "orders")
    table = f"{scratch(spark, 'upsert')}/orders"
    first = o.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("fetched_at"))
    second = o.where("o_orderkey % 3 = 0").select(
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("id"), (F.col("o_totalprice") * 2).alias("price"),
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate")).alias("fetched_at"))
    for load in (first, second):
        upsert_parquet(spark, table, load, ["id"], ["fetched_at"])
    return read_current(spark, table)


def _kept_state(spark, sf_dir, gaps: bool) -> str:
    """Three loads of pull requests: many come open, late or under another title first and are changed later."""
    place = scratch(spark, "maintained")
    raw = ad.pull_requests_raw(spark, sf_dir)
    turn = F.pmod(F.xxhash64("id"), F.lit(5))
    early = raw.where(turn % 2 == 0).withColumns({
        "closed_at": F.when(turn == 2, F.col("closed_at")).when(turn == 4, F.timestamp_add("DAY", F.lit(40), "closed_at")),
        "title": F.when(turn == 2, F.lit("Add a draft")).otherwise(F.col("title"))})
    loads = [early.unionByName(raw.where(turn == 1)), raw.where(turn.isin(0, 2)), raw.where(turn.isin(3, 4))]
    for load in loads:
        done = upsert_parquet(spark, f"{place}/pull_requests", load, ["id"], ["fetched_at"], buckets=8, changes=True, kept=True)
        changed = read_changes(spark, f"{place}/pull_requests", done.version)
        before, after = (silver_pull_requests(changed.where(F.col("_change") == sign)).withColumn("_change", F.lit(sign)) for sign in (-1, 1))
        apply_load(spark, f"{place}/state", event_changes(before.unionByName(after)), done.version, gaps)
    return f"{place}/state"


def q_median_gap_maintained(spark, sf_dir):
    """M5, A4: the stored medians after three loads, each applied from its changed rows; compacted, then read."""
    state = _kept_state(spark, sf_dir, gaps=True)
    compact_state(spark, state)
    return kept_median_gap(spark, state, **_PR_GOLD)


def q_monthly_counts_maintained(spark, sf_dir):
    """M3 from signed deltas of three loads."""
    return kept_counts(spark, _kept_state(spark, sf_dir, gaps=False))


def q_incremental_releases(spark, sf_dir):
    """Releases landed in two drops, each drained by the stream into the table."""
    place = scratch(spark, "stream")
    raw = ad.releases_raw(spark, sf_dir)
    for part in (F.col("prerelease"), ~F.col("prerelease")):
        _land(raw.where(part), f"{place}/landing", "releases")
        incremental_upsert(spark, f"{place}/landing", "releases", f"{place}/table", f"{place}/checkpoint").awaitTermination()
    out = _read_back(read_current(spark, f"{place}/table"), ["published_at", "fetched_at"])
    return out.select("id", "tag_name", "published_at", "repository_full_name", "fetched_at")


def q_exported_models(spark, sf_dir):
    """Silver releases materialised, exported and read back."""
    place = scratch(spark, "export")
    materialize(_silver_rel(spark, sf_dir), path=f"{place}/stg_releases")
    report = export_models(spark, {"stg_releases": lambda: read_model(spark, f"{place}/stg_releases"), "absent": "repolens_no_such_table"}, place)
    back = spark.read.parquet(f"{place}/stg_releases.parquet")
    return back.select("id", "repository", "tag", "published_at", F.lit(report["stg_releases"]).cast("long").alias("rows_reported"), F.lit(str(report["absent"])).alias("absent"))


def q_job_tables(spark, sf_dir):
    """The full job over landed pages; its six gold tables as one (model, repository, grp, month, value)."""
    place = scratch(spark, "job")
    raw = _raw_tables(spark, sf_dir)
    _land(raw["pull_requests"], f"{place}/landing", "pull_requests", **PACKED)
    _land(raw["releases"], f"{place}/landing", "releases", **PACKED)
    _land(raw["repositories"], f"{place}/landing", "repositories", "cust__all", **PACKED)
    done = run_job(spark, f"{place}/landing", f"{place}/warehouse", **_PR_GOLD)
    if odd := {k: v for k, v in done["gold"].items() if not isinstance(v, int)}:
        raise RuntimeError(str(odd))
    out = None
    for model, (group, month, value) in GOLD_COLUMNS.items():
        m = read_model(spark, f"{place}/warehouse/gold/{model}")
        null = lambda t: F.lit(None).cast(t)
        part = m.select(F.lit(model).alias("model"), "repository", (F.col(group) if group else null("string")).alias("grp"),
                        (F.col(month) if month else null("timestamp_ntz")).alias("month"), F.col(value).cast("double").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def q_job_report(spark, sf_dir):
    """The full job with issues, bad pages and export: rows and rejects by reason, the 22 checks, exported rows."""
    place = scratch(spark, "job")
    raw = _raw_tables(spark, sf_dir)
    _land(raw["pull_requests"], f"{place}/landing", "pull_requests", **PACKED)
    _land_bad(spark, f"{place}/landing", "pull_requests", raw["pull_requests"].where("id % 1000 = 0").select("id"))
    _land(raw["releases"], f"{place}/landing", "releases", **PACKED)
    _land(raw["repositories"], f"{place}/landing", "repositories", "cust__all", **PACKED)
    issues = ad.issue_records(spark, sf_dir).select(F.col("record").alias("value"), F.regexp_replace("repository_full_name", "/", "__").alias("repo"))
    with open_writers(spark):
        issues.write.options(**PACKED).partitionBy("repo").text(f"{place}/landing/entity=issues")
    run_job(spark, f"{place}/landing", f"{place}/warehouse", export_dir=f"{place}/export", **_PR_GOLD)
    summary = read_model(spark, f"{place}/warehouse/summary").select(F.lit("raw").alias("part"), F.col("entity").alias("name"), F.col("outcome").alias("detail"), "n")
    checks = read_model(spark, f"{place}/warehouse/checks").select(
        F.lit("check").alias("part"), F.col("model").alias("name"), F.concat_ws(" ", "test", "column_name").alias("detail"), F.col("failures").alias("n"))
    out = summary.unionByName(checks)
    for m in EXPORTED_MODELS:
        out = out.unionByName(row_count(spark.read.parquet(f"{place}/export/{m}.parquet"), m).select(
            F.lit("export").alias("part"), F.col("table_name").alias("name"), F.lit("rows").alias("detail"), F.col("row_count").alias("n")))
    return out


def q_issue_cleaning(spark, sf_dir):
    """Drop pull requests listed as issues (key presence), cap 5 per repository, dedup by id."""
    recs = lacks_json_key(ad.issue_records(spark, sf_dir), "record", "pull_request")
    issues = recs.select(F.from_json("record", "id long, title string").alias("r"), "repository_full_name", "updated_at", "fetched_at") \
                 .select("r.*", "repository_full_name", "updated_at", "fetched_at", F.lit("open").alias("state"))
    return clean_issues(issues, state="all", max_per_repo=5).select(
        "id", "repository_full_name", "title", "updated_at")


def q_classify_documents(spark, sf_dir):
    """F1-F3 on real text: the rule chain over each document's whole text (every row, every character)."""
    docs = ad.table(spark, sf_dir, "documents")
    return docs.select("doc_id", "lang", classify_title("text").alias("feat_classifier"))


def q_bronze_copy(spark, sf_dir):
    """S3 + S4: a parquet scan registered as the raw source, read back as a full bronze copy."""
    scan_parquet(spark, f"{sf_dir.rstrip('/')}/orders.parquet").createOrReplaceTempView("repolens_raw_orders")
    return catalog_table(spark, "repolens_raw_orders")


def q_projected_scan(spark, sf_dir):
    """S3: a parquet scan with a projection."""
    return scan_parquet(spark, f"{sf_dir.rstrip('/')}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"])


def q_existing_lookup(spark, sf_dir):
    """The first available source of stored repositories (a missing table is skipped)."""
    schema = StructType([StructField("c_custkey", LongType()), StructField("c_name", StringType())])
    return existing_or_empty(spark, ["repolens_no_such_table", f"{sf_dir.rstrip('/')}/customer.parquet"], schema)


def q_stamp_provenance(spark, sf_dir):
    """Stamp repository and fetch time from the landing unless the record carries them."""
    o = ad.table(spark, sf_dir, "orders")
    recs = o.select("o_orderkey",
                    F.when(F.col("o_orderstatus") == "F", ad._cust_repo("o_custkey")).alias("repository_full_name"),
                    F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate")).alias("fetched_at"),
                    F.concat(F.lit("landing/"), F.col("o_custkey").cast("string")).alias("_landing_repo"),
                    (F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS")).alias("_file_time"))
    return stamp_provenance(recs, repo="_landing_repo", fetched_at="_file_time").drop("_landing_repo", "_file_time")


def q_model_row_counts(spark, sf_dir):
    """M13 without the landing: silver written once, gold models over it, rows per exported model."""
    place = scratch(spark, "models")
    silver = {"stg_pull_requests": read_written(_silver_prs(spark, sf_dir), f"{place}/stg_pull_requests"),
              "stg_releases": read_written(_silver_rel(spark, sf_dir), f"{place}/stg_releases")}
    models = {m: (lambda m=m: silver[m]) for m in silver} | gold_models(silver["stg_pull_requests"], silver["stg_releases"], **_PR_GOLD)
    parts = [row_count(models[m](), m, name_col="model") for m in EXPORTED_MODELS]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


QUERIES: dict[str, QueryFn] = {
    "classify_titles": q_classify_titles,
    "silver_pull_requests": q_silver_pull_requests,
    "dedup_latest_release": q_dedup_latest_release,
    "monthly_counts": q_monthly_counts,
    "monthly_releases": q_monthly_releases,
    "topk_groups": q_topk_groups,
    "topk_by_summary": q_topk_by_summary,
    "median_gap_sketched": q_median_gap_sketched,
    "focus_vs_topk_prs": q_focus_vs_topk_prs,
    "focus_vs_topk_releases": q_focus_vs_topk_releases,
    "median_gap_prs": q_median_gap_prs,
    "median_gap_releases": q_median_gap_releases,
    "existence_flag": q_existence_flag,
    "new_entities_anti": q_new_entities_anti,
    "fk_enrich": q_fk_enrich,
    "state_filter": q_state_filter,
    "repo_filter": q_repo_filter,
    "allow_list": q_allow_list,
    "search_terms": q_search_terms,
    "search_index": q_search_index,
    "split_name": q_split_name,
    "split_name_rejects": q_split_name_rejects,
    "recent_n_per_key": q_recent_n_per_key,
    "nested_names": q_nested_names,
    "nested_json": q_nested_json,
    "nested_count": q_nested_count,
    "nested_topk": q_nested_topk,
    "nested_cap": q_nested_cap,
    "child_rows": q_child_rows,
    "key_presence_filter": q_key_presence_filter,
    "upsert_latest": q_upsert_latest,
    "null_safe_defaults": q_null_safe_defaults,
    "quality_checks": q_quality_checks,
    "row_counts": q_row_counts,
    "legacy_pr_enrichment": q_legacy_pr_enrichment,
    "legacy_release_enrichment": q_legacy_release_enrichment,
    "repo_selection": q_repo_selection,
    "repo_selection_qualifiers": q_repo_selection_qualifiers,
    "repo_pushed_after": q_repo_pushed_after,
    "semi_join": q_semi_join,
    "newest_first": q_newest_first,
    "landing_pull_requests": q_landing_pull_requests,
    "landing_releases": q_landing_releases,
    "discovered_children": q_discovered_children,
    "variant_records": q_variant_records,
    "variant_unknown_keys": q_variant_unknown_keys,
    "landing_gql_pull_requests": q_landing_gql_pull_requests,
    "upsert_persisted": q_upsert_persisted,
    "median_gap_maintained": q_median_gap_maintained,
    "monthly_counts_maintained": q_monthly_counts_maintained,
    "incremental_releases": q_incremental_releases,
    "exported_models": q_exported_models,
    "job_tables": q_job_tables,
    "job_report": q_job_report,
    "projected_scan": q_projected_scan,
    "issue_cleaning": q_issue_cleaning,
    "model_row_counts": q_model_row_counts,
    "classify_documents": q_classify_documents,
    "bronze_copy": q_bronze_copy,
    "existing_lookup": q_existing_lookup,
    "stamp_provenance": q_stamp_provenance,
}
