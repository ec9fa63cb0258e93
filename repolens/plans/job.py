"""The full job - landed pages -> raw (cap, upsert) -> bronze -> silver -> gold -> checks -> export.

Each model is materialised as a new version of its folder and the next layer reads the written rows back:
the lineage is cut at every layer, so a lost executor only recomputes from the last written table, and the
silver tables are scanned once per gold model with column pruning instead of recomputing classification
and dedup. A failing gold model is reported and the others go on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.classify import CLASSES
from ..operators.quality import TableTests, summarize
from ..sinks.upsert import read_current, upsert_parquet
from ..sinks.writers import export_models, layer, write_summary
from ..operators.filters import allow_list, state_filter
from ..operators.windows import recent_n_per_key
from ..sources.landing import read_issue_pages, read_pages
from ..sources.tables import is_missing
from .issues import clean_issues
from ..schemas import ENTITY_SCHEMAS
from ..session import small_files
from .gold import (DEFAULT_FOCUS, DEFAULT_FOCUS_LABEL, DEFAULT_K, DEFAULT_MEMBER_LABEL, focus_vs_top_k,
                   median_gap, monthly_counts)
from .silver import silver_pull_requests, silver_releases

# The exported model list, in the reference's order.
EXPORTED_MODELS = ["stg_pull_requests", "stg_releases", "feature_prs_monthly", "feature_releases_monthly",
                   "feature_prs_lace_vs_top10", "feature_releases_lace_vs_top10",
                   "median_feature_prs_lace_vs_top10", "median_releases_lace_vs_top10"]
#: Raw tables that have a bronze copy, and its name.
BRONZE = {"pull_requests": "stg_github_pull_requests", "releases": "stg_github_releases",
          "repositories": "stg_github_repositories"}
RAW_JSON = "_raw"

#: The declared data tests of every layer (Q1-Q3).
SOURCE_TESTS = [TableTests("pull_requests", not_null=["id", "repository_full_name"], unique=["id"]),
                TableTests("releases", not_null=["id", "repository_full_name"], unique=["id"]),
                TableTests("repositories", not_null=["id", "full_name"], unique=["id"])]
BRONZE_TESTS = [TableTests(BRONZE[name], not_null=["id"], unique=["id"]) for name in BRONZE]
SILVER_TESTS = [TableTests("stg_pull_requests", not_null=["repository", "number", "feat_classifier"],
                           accepted_values={"feat_classifier": list(CLASSES)}),
                TableTests("stg_releases", not_null=["repository", "tag", "row_num"])]


def gold_models(prs: DataFrame, rels: DataFrame, focus: str | None = DEFAULT_FOCUS,
                focus_label: str = DEFAULT_FOCUS_LABEL, k: int = DEFAULT_K,
                member_label: str = DEFAULT_MEMBER_LABEL) -> dict[str, Callable[[], DataFrame]]:
    """The six gold models over silver PRs and releases (no final sort: they are tables).

    Each is a function, as some run jobs (checkpoints) while they are planned.
    """
    g = dict(focus=focus, focus_label=focus_label, k=k, member_label=member_label)
    rel = dict(ts_col="published_at", class_col=None)
    month = dict(month_col="release_month", count_col="feature_release_count")
    return {
        "feature_prs_monthly": lambda: monthly_counts(prs),
        "feature_releases_monthly": lambda: monthly_counts(rels, **month, **rel),
        "feature_prs_lace_vs_top10": lambda: focus_vs_top_k(prs, **g),
        "feature_releases_lace_vs_top10": lambda: focus_vs_top_k(rels, **month, **rel, **g),
        "median_feature_prs_lace_vs_top10": lambda: median_gap(prs, **g),
        "median_releases_lace_vs_top10": lambda: median_gap(rels, out_col="median_days_between_releases", **rel, **g),
    }


def data_tests(tables: dict[str, DataFrame], tests: list[TableTests]) -> DataFrame:
    """One row per declared test of the given tables (by model name): each table is read once."""
    out = None
    for t in tests:
        part = summarize(tables[t.model], t)
        out = part if out is None else out.unionByName(part)
    return out


def cap_per_repository(df: DataFrame, n: int | None, newest_first: list[str],
                       repo_col: str = "repository_full_name") -> DataFrame:
    """The API's per-repository cap on landed data (0/None = unlimited, negative = none)."""
    order = [F.col(c).desc_nulls_last() for c in newest_first] + [F.col("id").desc_nulls_last()]
    return recent_n_per_key(df, [repo_col], order, n, rank_col=None)


def run_job(spark: SparkSession, landing: str, warehouse: str, export_dir: str | None = None,
            repos: list[str] | None = None, state: str = "all", max_prs_per_repo: int | None = None,
            max_releases_per_repo: int | None = None, max_issues_per_repo: int | None = None,
            **gold_kw) -> dict:
    """Run every layer; returns rows and rejects per raw table, check failures, gold and export reports.

    The rows stored and the rejects by reason are also a table, ``<warehouse>/summary`` (entity, outcome, n).

    ``repos`` is the repository allow-list (P11); ``state`` filters pull requests and issues (P7); the caps
    keep the most recently updated pull requests and issues and the newest releases per repository (W3).
    Raw tables keep each record's JSON text beside the typed columns. An entity for which nothing landed
    keeps what is stored, and is empty at first.
    """
    root = warehouse.rstrip("/")
    loads = {
        "repositories": (lambda **how: read_pages(spark, landing, "repositories", repos=repos, raw_col=RAW_JSON, **how),
                         lambda df: allow_list(df, "full_name", repos)),
        "pull_requests": (lambda **how: read_pages(spark, landing, "pull_requests", repos=repos, raw_col=RAW_JSON, **how),
                          lambda df: cap_per_repository(state_filter(allow_list(df, "repository_full_name", repos), state), max_prs_per_repo, ["updated_at"])),
        "releases": (lambda **how: read_pages(spark, landing, "releases", repos=repos, raw_col=RAW_JSON, **how),
                     lambda df: cap_per_repository(allow_list(df, "repository_full_name", repos), max_releases_per_repo, ["created_at"])),
        "issues": (lambda **how: read_issue_pages(spark, landing, repos=repos, raw_col=RAW_JSON, **how),
                   lambda df: clean_issues(allow_list(df, "repository_full_name", repos), state, max_issues_per_repo)),
    }
    ranked = {"issues"} | {e for e, n in (("pull_requests", max_prs_per_repo), ("releases", max_releases_per_repo)) if n}
    raw, raw_rows, raw_rejects, outcomes = {}, {}, {}, []
    with small_files(spark):    # not the export, which others read
        for entity, (read, shape) in loads.items():
            table = f"{root}/raw/{entity}"
            try:
                records, rejects = read(stage=f"{root}/parsed/{entity}")  # replaced by the next run
            except AnalysisException as e:
                if not is_missing(e):
                    raise
            else:
                # the parsed records stay; only what ranks them (caps, the issues' dedup) is worked out into a copy
                done = upsert_parquet(spark, table, shape(records).drop("_source_file"), ["id"], ["fetched_at"], kept=entity not in ranked)
                reasons = layer(rejects, f"{root}/rejects/{entity}").groupBy("_reason").agg(F.count("*").alias("n")).collect()  # a handful
                outcomes += [(entity, r["_reason"], r["n"]) for r in reasons] + [(entity, "no key", done.rejected)] * bool(done.rejected)
                raw_rejects[entity] = sum(n for e, _, n in outcomes if e == entity)
            raw[entity] = read_current(spark, table)
            if raw[entity] is None:
                raw[entity] = spark.createDataFrame([], ENTITY_SCHEMAS[entity])
            raw_rows[entity] = raw[entity].count()
            outcomes.append((entity, "stored", raw_rows[entity]))
        write_summary(spark, root, outcomes)
        bronze = {name: layer(raw[entity], f"{root}/bronze/{name}") for entity, name in BRONZE.items()}
        # partitioned by class (a fixed six-value vocabulary): the gold PR models' class filter becomes
        # partition pruning, so they read only the feature folder
        silver = {
            "stg_pull_requests": layer(silver_pull_requests(bronze["stg_github_pull_requests"]),
                                        f"{root}/silver/stg_pull_requests", partition_by=["feat_classifier"]),
            "stg_releases": layer(silver_releases(bronze["stg_github_releases"]), f"{root}/silver/stg_releases"),
        }
        models, gold = dict(silver), {}
        for name, build in gold_models(silver["stg_pull_requests"], silver["stg_releases"], **gold_kw).items():
            try:
                models[name] = layer(build(), f"{root}/gold/{name}")
                gold[name] = models[name].count()
            except Exception as e:  # noqa: BLE001 - one model must not stop the others
                gold[name] = f"error: {type(e).__name__}: {e}"
        tests = data_tests({**raw, **bronze, **silver}, SOURCE_TESTS + BRONZE_TESTS + SILVER_TESTS)
        results = layer(tests, f"{root}/checks")
        checks = {(r["model"], r["test"], r["column_name"]): r["failures"] for r in results.collect()}    # 22 rows
    report = {}
    if export_dir:
        report = export_models(spark, {m: (lambda m=m: models[m]) for m in EXPORTED_MODELS if m in models}, export_dir)
    return {"raw_rows": raw_rows, "rejects": raw_rejects, "checks": checks, "gold": gold, "export": report}
