"""Deterministic adapters that shape the supplied test tables into the entities' raw shapes.

The supplied tables hold no repository data, so every named model is driven
through one fixed mapping (the same expressions appear in the SQL twins in
:mod:`.oracle`). No rows are dropped: every input row becomes one record.

* pull requests  <- ``events``  (event_id, ts, user_id, event_type, value, props)
* releases       <- ``orders``  (o_orderkey, o_custkey, o_orderstatus, o_orderdate, ...)
* repositories   <- ``customer`` (+ ``nation``)
* nested lists   <- ``lineitem`` (lists built from each row's own fields)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Adapter settings shared with the SQL twins.
REPO_PREFIX = "org/repo_"
REPO_BUCKETS = 25
ADAPTER_FOCUS = "org/repo_3"
ADAPTER_FOCUS_LABEL = "repo_3"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _repo(col: str) -> F.Column:
    return F.concat(F.lit(REPO_PREFIX), (F.col(col) % REPO_BUCKETS).cast("string"))


def pr_title() -> F.Column:
    eid = F.col("event_id")
    by_type = (F.when(F.col("event_type") == "error", "Fix bug in module")
                .when(F.col("event_type") == "click", "Add feature")
                .when(F.col("event_type") == "purchase", "Refactor module")
                .when(F.col("event_type") == "signup", "Implement staking")
                .otherwise("Misc"))
    return (F.when(eid % 19 == 0, F.lit(None).cast("string"))
             .when(eid % 13 == 0, F.lit("Test harness"))
             .when(eid % 17 == 0, F.lit("Update docs"))
             .otherwise(by_type))


def pull_requests_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REST-shaped pull requests (nested ``user``/``base``/``head``/``labels``) from ``events``."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    open_pr = eid % 7 == 0
    closed = F.when(open_pr, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts"))
    labels = F.when(eid % 11 == 0, F.lit(None)).otherwise(F.array(
        F.struct(F.col("event_type").alias("name")),
        F.struct(F.when(F.col("value") > 25, F.lit("large")).otherwise(F.lit(None).cast("string")).alias("name"))))
    return ev.select(
        eid.alias("id"),
        eid.alias("number"),
        pr_title().alias("title"),
        F.col("props").alias("body"),
        F.when(open_pr, F.lit("open")).otherwise(F.lit("closed")).alias("state"),
        F.struct(F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("login")).alias("user"),
        F.struct(F.lit("main").alias("ref")).alias("base"),
        F.struct(F.concat(F.lit("feature/"), F.col("event_type")).alias("ref")).alias("head"),
        labels.alias("labels"),
        F.concat(F.lit("https://example.invalid/pull/"), eid.cast("string")).alias("html_url"),
        F.floor(F.col("value")).cast("long").alias("additions"),
        F.col("user_id").alias("deletions"),
        F.lit(None).cast("long").alias("changed_files"),
        F.lit(1).cast("long").alias("commits"),
        F.col("ts").alias("created_at"),
        closed.alias("closed_at"),
        F.when(F.col("event_type") != "view", closed).alias("merged_at"),
        _repo("user_id").alias("repository_full_name"),
        F.col("ts").alias("fetched_at"),
    )


def releases_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """REST-shaped releases from ``orders``; tags repeat so (repository, tag) has copies."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("id"),
        F.concat(F.lit("v"), (key % 400).cast("string")).alias("tag_name"),
        F.concat(F.lit("Release "), key.cast("string")).alias("name"),
        F.col("o_orderpriority").alias("body"),
        (F.col("o_orderstatus") == "P").alias("draft"),
        (F.col("o_orderstatus") == "O").alias("prerelease"),
        F.struct(F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("login")).alias("author"),
        F.concat(F.lit("https://example.invalid/release/"), key.cast("string")).alias("html_url"),
        F.when(key % 11 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("o_orderdate")).alias("published_at"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        _repo("o_custkey").alias("repository_full_name"),
        F.col("o_orderdate").alias("fetched_at"),
    )


def repositories_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GraphQL-shaped repositories from ``customer`` (stars = account balance)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("databaseId"),
        F.concat(F.lit("cust/"), F.col("c_name")).alias("nameWithOwner"),
        F.col("c_name").alias("name"),
        F.concat_ws(" ", F.lit("segment"), F.col("c_mktsegment")).alias("description"),
        F.col("c_acctbal").alias("stargazerCount"),
        (F.col("c_mktsegment") == "AUTOMOBILE").alias("isArchived"),
        F.col("c_nationkey").alias("nation_key"),
    )


def nested_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with GraphQL-like nested lists, built from each ``lineitem`` row's own fields.

    ``labels`` is NULL for line 1, empty for line 2, three entries otherwise
    (one with a NULL name); ``edges`` are four (size, node) pairs.
    """
    li = table(spark, sf_dir, "lineitem")
    ln = F.col("l_linenumber")
    entries = F.array(F.struct(F.col("l_returnflag").alias("name")),
                      F.struct(F.col("l_linestatus").alias("name")),
                      F.struct(F.when(F.col("l_quantity") > 25, F.lit(None).cast("string"))
                                .otherwise(F.lit("small")).alias("name")))
    labels = (F.when(ln == 1, F.lit(None))
               .when(ln == 2, F.array().cast("array<struct<name:string>>"))
               .otherwise(entries))

    def edge(size, name, color):
        return F.struct(size.cast("double").alias("size"),
                        F.struct(F.lit(name).alias("name"), color.alias("color")).alias("node"))
    edges = F.array(edge(F.col("l_quantity"), "quantity", F.col("l_returnflag")),
                    edge(F.col("l_extendedprice") / 100, "price", F.col("l_linestatus")),
                    edge(F.col("l_tax") * 100, "tax", F.lit(None).cast("string")),
                    edge(F.col("l_discount") * 100, "discount", F.col("l_returnflag")))
    return li.select("l_orderkey", "l_linenumber", labels.alias("labels"), edges.alias("edges"))


def _cust_repo(col: str) -> F.Column:
    """``cust/Customer#000000042`` - the repository name the ``customer`` adapter gives key 42."""
    return F.concat(F.lit("cust/Customer#"), F.lpad(F.col(col).cast("string"), 9, "0"))


def _days_from(start: str, days: F.Column) -> F.Column:
    """A zone-less timestamp some days after a date."""
    return F.date_add(F.lit(start).cast("date"), days.cast("int")).cast("timestamp_ntz")


def gql_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GraphQL-shaped repositories from ``customer`` with topic nodes, languages and a push date (NULL for some)."""
    c = table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    topics = F.struct(F.array(
        F.struct(F.struct(F.lower(F.col("c_mktsegment")).alias("name")).alias("topic")),
        F.struct(F.struct(F.concat(F.lit("nation-"), F.col("c_nationkey").cast("string")).alias("name"))
                 .alias("topic"))).alias("nodes"))
    edges = F.transform(F.sequence(F.lit(0), (key % 13).cast("int")), lambda i: F.struct(
        (key * (i + 1) % 101).cast("long").alias("size"),
        F.struct(F.concat(F.lit("lang-"), i.cast("string")).alias("name"), F.lit(None).cast("string").alias("color")).alias("node")))
    languages = F.struct((key % 1000).cast("long").alias("totalSize"), edges.alias("edges"))
    return c.select(
        key.alias("databaseId"),
        F.concat(F.lit("cust/"), F.col("c_name")).alias("nameWithOwner"),
        F.concat(F.lit("segment "), F.col("c_mktsegment")).alias("description"),
        F.col("c_acctbal").alias("stargazerCount"),
        (F.col("c_mktsegment") == "AUTOMOBILE").alias("isArchived"),
        F.when(key % 10 != 0, _days_from("2023-01-01", key % 400)).alias("pushedAt"),
        F.when(key % 7 != 0, languages).alias("languages"),
        topics.alias("repositoryTopics"),
    )


def existing_repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repositories 'already loaded': customers of the nations in region 1."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == 1)
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner")
             .select(F.concat(F.lit("cust/"), F.col("c_name")).alias("nameWithOwner")))


def _nodes(n: F.Column, make) -> F.Column:
    """``{nodes: [make(1), ..., make(n)]}``."""
    return F.struct(F.transform(F.sequence(F.lit(1), n.cast("int")), make).alias("nodes"))


def _numbered(prefix: str, i: F.Column) -> F.Column:
    return F.concat(F.lit(prefix), i.cast("string"))


def gql_pull_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GraphQL-shaped pull requests from ``orders`` (``repo`` points at the customer adapter), lists of 1 to 30 entries."""
    o = table(spark, sf_dir, "orders")
    st, key = F.col("o_orderstatus"), F.col("o_orderkey")
    none = F.lit(None).cast("string")
    login = F.concat(F.lit("cust_"), F.col("o_custkey").cast("string"))
    author = F.when(st != "P", F.struct(login.alias("login"), none.alias("name"), none.alias("email"),
                                        F.col("o_orderpriority").alias("company"), none.alias("location")))
    commits = F.when(st != "F", F.struct((F.col("o_custkey") % 7).alias("totalCount")))
    n = F.col("o_custkey") % 30 + 1
    labels = _nodes(n, lambda i: F.struct(_numbered("label-", i).alias("name"), none.alias("color"), F.col("o_orderpriority").alias("description")))
    assignees = _nodes(n, lambda i: F.struct(_numbered("dev-", i).alias("login"), none.alias("name")))
    requests = _nodes(key % 3 + 1, lambda i: F.struct(F.struct(_numbered("reviewer-", i).alias("login"), none.alias("name")).alias("requestedReviewer")))
    reviews = F.when(key % 4 != 0, _nodes(key % 3 + 1, lambda i: F.struct(
        F.struct(_numbered("reviewer-", i).alias("login")).alias("author"), F.lit("APPROVED").alias("state"), none.alias("createdAt"))))
    milestone = F.when(F.col("o_orderpriority") == "1-URGENT",
                       F.struct(F.lit("urgent").alias("title"), F.lit("OPEN").alias("state"), none.alias("dueOn")))
    closed = F.when(st != "O", F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS"))
    return o.select(
        key.alias("databaseId"), key.alias("number"),
        F.concat(F.lit("Order "), F.col("o_orderpriority")).alias("title"),
        F.concat(F.lit("**"), F.col("o_orderpriority"), F.lit("**")).alias("body"), F.col("o_orderpriority").alias("bodyText"),
        F.when(st == "O", "OPEN").when(st == "F", "MERGED").otherwise("CLOSED").alias("state"),
        _numbered("https://example.invalid/pr/", key).alias("url"),
        F.col("o_orderdate").alias("createdAt"), (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("updatedAt"),
        closed.alias("closedAt"), F.when(st == "F", closed).alias("mergedAt"), F.lit("UNKNOWN").alias("mergeable"),
        (key % 900).alias("additions"), (key % 70).alias("deletions"), (key % 12).alias("changedFiles"),
        author.alias("author"), F.lit("main").alias("baseRefName"), _numbered("topic/", key).alias("headRefName"),
        commits.alias("commits"), labels.alias("labels"), assignees.alias("assignees"),
        requests.alias("reviewRequests"), reviews.alias("reviews"),
        milestone.alias("milestone"), _cust_repo("o_custkey").alias("repo"),
    )


def gql_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GraphQL-shaped releases from ``orders``: 0 to 30 assets by customer."""
    o = table(spark, sf_dir, "orders")
    st, key = F.col("o_orderstatus"), F.col("o_orderkey")
    none = F.lit(None).cast("string")
    asset = lambda i: F.struct(_numbered("bundle-", i).alias("name"), (F.col("o_custkey") * i).cast("long").alias("size"),
                               F.lit(0).cast("long").alias("downloadCount"), F.lit("application/octet-stream").alias("contentType"), none.alias("url"))
    n = F.col("o_custkey") % 31
    empty = F.struct(F.array().cast("array<struct<name:string,size:bigint,downloadCount:bigint,contentType:string,url:string>>").alias("nodes"))
    return o.select(
        key.alias("databaseId"), _numbered("Release ", key).alias("name"), _numbered("v", key).alias("tagName"),
        F.col("o_orderpriority").alias("description"), _numbered("https://example.invalid/release/", key).alias("url"),
        F.col("o_orderdate").alias("createdAt"), F.when(key % 11 != 0, F.col("o_orderdate")).alias("publishedAt"),
        F.col("o_orderdate").alias("updatedAt"), (key % 5 == 0).alias("isLatest"), (st == "O").alias("isPrerelease"), (st == "P").alias("isDraft"),
        F.struct(F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("login"), none.alias("name")).alias("author"),
        F.when(n == 0, empty).otherwise(_nodes(F.greatest(n, F.lit(1)), asset)).alias("releaseAssets"),
        _cust_repo("o_custkey").alias("repo"),
    )


def issue_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw issue records as JSON text from ``events``: a quarter carry a ``pull_request`` object,
    a quarter an explicit ``"pull_request": null``, half have no such key."""
    ev = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    base = F.concat(F.lit('{"id": '), eid.cast("string"), F.lit(', "title": "'), F.col("event_type"), F.lit('"'))
    rec = (F.when(eid % 4 == 0, F.concat(base, F.lit(', "pull_request": {"url": "x"}}')))
            .when(eid % 4 == 1, F.concat(base, F.lit(', "pull_request": null}')))
            .otherwise(F.concat(base, F.lit("}"))))
    return ev.select(eid.alias("event_id"), _repo("user_id").alias("repository_full_name"),
                     F.col("ts").alias("updated_at"), F.col("ts").alias("fetched_at"), rec.alias("record"))
