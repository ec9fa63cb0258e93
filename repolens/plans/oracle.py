"""SQL twins of the registered queries, runnable by DuckDB on the supplied tables.

The CTEs over the supplied tables mirror the adapters in :mod:`.adapters`. The models are stated from their
semantics (survey, section 2), not from the engine: the title rules as a table of ranked words, the release
dedup as "no later row exists", ranks as the number of keys ahead, the median by explicit positions.
Column names are fixed: they must equal the engine's.
"""

from __future__ import annotations


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body}"


PR_RAW = """
pr_raw AS (
  SELECT event_id AS id, event_id AS number,
    CASE WHEN event_id % 19 = 0 THEN NULL
         WHEN event_id % 13 = 0 THEN 'Test harness'
         WHEN event_id % 17 = 0 THEN 'Update docs'
         ELSE CASE event_type WHEN 'error' THEN 'Fix bug in module' WHEN 'click' THEN 'Add feature'
                              WHEN 'purchase' THEN 'Refactor module' WHEN 'signup' THEN 'Implement staking'
                              ELSE 'Misc' END END AS title,
    props AS body,
    CASE WHEN event_id % 7 = 0 THEN 'open' ELSE 'closed' END AS state,
    {'login': 'user_' || CAST(user_id AS VARCHAR)} AS "user",
    {'ref': 'main'} AS base,
    {'ref': 'feature/' || event_type} AS head,
    CASE WHEN event_id % 11 = 0 THEN NULL
         ELSE [{'name': event_type}, {'name': CASE WHEN value > 25 THEN 'large' ELSE NULL END}] END AS labels,
    'https://example.invalid/pull/' || CAST(event_id AS VARCHAR) AS html_url,
    CAST(floor(value) AS BIGINT) AS additions,
    user_id AS deletions,
    CAST(NULL AS BIGINT) AS changed_files,
    CAST(1 AS BIGINT) AS commits,
    ts AS created_at,
    CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END AS closed_at,
    CASE WHEN event_type <> 'view' THEN (CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts END) END AS merged_at,
    'org/repo_' || CAST(user_id % 25 AS VARCHAR) AS repository_full_name,
    ts AS fetched_at
  FROM events)"""

REL_RAW = """
rel_raw AS (
  SELECT o_orderkey AS id,
    'v' || CAST(o_orderkey % 400 AS VARCHAR) AS tag_name,
    'Release ' || CAST(o_orderkey AS VARCHAR) AS name,
    o_orderpriority AS body,
    o_orderstatus = 'P' AS draft,
    o_orderstatus = 'O' AS prerelease,
    {'login': 'cust_' || CAST(o_custkey AS VARCHAR)} AS author,
    'https://example.invalid/release/' || CAST(o_orderkey AS VARCHAR) AS html_url,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END AS published_at,
    o_orderdate AS created_at, o_orderdate AS updated_at,
    'org/repo_' || CAST(o_custkey % 25 AS VARCHAR) AS repository_full_name,
    o_orderdate AS fetched_at
  FROM orders)"""

# The title rules, as (rank, word, class); the lowest rank among the words a title holds decides.
RULES = """
rules(rank, word, class) AS (VALUES
  (1, 'fix', 'bug fix'), (1, 'bug', 'bug fix'),
  (2, 'feat', 'feature'), (2, 'add', 'feature'), (2, 'implement', 'feature'),
  (3, 'refactor', 'refactor'), (3, 'clean', 'refactor'),
  (4, 'test', 'test'),
  (5, 'doc', 'documentation')),
classes AS (SELECT DISTINCT rank, class FROM rules)"""


def _classified(table: str, key: str, text: str) -> str:
    """(key, class) of every row of a table."""
    return f"""
hits AS (SELECT t.{key} AS key, min(rank) AS rank FROM {table} t, rules WHERE instr(lower(t.{text}), word) > 0 GROUP BY 1),
labelled AS (SELECT t.{key} AS key, ifnull(class, 'not clear') AS class
             FROM {table} t LEFT JOIN hits ON hits.key = t.{key} LEFT JOIN classes USING (rank))"""


SILVER_PRS = PR_RAW + "," + RULES + "," + _classified("pr_raw", "id", "title") + """,
silver_prs AS (
  SELECT repository_full_name AS repository, id, number, title, body AS description, state, additions, deletions,
    changed_files, commits, "user"['login'] AS author, base['ref'] AS base_branch, head['ref'] AS head_branch,
    '[' || ifnull(array_to_string([CAST(json_object('name', x.name) AS VARCHAR) FOR x IN labels], ','), '') || ']' AS labels_json,
    ifnull([x.name FOR x IN labels], CAST([] AS VARCHAR[])) AS labels_list,
    html_url AS url, created_at, closed_at, merged_at, fetched_at, class AS feat_classifier
  FROM pr_raw JOIN labelled ON labelled.key = pr_raw.id)"""

SILVER_RELEASES = REL_RAW + """,
published AS (SELECT * FROM rel_raw WHERE published_at IS NOT NULL),
silver_releases AS (
  SELECT one.repository_full_name AS repository, one.id, one.name AS release_name, one.tag_name AS tag,
    one.author['login'] AS release_author, one.published_at, one.created_at, one.updated_at,
    one.html_url AS release_url, one.body, one.draft AS is_draft, one.prerelease AS is_prerelease, one.fetched_at,
    CAST(1 AS BIGINT) AS row_num
  FROM published one
  WHERE NOT EXISTS (
    FROM published later
    WHERE later.repository_full_name = one.repository_full_name AND later.tag_name = one.tag_name
      AND (later.published_at, later.id) > (one.published_at, one.id)))"""

FOCUS, FOCUS_LABEL = "'org/repo_3'", "'repo_3'"
#: (rows of a model, its time column, its filter)
PRS = (SILVER_PRS, "silver_prs", "closed_at", "feat_classifier ILIKE 'feature'")
RELEASES = (SILVER_RELEASES, "silver_releases", "published_at", "true")


def _stamped(model: tuple) -> str:
    """stamped: (repository, t, month) of a model's rows."""
    ctes, table, time, keep = model
    return ctes + f""",
stamped AS (SELECT repository, CAST({time} AS TIMESTAMP) AS t,
                   CAST(make_date(year({time}), month({time}), 1) AS TIMESTAMP) AS month FROM {table} WHERE {keep})"""


_MONTHLY = """
SELECT repository, month AS {month}, count(*) AS {count} FROM stamped GROUP BY repository, month"""


def _members(model: tuple) -> str:
    """members: (repository, grp) of the focus and of those that fewer than ten repositories are ahead of."""
    return _stamped(model) + f""",
sizes AS (SELECT repository, count(*) AS n FROM stamped GROUP BY repository),
placed AS (SELECT s.repository, count(o.repository) AS ahead
           FROM sizes s LEFT JOIN sizes o ON o.n > s.n OR (o.n = s.n AND o.repository < s.repository) GROUP BY s.repository),
flags AS (SELECT repository, repository = {FOCUS} AS focus, ahead < 10 AS top FROM placed),
members AS (SELECT repository, if(focus, {FOCUS_LABEL}, 'top_10') AS grp FROM flags WHERE focus OR top)"""


def _by_group(model: tuple, month: str, count: str) -> str:
    return _with(_members(model), f"""
SELECT repository, grp AS repo_group, month AS {month}, count(*) AS {count}
FROM stamped NATURAL JOIN members GROUP BY repository, grp, month""")


def _median_days(model: tuple, out: str) -> str:
    """Days between neighbours in time (a missing time comes last), the middle one or the mean of the middle two."""
    return _with(_members(model), f"""
, numbered AS (SELECT repository, t, row_number() OVER (PARTITION BY repository ORDER BY t IS NULL, t) AS i
             FROM stamped WHERE repository IN (SELECT repository FROM members)),
steps AS (SELECT a.repository, (epoch(b.t) - epoch(a.t)) / 86400.0 AS days
          FROM numbered a JOIN numbered b ON a.repository = b.repository AND b.i - a.i = 1 WHERE a.t IS NOT NULL),
sorted AS (SELECT repository, list(days ORDER BY days) FILTER (days IS NOT NULL) AS d FROM steps GROUP BY repository)
SELECT repository, round((d[(len(d) + 1) // 2] + d[len(d) // 2 + 1]) / 2, 2) AS {out} FROM sorted""")


SQL: dict[str, str] = {
    "classify_titles": _with(SILVER_PRS, "SELECT id, repository, title, feat_classifier FROM silver_prs"),
    "silver_pull_requests": _with(SILVER_PRS, "FROM silver_prs"),
    "dedup_latest_release": _with(SILVER_RELEASES, "FROM silver_releases"),
    "monthly_counts": _with(_stamped(PRS), _MONTHLY.format(month="month", count="feature_pr_count")),
    "monthly_releases": _with(_stamped(RELEASES), _MONTHLY.format(month="release_month", count="feature_release_count")),
    "topk_groups": _with(_members(PRS), """
SELECT repository, n AS feature_pr_count FROM sizes JOIN placed USING (repository) WHERE ahead < 10"""),
    "topk_by_summary": """
WITH sizes AS (SELECT o_custkey AS customer, count(*) AS n_orders FROM orders GROUP BY 1)
SELECT customer, n_orders FROM (SELECT *, row_number() OVER (ORDER BY n_orders DESC, customer) AS place FROM sizes) WHERE place <= 10""",
    "median_gap_sketched": _with(_stamped(PRS), """
, numbered AS (SELECT repository, t, row_number() OVER (PARTITION BY repository ORDER BY t) AS i FROM stamped WHERE t IS NOT NULL),
steps AS (SELECT a.repository, (epoch(b.t) - epoch(a.t)) / 86400.0 AS days FROM numbered a JOIN numbered b ON a.repository = b.repository AND b.i - a.i = 1),
sorted AS (SELECT repository, list(days ORDER BY days) AS d FROM steps GROUP BY repository)
SELECT repository, CAST(len(d) AS BIGINT) AS n, round((d[(len(d) + 1) // 2] + d[len(d) // 2 + 1]) / 2, 2) AS median_days, true AS sketch_within_bound FROM sorted"""),
    "focus_vs_topk_prs": _by_group(PRS, "pr_month", "feature_pr_count"),
    "focus_vs_topk_releases": _by_group(RELEASES, "release_month", "feature_release_count"),
    "median_gap_prs": _median_days(PRS, "median_days_between_feature_prs"),
    "median_gap_releases": _median_days(RELEASES, "median_days_between_releases"),
    "existence_flag": _with(_members(PRS), """
SELECT p.id, p.repository, CASE WHEN p.repository IS NOT NULL THEN ifnull(f.top, false) END AS in_top
FROM silver_prs p LEFT JOIN flags f USING (repository)"""),
    "semi_join": _with(_members(PRS), """
SELECT p.id, p.repository FROM silver_prs p JOIN flags f ON f.repository = p.repository AND f.top"""),
    "newest_first": """
SELECT a.o_orderkey, a.o_orderdate FROM (
  SELECT o_orderkey, o_orderdate, count(*) OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) a
WHERE place <= 100""",
}

CUST_REPO = "'cust/Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"

NESTED = """
nested AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_linenumber = 1 THEN NULL
         WHEN l_linenumber = 2 THEN []::STRUCT(name VARCHAR)[]
         ELSE [{'name': l_returnflag}, {'name': l_linestatus},
               {'name': CASE WHEN l_quantity > 25 THEN NULL ELSE 'small' END}] END AS labels,
    [{'size': CAST(l_quantity AS DOUBLE), 'node': {'name': 'quantity', 'color': l_returnflag}},
     {'size': CAST(l_extendedprice / 100 AS DOUBLE), 'node': {'name': 'price', 'color': l_linestatus}},
     {'size': CAST(l_tax * 100 AS DOUBLE), 'node': {'name': 'tax', 'color': CAST(NULL AS VARCHAR)}},
     {'size': CAST(l_discount * 100 AS DOUBLE), 'node': {'name': 'discount', 'color': l_returnflag}}] AS edges
  FROM lineitem)"""

GQL_REPOS = """
gql_repos AS (
  SELECT c_custkey AS databaseId, 'cust/' || c_name AS nameWithOwner, 'segment ' || c_mktsegment AS description,
    c_acctbal AS stargazerCount, c_mktsegment = 'AUTOMOBILE' AS isArchived,
    [lower(c_mktsegment), 'nation-' || CAST(c_nationkey AS VARCHAR)] AS topics,
    CASE WHEN c_custkey % 10 <> 0 THEN CAST(DATE '2023-01-01' + CAST(c_custkey % 400 AS INTEGER) AS TIMESTAMP) END AS pushedAt,
    CASE WHEN c_custkey % 7 <> 0 THEN c_custkey % 1000 END AS total_size,
    [{'size': c_custkey * (i + 1) % 101, 'name': 'lang-' || CAST(i AS VARCHAR)} FOR i IN range(c_custkey % 13 + 1)] AS langs
  FROM customer),
existing AS (SELECT 'cust/' || c_name AS nameWithOwner FROM customer JOIN nation ON c_nationkey = n_nationkey
             WHERE n_regionkey = 1)"""


def _selected(keep: str, cap: str = "true", langs: str = "langs") -> str:
    """Repositories that pass ``keep`` and ``cap`` (of their place by stars) and are not loaded yet."""
    return _with(GQL_REPOS + f""",
cand AS (SELECT *, row_number() OVER (ORDER BY stargazerCount DESC, databaseId) AS place FROM gql_repos WHERE {keep})""", f"""
SELECT databaseId, nameWithOwner, stargazerCount, pushedAt, databaseId AS repo_database_id, topics,
  CASE WHEN total_size IS NOT NULL THEN '{{"totalSize":' || CAST(total_size AS VARCHAR) || ',"edges":[' || array_to_string(
    ['{{"size":' || CAST(x.size AS VARCHAR) || ',"node":{{"name":"' || x.name || '","color":null}}}}' FOR x IN {langs}], ',') || ']}}' END AS languages_data
FROM cand WHERE {cap} AND nameWithOwner NOT IN (FROM existing)""")


GQL_PRS = f"""
gql_prs AS (
  SELECT o.*, o_orderkey AS databaseId, 'cust_' || CAST(o_custkey AS VARCHAR) AS login, o_custkey % 30 + 1 AS n_list,
    o_orderkey % 3 + 1 AS n_review, CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 7 END AS total,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END AS milestone_title,
    CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 3 DAY END AS closed, {CUST_REPO} AS repo
  FROM orders o)"""


def _texts(n: str, body: str) -> str:
    """JSON text of a list of n objects; ``body`` may use i."""
    return f"'[' || array_to_string([{body} FOR i IN range(1, {n} + 1)], ',') || ']'"


_LABELS = _texts("n_list", """'{"name":"label-' || CAST(i AS VARCHAR) || '","color":null,"description":"' || o_orderpriority || '"}'""")
_ASSETS = _texts("o_custkey % 31", """'{"name":"bundle-' || CAST(i AS VARCHAR) || '","size":' || CAST(o_custkey * i AS VARCHAR) || ',"downloadCount":0,"contentType":"application/octet-stream","url":null}'""")

SQL.update({
    "new_entities_anti": _with(GQL_REPOS + """,
capped AS (SELECT databaseId, nameWithOwner, stargazerCount FROM gql_repos
           ORDER BY stargazerCount DESC, databaseId LIMIT 500)""", """
SELECT * FROM capped c WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.nameWithOwner = c.nameWithOwner)"""),
    "fk_enrich": """
SELECT o_orderkey AS database_id, c_custkey AS repo_database_id, 'cust/' || c_name AS repo, c_acctbal AS stars
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "state_filter": _with(SILVER_PRS, "SELECT id, repository, state FROM silver_prs WHERE state = 'closed'"),
    "repo_filter": """
SELECT c_custkey AS databaseId, 'cust/' || c_name AS nameWithOwner, c_acctbal AS stargazerCount
FROM customer WHERE NOT coalesce(c_mktsegment = 'AUTOMOBILE', false) AND c_acctbal >= 5000""",
    "allow_list": _with(SILVER_PRS, """
SELECT id, repository FROM silver_prs WHERE repository IN ('org/repo_1', 'org/repo_2', 'org/repo_3')"""),
    "search_terms": """
SELECT p_partkey, p_name FROM part
WHERE lower(concat_ws(' ', p_name, p_type, p_brand)) LIKE '%red%'
  AND lower(concat_ws(' ', p_name, p_type, p_brand)) LIKE '%widget%'""",
    "search_index": """
SELECT c_custkey AS "databaseId", 'cust/' || c_name AS "nameWithOwner", 'segment ' || c_mktsegment AS description FROM customer
WHERE lower(c_name || ' segment ' || c_mktsegment) LIKE '%customer#00000001%' AND lower(c_name || ' segment ' || c_mktsegment) LIKE '%mach%'""",
    "split_name": """
WITH named AS (
  SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_name WHEN c_custkey % 10 = 1 THEN 'a/b/' || c_name
                         ELSE 'cust/' || c_name END AS full_name FROM customer)
SELECT c_custkey, full_name, string_split(full_name, '/')[1] AS owner, string_split(full_name, '/')[2] AS name
FROM named WHERE len(string_split(full_name, '/')) = 2""",
    "split_name_rejects": """
SELECT c_custkey, CASE c_custkey % 10 WHEN 0 THEN c_name WHEN 1 THEN 'a/b/' || c_name END AS full_name FROM customer WHERE c_custkey % 10 < 3""",
    "recent_n_per_key": """
SELECT * FROM (
  SELECT event_id, user_id, ts,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn <= 5""",
    "nested_names": _with(NESTED, """
SELECT l_orderkey, l_linenumber,
  CASE WHEN labels IS NOT NULL THEN list_transform(labels, lambda x: x.name) ELSE [] END AS labels_list
FROM nested"""),
    "nested_json": _with(NESTED, """
SELECT l_orderkey, l_linenumber,
  CASE WHEN labels IS NOT NULL THEN CAST(to_json(labels) AS VARCHAR) ELSE '[]' END AS labels_json FROM nested"""),
    "nested_count": _with(NESTED, """
SELECT l_orderkey, l_linenumber, CAST(coalesce(len(labels), 0) AS BIGINT) AS label_count,
  CAST(coalesce(len(edges), 0) AS BIGINT) AS edge_count FROM nested"""),
    "nested_topk": _with(NESTED, """
SELECT l_orderkey, l_linenumber,
  list_transform(list_slice(list_reverse_sort(list_transform(edges, lambda x: {'_k': x.size, '_v': x})), 1, 2),
                 lambda x: x._v.node.name) AS top_edges
FROM nested"""),
    "nested_cap": _with(NESTED, """
SELECT l_orderkey, l_linenumber,
  list_slice(CASE WHEN labels IS NOT NULL THEN list_transform(labels, lambda x: x.name) ELSE [] END, 1, 2)
    AS first_labels
FROM nested"""),
    "child_rows": _with(NESTED, """
SELECT l_orderkey, l_linenumber, CAST(unnest(range(len(labels))) AS BIGINT) AS pos,
  unnest(list_transform(labels, lambda x: x.name)) AS label_name
FROM nested WHERE len(labels) > 0"""),
    "key_presence_filter": """
WITH recs AS (
  SELECT event_id, user_id,
    CASE WHEN event_id % 5 = 0 THEN regexp_replace(props, '}$', ', "pull_request": {"url": "x"}}')
         WHEN event_id % 5 = 1 THEN regexp_replace(props, '}$', ', "pull_request": null}')
         ELSE props END AS record
  FROM events)
SELECT * FROM recs WHERE NOT coalesce(list_contains(json_keys(record), 'pull_request'), false)""",
    "upsert_latest": """
WITH loads AS (
  SELECT o_orderkey, o_totalprice, o_orderdate AS fetched_at, 'base' AS version FROM orders
  UNION ALL
  SELECT o_orderkey, o_totalprice * 2, o_orderdate + INTERVAL 1 DAY, 'update' FROM orders WHERE o_orderstatus = 'O')
SELECT o_orderkey, o_totalprice, fetched_at, version FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY fetched_at DESC) AS rn FROM loads)
WHERE rn = 1""",
    "null_safe_defaults": _with(GQL_PRS, """
SELECT databaseId AS database_id, CASE WHEN o_orderstatus <> 'P' THEN login END AS author__login,
  CAST(NULL AS VARCHAR) AS author__name, CAST(NULL AS VARCHAR) AS author__email,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS author__company, CAST(NULL AS VARCHAR) AS author__location,
  CAST(ifnull(total, 0) AS BIGINT) AS commit_count, milestone_title
FROM gql_prs"""),
    "quality_checks": _with(SILVER_PRS + "," + SILVER_RELEASES.lstrip() + """,
raw_repo AS (SELECT c_custkey AS id, 'cust/' || c_name AS full_name FROM customer)""",
        "\nUNION ALL ".join(
            [f"SELECT 'not_null' AS test, '{m}' AS model, '{c}' AS column_name, "
             f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {src}"
             for m, src, c in [("pull_requests", "pr_raw", "id"), ("pull_requests", "pr_raw", "repository_full_name"),
                               ("releases", "rel_raw", "id"), ("releases", "rel_raw", "repository_full_name"),
                               ("repositories", "raw_repo", "id"), ("repositories", "raw_repo", "full_name"),
                               ("stg_github_pull_requests", "pr_raw", "id"),
                               ("stg_github_releases", "rel_raw", "id"),
                               ("stg_github_repositories", "raw_repo", "id"),
                               ("stg_pull_requests", "silver_prs", "repository"),
                               ("stg_pull_requests", "silver_prs", "number"),
                               ("stg_pull_requests", "silver_prs", "feat_classifier"),
                               ("stg_releases", "silver_releases", "repository"),
                               ("stg_releases", "silver_releases", "tag"),
                               ("stg_releases", "silver_releases", "row_num")]]
            + [f"SELECT 'unique', '{m}', 'id', (SELECT count(*) FROM (SELECT id FROM {src} WHERE id IS NOT NULL "
               f"GROUP BY id HAVING count(*) > 1))"
               for m, src in [("pull_requests", "pr_raw"), ("releases", "rel_raw"), ("repositories", "raw_repo"),
                              ("stg_github_pull_requests", "pr_raw"), ("stg_github_releases", "rel_raw"),
                              ("stg_github_repositories", "raw_repo")]]
            + ["SELECT 'accepted_values', 'stg_pull_requests', 'feat_classifier', "
               "(SELECT count(*) FROM silver_prs WHERE feat_classifier NOT IN (SELECT class FROM classes) AND feat_classifier <> 'not clear')"])),
    "row_counts": _with(SILVER_PRS, "\n" + "\nUNION ALL ".join(
        [f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in
         ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]]
        + ["SELECT 'distinct_repositories', count(*) FROM (SELECT DISTINCT repository FROM silver_prs)"])),
    "legacy_pr_enrichment": _with(GQL_PRS, f"""
SELECT databaseId, databaseId AS number, 'Order ' || o_orderpriority AS title, '**' || o_orderpriority || '**' AS body, o_orderpriority AS bodyText,
  CASE o_orderstatus WHEN 'O' THEN 'OPEN' WHEN 'F' THEN 'MERGED' ELSE 'CLOSED' END AS state,
  'https://example.invalid/pr/' || CAST(databaseId AS VARCHAR) AS url, o_orderdate AS createdAt, o_orderdate + INTERVAL 1 DAY AS updatedAt,
  closed AS closedAt, CASE WHEN o_orderstatus = 'F' THEN closed END AS mergedAt, 'UNKNOWN' AS mergeable,
  databaseId % 900 AS additions, databaseId % 70 AS deletions, databaseId % 12 AS changedFiles,
  CASE WHEN o_orderstatus <> 'P' THEN '{{"login":"' || login || '","name":null,"email":null,"company":"' || o_orderpriority || '","location":null}}' END AS author,
  'main' AS baseRefName, 'topic/' || CAST(databaseId AS VARCHAR) AS headRefName,
  CASE WHEN total IS NOT NULL THEN '{{"totalCount":' || CAST(total AS VARCHAR) || '}}' END AS commits,
  '{{"nodes":' || {_LABELS} || '}}' AS labels,
  '{{"nodes":' || {_texts("n_list", "'{\"login\":\"dev-' || CAST(i AS VARCHAR) || '\",\"name\":null}'")} || '}}' AS assignees,
  '{{"nodes":' || {_texts("n_review", "'{\"requestedReviewer\":{\"login\":\"reviewer-' || CAST(i AS VARCHAR) || '\",\"name\":null}}'")} || '}}' AS reviewRequests,
  CASE WHEN databaseId % 4 <> 0 THEN '{{"nodes":' || {_texts("n_review", "'{\"author\":{\"login\":\"reviewer-' || CAST(i AS VARCHAR) || '\"},\"state\":\"APPROVED\",\"createdAt\":null}'")} || '}}' END AS reviews,
  CASE WHEN milestone_title IS NOT NULL THEN '{{"title":"urgent","state":"OPEN","dueOn":null}}' END AS milestone,
  repo, c_custkey AS repo_database_id, databaseId AS database_id,
  CASE WHEN o_orderstatus <> 'P' THEN login END AS author__login, CAST(NULL AS VARCHAR) AS author__name, CAST(NULL AS VARCHAR) AS author__email,
  CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS author__company, CAST(NULL AS VARCHAR) AS author__location,
  'main' AS base_branch, 'topic/' || CAST(databaseId AS VARCHAR) AS head_branch, CAST(ifnull(total, 0) AS BIGINT) AS commit_count,
  ['label-' || CAST(i AS VARCHAR) FOR i IN range(1, n_list + 1)] AS labels_list, {_LABELS} AS labels_json, milestone_title,
  ['dev-' || CAST(i AS VARCHAR) FOR i IN range(1, n_list + 1)] AS assignees_list
FROM gql_prs JOIN customer ON repo = 'cust/' || c_name"""),
    "legacy_release_enrichment": f"""
SELECT o_orderkey AS databaseId, 'Release ' || CAST(o_orderkey AS VARCHAR) AS name, 'v' || CAST(o_orderkey AS VARCHAR) AS tagName,
  o_orderpriority AS description, 'https://example.invalid/release/' || CAST(o_orderkey AS VARCHAR) AS url,
  o_orderdate AS createdAt, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS publishedAt, o_orderdate AS updatedAt,
  o_orderkey % 5 = 0 AS isLatest, o_orderstatus = 'O' AS isPrerelease, o_orderstatus = 'P' AS isDraft,
  '{{"login":"cust_' || CAST(o_custkey AS VARCHAR) || '","name":null}}' AS author, '{{"nodes":' || {_ASSETS} || '}}' AS releaseAssets,
  'cust/' || c_name AS repo, c_custkey AS repo_database_id, o_orderkey AS database_id, 'v' || CAST(o_orderkey AS VARCHAR) AS tag_name,
  'cust_' || CAST(o_custkey AS VARCHAR) AS author__login, CAST(NULL AS VARCHAR) AS author__name,
  o_custkey % 31 AS assets_count, {_ASSETS} AS assets_data
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "repo_selection": _selected("NOT isArchived AND stargazerCount >= 1000 AND lower(concat_ws(' ', nameWithOwner, description, "
                                "array_to_string(topics, ' '))) LIKE '%machinery%'", "place <= 100"),
    "repo_selection_qualifiers": _selected("pushedAt >= TIMESTAMP '2023-03-01' AND pushedAt < TIMESTAMP '2023-12-24' AND stargazerCount BETWEEN 500 AND 4000"),
    "repo_pushed_after": _selected("NOT isArchived AND pushedAt > TIMESTAMP '2023-10-01'",
                                   langs="[{'size': y.size, 'name': y.name} FOR y IN list_reverse_sort(langs)[1:4]]"),
    "landing_pull_requests": _with(SILVER_PRS, """
SELECT id, number, title, description AS body, state, author AS login, head_branch AS head_ref,
  CASE WHEN id % 11 = 0 THEN '[]' ELSE labels_json END AS labels_json, additions,
  created_at, closed_at, merged_at, repository AS repository_full_name, fetched_at FROM silver_prs"""),
    "landing_gql_pull_requests": """
WITH ord AS (SELECT *, o_custkey % 30 + 1 AS k FROM orders), bad AS (SELECT count(*) AS n FROM orders WHERE o_orderkey % 700 = 0)
SELECT 'record' AS outcome, o_orderkey AS database_id, 'cust/Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS repo, 'Order ' || o_orderpriority AS title,
  CASE WHEN o_orderstatus <> 'P' THEN 'cust_' || CAST(o_custkey AS VARCHAR) END AS author_login, CASE WHEN o_orderstatus <> 'F' THEN o_custkey % 7 END AS commits,
  array_to_string([('label-' || CAST(i AS VARCHAR)) FOR i IN range(1, k + 1)], ',') AS labels, array_to_string([('dev-' || CAST(i AS VARCHAR)) FOR i IN range(1, k + 1)], ',') AS assignees,
  CAST(CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE o_orderkey % 3 + 1 END AS BIGINT) AS n_reviews, CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END AS milestone,
  CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3 DAY END AS closed_at FROM ord
UNION ALL SELECT 'a key does not fit its type', 2 * n, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM bad WHERE n > 0""",
    "discovered_children": """
SELECT o_orderkey AS "databaseId", i - 1 AS position, 'bundle-' || CAST(i AS VARCHAR) AS name, o_custkey * i AS size, 'application/octet-stream' AS "contentType"
FROM (SELECT *, unnest(range(1, o_custkey % 31 + 1)) AS i FROM orders)""",
    "landing_releases": _with(REL_RAW + """,
bad AS (SELECT count(*) AS n FROM rel_raw WHERE id % 500 = 0)""", """
SELECT 'record' AS outcome, repository_full_name AS repository, count(*) AS n FROM rel_raw GROUP BY 2
UNION ALL SELECT 'a key does not fit its type', 'org/repo_1', 2 * n FROM bad WHERE n > 0
UNION ALL SELECT 'not an object', 'org/repo_1', n FROM bad WHERE n > 0
UNION ALL SELECT 'unreadable page', 'org/repo_2', 1 FROM bad WHERE n > 0"""),
    "variant_records": _with(REL_RAW, """
SELECT id, tag_name, published_at, repository_full_name, 'by-' || CAST(id % 3 AS VARCHAR) AS delivery_mode, id + 1 AS second_stop FROM rel_raw"""),
    "variant_unknown_keys": _with(REL_RAW + """,
bad AS (SELECT count(*) AS n FROM rel_raw WHERE id % 500 = 0)""", """
SELECT 'delivery' AS key, 'OBJECT' AS kind, count(*) AS n FROM rel_raw WHERE tag_name IS NOT NULL
UNION ALL SELECT 'score', CASE WHEN id % 7 > 0 THEN 'BIGINT' ELSE 'VOID' END, count(*) FROM rel_raw WHERE tag_name IS NOT NULL GROUP BY 2
UNION ALL SELECT NULL, 'a key does not fit its type', 2 * n FROM bad WHERE n > 0
UNION ALL SELECT NULL, 'not an object', n FROM bad WHERE n > 0
UNION ALL SELECT NULL, 'unreadable page', 1 FROM bad WHERE n > 0"""),
    "upsert_persisted": """
SELECT o_orderkey AS id, o_totalprice * CASE WHEN again THEN 2 ELSE 1 END AS price,
  CASE WHEN NOT again THEN o_orderpriority END AS priority,
  CASE WHEN NOT again OR o_orderkey % 2 = 0 THEN o_orderdate END AS fetched_at
FROM (SELECT *, o_orderkey % 3 = 0 AND o_orderkey % 5 <> 0 AS again FROM orders)""",
    "incremental_releases": _with(REL_RAW, "SELECT id, tag_name, published_at, repository_full_name, fetched_at FROM rel_raw"),
    "exported_models": _with(SILVER_RELEASES, """
SELECT id, repository, tag, published_at, count(*) OVER () AS rows_reported, 'missing' AS absent FROM silver_releases"""),
    "projected_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders",
    "issue_cleaning": """
WITH recs AS (
  SELECT event_id, 'org/repo_' || CAST(user_id % 25 AS VARCHAR) AS repository_full_name, ts AS updated_at,
    event_type AS title, event_id % 4 AS kind
  FROM events),
kept AS (SELECT * FROM recs WHERE kind NOT IN (0, 1)),
capped AS (
  SELECT *, row_number() OVER (PARTITION BY repository_full_name ORDER BY updated_at DESC, event_id DESC) AS rn
  FROM kept)
SELECT event_id AS id, repository_full_name, title, updated_at FROM capped WHERE rn <= 5""",
})


def _model_count(name: str, model_sql: str) -> str:
    return f"SELECT '{name}' AS model, count(*) AS row_count FROM ({model_sql.strip()})"


# kept up to date over three loads, these equal the queries over everything
SQL |= {f"{name}_maintained": SQL[query] for name, query in (("median_gap", "median_gap_prs"), ("monthly_counts", "monthly_counts"))}

_MODELS = {"stg_pull_requests": "silver_pull_requests", "stg_releases": "dedup_latest_release",
           "feature_prs_monthly": "monthly_counts", "feature_releases_monthly": "monthly_releases",
           "feature_prs_lace_vs_top10": "focus_vs_topk_prs", "feature_releases_lace_vs_top10": "focus_vs_topk_releases",
           "median_feature_prs_lace_vs_top10": "median_gap_prs", "median_releases_lace_vs_top10": "median_gap_releases"}
SQL["model_row_counts"] = "\nUNION ALL\n".join(_model_count(m, SQL[q]) for m, q in _MODELS.items())


def _gold_rows(model: str, group: str, month: str, value: str) -> str:
    return (f"SELECT '{model}' AS model, repository, CAST({group} AS VARCHAR) AS grp, CAST({month} AS TIMESTAMP) AS month, "
            f"CAST({value} AS DOUBLE) AS value FROM ({SQL[_MODELS[model]].strip()})")


SQL["job_tables"] = "\nUNION ALL\n".join([
    _gold_rows("feature_prs_monthly", "NULL", "month", "feature_pr_count"),
    _gold_rows("feature_releases_monthly", "NULL", "release_month", "feature_release_count"),
    _gold_rows("feature_prs_lace_vs_top10", "repo_group", "pr_month", "feature_pr_count"),
    _gold_rows("feature_releases_lace_vs_top10", "repo_group", "release_month", "feature_release_count"),
    _gold_rows("median_feature_prs_lace_vs_top10", "NULL", "NULL", "median_days_between_feature_prs"),
    _gold_rows("median_releases_lace_vs_top10", "NULL", "NULL", "median_days_between_releases"),
])

SQL["classify_documents"] = _with(RULES + "," + _classified("documents", "doc_id", "text"), """
SELECT doc_id, lang, class AS feat_classifier FROM documents JOIN labelled ON key = doc_id""")

SQL["bronze_copy"] = "FROM orders"
SQL["existing_lookup"] = "SELECT c_custkey, c_name FROM customer"
SQL["stamp_provenance"] = f"""
SELECT o_orderkey,
  coalesce(CASE WHEN o_orderstatus = 'F' THEN {CUST_REPO} END, 'landing/' || CAST(o_custkey AS VARCHAR))
    AS repository_full_name,
  coalesce(CASE WHEN o_orderstatus = 'O' THEN o_orderdate END, o_orderdate + INTERVAL 2 DAY) AS fetched_at
FROM orders"""

_RAW_OUTCOMES = """
SELECT 'raw' AS part, 'pull_requests' AS name, 'stored' AS detail, count(*) AS n FROM events
UNION ALL SELECT 'raw', 'releases', 'stored', count(*) FROM orders
UNION ALL SELECT 'raw', 'repositories', 'stored', count(*) FROM customer
UNION ALL SELECT 'raw', 'issues', 'stored', count(*) FROM events WHERE event_id % 4 > 1
UNION ALL SELECT 'raw', 'pull_requests', why, times * count(*) FROM events, (VALUES ('a key does not fit its type', 2), ('not an object', 1)) w(why, times)
  WHERE event_id % 1000 = 0 GROUP BY why, times
UNION ALL SELECT 'raw', 'pull_requests', 'unreadable page', 1 WHERE EXISTS (FROM events WHERE event_id % 1000 = 0)"""
SQL["job_report"] = (_RAW_OUTCOMES + f"""
UNION ALL SELECT 'check', model, test || ' ' || column_name, failures FROM ({SQL['quality_checks'].strip()})
UNION ALL SELECT 'export', model, 'rows', row_count FROM ({SQL['model_row_counts'].strip()})""")
