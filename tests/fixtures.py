"""Small records of our own, as DataFrames with the REST schemas."""

from repolens.schemas import REST_PULL_REQUEST, REST_RELEASE


def _pr(id, title, state="closed", labels=None, created=None, closed=None, repo="acme/engine",
        fetched="2023-09-30T08:00:00Z", **kw):
    row = dict(id=id, number=id * 10, title=title, body=kw.get("body"), state=state,
               user=kw.get("user", {"login": "kim"}), base=kw.get("base"), head=kw.get("head"),
               labels=labels, html_url=f"https://example.invalid/{repo}/{id}",
               additions=kw.get("additions"), deletions=kw.get("deletions"),
               changed_files=kw.get("changed_files"), commits=kw.get("commits"),
               created_at=created, updated_at=kw.get("updated_at"), closed_at=closed, merged_at=kw.get("merged_at"),
               repository_full_name=repo, fetched_at=fetched)
    return row


PR_FIXTURES = [
    _pr(11, "Hotfix: crash on empty input", labels=[{"name": "p1"}, {"name": "crash"}], created="2023-05-03T10:15:00Z",
        closed="2023-05-04T18:45:30Z", user={"login": "sam"}, base={"ref": "trunk"}, head={"ref": "sam/crash"},
        additions=3, deletions=41, changed_files=1, commits=2, merged_at="2023-05-04T18:45:30Z"),
    _pr(12, "Implement batch exports", "open", [{"name": "export"}], "2023-06-11T00:00:00Z",
        user={"login": "alex"}, base={"ref": "trunk"}, head={"ref": "exports"}, additions=870, commits=14),
    _pr(13, "Cleanup of the parser", labels=[], created="2023-07-01T12:00:00Z", closed="2023-07-21T12:00:00Z",
        user={"login": "noor"}, base={"ref": "v2"}, head={"ref": "parser"}, deletions=512, changed_files=30),
    _pr(14, "Debug output left in"),
    _pr(15, "Features page redesign", "open", None, user={"login": "ada"}),
]

RELEASE_FIXTURES = [
    dict(id=71, tag_name="2023.1", name="Spring", body="notes", draft=False, prerelease=False, author={"login": "bot"},
         html_url="https://example.invalid/r/71", published_at="2023-04-02T06:00:00Z", created_at="2023-04-01T22:00:00Z",
         updated_at="2023-04-02T06:00:00Z", repository_full_name="acme/engine", fetched_at="2023-04-03T00:00:00Z"),
    dict(id=72, tag_name="2023.2-rc", name=None, body=None, draft=False, prerelease=True, author={"login": "kim"},
         html_url=None, published_at="2023-08-19T17:30:00Z", created_at="2023-08-19T17:00:00Z", updated_at=None,
         repository_full_name="acme/engine", fetched_at="2023-08-20T00:00:00Z"),
    dict(id=79, tag_name="2024.0", name="Unpublished", body="later", draft=True, prerelease=False, author=None,
         html_url=None, published_at=None, created_at="2023-09-01T00:00:00Z", updated_at=None,
         repository_full_name="acme/engine", fetched_at="2023-09-02T00:00:00Z"),
]


def prs_df(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else PR_FIXTURES, REST_PULL_REQUEST)


def releases_df(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else RELEASE_FIXTURES, REST_RELEASE)
