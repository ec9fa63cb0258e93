import html
import re

import pytest

from repolens.llm import html as H
from tests.llm.data import empty

PAGE = ('<!DOCTYPE html><html><head><title>T {0}</title><style>p{{}}</style><script>var a="</p><article>";</script></head><body>'
        '<nav><ul><li><a href="/a">menu {0}</a></li></ul></nav><div class="ad">buy {0} things now and here</div>{1}<footer>&copy; site {0}</footer></body></html>')


def article(i):
    return f"<article><h1>Head {i} &amp; more</h1><p>First  <b>bold</b>ly\n said&nbsp;x<br>line</p><p>" + "words " * (5 + i % 7) + "</p></article>"


@pytest.fixture(scope="module")
def weights(spark):
    return H.learn_weights(spark.createDataFrame([(i, PAGE.format(i, article(i))) for i in range(60)], "page_id long, html string"))


def expected(i):
    return f"Head {i} & more\nFirst boldly said x line\n" + " ".join(["words"] * (5 + i % 7))


def test_articles(spark, weights):
    df = spark.createDataFrame([(i, PAGE.format(i, article(i))) for i in range(60)], "page_id long, html string")
    assert {r.id: r.text for r in H.extract(df).collect()} == {i: expected(i) for i in range(60)}
    assert weights["article"] < -20 and -1 < weights["p"] < 0 < weights["word"]


@pytest.mark.parametrize("junk", [
    '<aside>side words here and more</aside>', '<form action="/x"><p>name of yours</p><input></form>', '<div class="cookie-notice"><div>we use</div> cookies</div>',
    '<section id="comments"><article class="comment"><p>a reader says many words, more than the text has, on and on and on and on</p></article></section>',
    '<header><p>site name and motto</p></header>', '<p>Some welcome words</p>', "<!-- <article>no</article> -->", '<script>document.write("<article><p>no no</p></article>")</script>',
    '<ul class="menu"><li>one</li><li>two</li></ul>', '<noscript><p>turn it on please</p></noscript>', '<div role="navigation">go on</div>', "<div class='sidebar'>left"])
def test_junk_around_and_inside(weights, junk):
    for body in (junk + article(9), article(9) + junk, article(9).replace("</h1>", "</h1>" + junk) if "welcome" not in junk and "left" not in junk else junk + article(9)):
        assert H.main_text(PAGE.format(1, body), weights) == expected(9), junk


def test_pages_without_labels(weights):
    body = "<div id=content><h1>Head</h1><p>Some text of it</p><ul><li>one item</li></ul></div>"
    assert H.main_text(PAGE.format(1, body), weights) == "Head\nSome text of it\none item"
    assert H.main_text("just words", weights) == "just words" and H.main_text("just words", {}) == "just words"


def test_broken_pages(weights):
    page = PAGE.format(1, article(9))
    for cut in range(0, len(page), 7):
        text = H.main_text(page[:cut], weights)
        assert "menu" not in text and "buy" not in text
    for odd in ("", "   ", "<", "<p", "</", "&amp", "&#0;", "<article>", "<article></article>", "</article><article>", "<p>" * 3000, "<div class=ad>" * 500, "a < b > c"):
        H.main_text(odd, weights)
    assert H.main_text("<article><p>a &lt;p&gt; b &#233;&eacute;</p></article>", weights) == "a <p> b éé"


def test_the_scan_alone_finds_the_article(weights):
    """No element decides: the article wins by its words, under whatever name its element has."""
    page = "<body><div><p>" + "welcome to this place " * 2 + "</p></div>" + article(13) + "<div>" + "more to read " * 2 + "</div></body>"
    assert H.main_text(page, weights) == expected(13)
    page = "<body><nav>a b c</nav><div id=x>" + article(13) + "</div><footer>d e f</footer></body>"
    for name in ("article", "main", "div", "section"):
        assert H.main_text(page.replace("article", name), weights) == expected(13)


@pytest.mark.parametrize("before,after", [
    ('<div class="layout has-sidebar">', "</div>"), ('<div id="search-result">', "</div>"), ('<div class="content with-comments">', "</div>"),
    ('<div class="no-sidebar"><form>', "</form></div>"), ('<div class="sidebar">', "</div>"), ('<div class="featured-banner-article">', "</div>"),
    ('<p class="ad">Buy', ""), ('<ul><li class="share">x<li>y</ul>', ""), ("<table><tr><td class=menu>m<td>", "</table>"), ('<span class="ad">Buy', "")])
def test_wrappers_and_unclosed_elements_keep_the_article(weights, before, after):
    assert H.main_text(PAGE.format(1, before + article(9) + after), weights).endswith(expected(9))


def test_unclosed_elements_inside_end_where_html_ends_them(weights):
    page = lambda inside: H.main_text(PAGE.format(1, f"<article>{inside}</article>"), weights)
    assert page('<p class="ad">Buy<p>One two three<p>Four five') == "One two three\nFour five"
    assert page('<ul><li>One two<li class="share">Share it<li>Three four</ul><p>Five six') == "One two\nThree four\nFive six"
    assert page('<div><p>One two<div class="ad">Buy <b>it</div><p>Three four</div>') == "One two\nThree four"
    assert page('<section class="featured-banner-article"><p>One two three</section><p>Four') == "One two three\nFour"
    assert page('<div class="share-buttons"><a>x</a></div><p>One two</p><ul class="mainNav"><li>no</ul><p>Three') == "One two\nThree"
    assert page('<p>One two</p><dl><dt class="promo">Buy<dd>it was three</dl>') == "One two\nit was three"


def test_class_names_by_their_head_word():
    assert all(map(H.strikes, "ad ads main-nav site-header ad-container sidebar_left cookieConsent comment-list related-posts page-footer adBox share comment-body".split()))
    assert not any(map(H.strikes, "has-sidebar no-sidebar with-comments search-result featured-banner-article content article-body text download shadow thread has_ads".split()))


def test_comments_beside_an_article_go_even_as_articles(weights):
    inner = "<article><p>a reader says very many words here</p></article>"
    assert H.main_text(PAGE.format(1, article(9) + f'<div class="comments">{inner * 3}</div>'), weights) == expected(9)


def test_best_run_is_maximal():
    import random
    rng = random.Random(3)
    for _ in range(300):
        s = [rng.choice([-3, -2, -1, -0.5, 1, 2]) for _ in range(rng.randrange(12))]
        a, b = H.best_run(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


def test_given_pages(spark):
    """The pages at hand hold one article of h1 and p elements, which a pattern can read."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")

    def read(page):
        body = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)[1])
        blocks = re.split(r"</?(?:p|h1)>", body)
        return "\n".join(t for b in blocks if (t := " ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split())))
    want = {r.page_id: read(r.html) for r in pages.collect()}
    assert {r.id: r.text for r in H.extract(pages).collect()} == want
    # learned where articles are marked, read where they aren't
    plain = pages.selectExpr("page_id", "regexp_replace(html, '(</?)article', '$1div') AS html")
    assert {r.id: r.text for r in H.extract(plain, weights=H.learn_weights(pages)).collect()} == want


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, "u"), (None, "", None), (2, "<p>x", "u"), (2, "<p>x", "u")], "page_id long, html string, text string")
    assert sorted((r.id or 0, r.text, r.m0) for r in H.extract(df, "page_id", "html", "text").fillna("", ["m0"]).collect()) == [(0, "", ""), (1, "", "u"), (2, "x", "u"), (2, "x", "u")]
    assert H.extract(empty(spark), "doc_id", "text").collect() == []
