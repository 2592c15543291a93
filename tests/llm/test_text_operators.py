"""Line dedup, URL filter, HTML extraction and fingerprints against plain Python versions."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from eventloom.llm import fingerprint, html_extract, line_dedup, url_filter
from eventloom.llm.queries import QUERIES, URL_RULES
from tests.conftest import TESTDATA

SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# -- line dedup ------------------------------------------------------------------


def plain_lines(docs):
    def key(line):
        return line.strip(SPACES).translate(LOWER)

    split = [(i, (t or "").split("\n")) for i, t in docs]
    holders = {}
    for i, lines in split:
        for line in lines:
            if i is not None and len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, lines in split:
        kept = [x for x in lines if i is None or len(holders.get(key(x), ())) < 2 or min(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def cleaned(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = line_dedup.drop_repeated_lines(frame).collect()
    return sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in rows], key=str)


def test_line_edges(spark):
    docs = [
        (1, "Shared line here\nown"), (2, "  SHARED line here\r\nother\n"), (3, None), (4, ""), (5, "\n\n"),
        (6, "short\nshort"), (7, "short"), (8, "twice in one doc\ntwice in one doc"), (9, "É upper é stays\nx"),
        (10, "é upper é stays"), (None, "Shared line here"), (11, "shared line here\nshared LINE here\nend"),
        (12, "same row twice"), (12, "same row twice"), (13, "same row twice\u00a0"), (14, "x" * 200_000 + "\nshared line here"),
    ]
    assert cleaned(spark, docs) == plain_lines(docs)


def test_random_lines(spark):
    rng = random.Random(3)
    pool = [f"line number {i} of the pool" for i in range(40)] + ["", " ", "tiny", "Line Number 3 of the POOL "]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 6)))) for i in range(300)]
    assert cleaned(spark, docs) == plain_lines(docs)


def test_lines_of_an_empty_table_and_of_clashing_columns(spark):
    assert cleaned(spark, []) == []
    frame = spark.createDataFrame([(1, "a shared line\nb", 7, 8, "z", "id"), (2, "a shared line", 7, 8, "z", "h1")],
                                  "doc_id long, text string, n_lines int, n_dropped int, kept_text string, first string")
    rows = {r.doc_id: r for r in line_dedup.drop_repeated_lines(frame).collect()}
    assert (rows[2].n_lines, rows[2].n_dropped, rows[2].kept_text, rows[2].first) == (1, 1, "", "h1")


def test_many_shared_lines_of_long_documents(spark):
    """Linear in the lines: two documents of 60,000 shared ones."""
    lines = [f"a line that both hold, number {i}" for i in range(60_000)]
    docs = spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join([*lines, "own", lines[0]]))], "doc_id long, text string")
    first, second = line_dedup.drop_repeated_lines(docs).orderBy("doc_id").collect()
    assert (first.n_lines, first.n_dropped, first.kept_text) == (60_000, 0, "\n".join(lines))
    assert (second.n_lines, second.n_dropped, second.kept_text) == (60_002, 60_001, "own")


def test_lines_of_rows_with_one_id_and_clashing_names(spark):
    shared = "a line that is shared"
    rows = [(1, f"{shared}\nx", 9, "l"), (2, f"y\n{shared}", 9, "l"), (2, f"{shared}\nz", 9, "l"), (2, f"{shared}\nz", 9, "l"), (None, shared, 9, "l")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lost int, lines string")
    got = sorted((str(r.doc_id), r.kept_text, r.n_dropped, r.lost, r.lines) for r in line_dedup.drop_repeated_lines(docs).collect())
    assert got == [("1", f"{shared}\nx", 0, 9, "l"), ("2", "y", 1, 9, "l"), ("2", "z", 1, 9, "l"), ("2", "z", 1, 9, "l"), ("None", shared, 0, 9, "l")]


def test_line_threshold(spark):
    frame = spark.createDataFrame([(i, f"held by three\nheld by two {min(i, 2)}") for i in (1, 2, 3)], "doc_id long, text string")
    rows = line_dedup.drop_repeated_lines(frame, min_docs=3).collect()
    assert sorted((r.doc_id, r.n_dropped) for r in rows) == [(1, 0), (2, 1), (3, 1)]


# -- URL filter ------------------------------------------------------------------


def plain_verdict(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, tail = rest[:n].translate(LOWER), rest[n:]
        path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(h.count("."), len(h), len(p), v == "block", h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[4] if best else None, best[5] if best else default


URLS = [
    None, "", "no scheme.org/", "http://example.org", "http://example.org/", "HTTP://A.EXAMPLE.ORG/es/x?q=/en/1", "http://example.org/en/12#a",
    "http://notexample.org/es/", "https://x.com/fr/", "https://x.com/de/1", "https://com/de/", "http://x.com/DE/", "ftp://a://b.com/fr/",
    "http://org?x", "http://x.net/fr/", "http://x.org/es/", "http:///path", "http://example.org\n/es/", "http://example.org//es/",
]


@pytest.mark.parametrize("rules", [URL_RULES, [("block", "a.b", ""), ("allow", "a.b", "/x/"), ("block", "b", "/x/y"), ("allow", "b", "/x/y"), ("block", "b", "/x/yy/")]])
def test_url_verdicts(spark, rules):
    urls = URLS + ["http://a.b/x/", "http://a.b/x/y", "http://c.b/x/yz", "http://b/x/yy/z", "http://b/x/yy"]
    frame = spark.createDataFrame([(i, u, "keep") for i, u in enumerate(urls)], "page_id int, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(frame, rules).collect()}
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_url_filter_edges(spark):
    frame = spark.createDataFrame([], "page_id int, url string")
    assert url_filter.filter_urls(frame, URL_RULES).count() == 0
    with pytest.raises(ValueError):
        url_filter.filter_urls(frame, URL_RULES, max_rules=2)
    with pytest.raises(ValueError):
        url_filter.UrlTrie([("deny", "a", "/")])


# -- HTML ------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>no</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body><header><h1>Site</h1></header><nav><ul><li><a href="/">menu</a></li></ul></nav><div class="cookie-notice"><p>no, no, no, no, no, and no</p></div>
<article><h1>Title &amp; more</h1><p>First   paragraph,
 with <b>bold</b> and <a href=x>a link</a>.</p><p><b>Second<br>line<p>Unclosed, third &lt;one&gt;</p><aside><p>aside, with, many, commas, in, it</p></aside>
<form><p>sign up</p></form><ul><li>one<li>two</ul></article><section id="comments"><p>A comment, long, with commas, and so on, and so on.</p></section>
<div class="sidebar"><p>more, more, more, more, more</p></div><footer>&copy; no</footer>"""


def test_page_of_all_parts():
    assert html_extract.extract_text(PAGE).split("\n") == [
        "Title & more", "First paragraph, with bold and a link.", "Second line", "Unclosed, third <one>", "one", "two",
    ]


@pytest.mark.parametrize("before, after", [
    ('<div class="content-sidebar-wrap"><main>', "</main></div>"),
    ('<div class="content has-sidebar">', "</div>"),
    ('<div class="site-header-fixed menu-open"><div id="content">', "</div></div>"),
    ('<div class="elementor-widget-text-editor">', "</div>"),
    ('<div class="elementor-widget"><div class="elementor-widget-container">', "</div></div>"),
    ('<div class="share-wrap"><article>', "</article></div>"),
])
def test_wrappers_named_like_other_parts(before, after):
    text = "A sentence of the text, which is long enough, and has commas. " * 4
    long = "Reader: what a fine text, I liked it, and so did others. " * 4
    page = f"""<body><div class="sidebar"><ul><li><a href=a>One of many links</a></li><li><a href=b>Another</a></li></ul></div>
{before}<h1>Title</h1><p>{text}</p><p>{text}</p><p>{text}</p><div class="share"><a href=c>Share this</a></div><p>{text}</p>{after}
<div id="comments"><div class="comment"><div class="comment-content"><p>{long}</p></div></div></div><div class="footer">f</div></body>"""
    assert html_extract.extract_text(page).split("\n") == ["Title"] + [text.strip()] * 4


def test_pages_without_an_article_element():
    text = "A sentence of the text, which is long enough, and has commas."
    page = f"<body><div id=menu><a href=a>x</a></div><div id=content><p>{text}</p><p>{text}</p><div><p>{text}</p></div></div><div class=footer>f</div></body>"
    assert html_extract.extract_text(page) == "\n".join([text] * 3)


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!-- x", "<script>x", "<nav>only a menu</nav>", "&am", "<p title='x", "</p></div>", "<div>" * 3000, "<a b=" * 3000])
def test_broken_pages_do_not_fail(page):
    assert html_extract.extract_text(page) in ("", "&am", "<")  # a lone < is text


@pytest.mark.parametrize("page", [
    "<div>" * 100_000,
    "<p><button>" + "<div>" * 100_000,
    "<table><td>" + "<section>" * 50_000 + "<li>" * 50_000,
    "<b>" * 100_000 + "</i>" * 100_000,
    "<p>A sentence of the text, which is long enough, and has commas.<div class=comment>no</div>" * 20_000,
])
def test_very_deep_and_very_long_pages(page):
    start = time.perf_counter()
    html_extract.extract_text(page)
    assert time.perf_counter() - start < 10


def test_cut_off_page():
    assert html_extract.extract_text(PAGE[: PAGE.index("</article>") - 10]).startswith("Title & more\nFirst paragraph")


def test_extract_keeps_other_columns(spark):
    frame = spark.createDataFrame([(1, "<p>a</p>", "old"), (1, None, "old")], "page_id int, html string, text string")
    rows = html_extract.extract_main_text(frame)
    assert rows.columns == ["page_id", "text"] and sorted(r.text for r in rows.collect()) == ["", "a"]
    assert html_extract.extract_main_text(frame.limit(0)).count() == 0


def test_given_pages(spark):
    """Against a reading of their one template."""
    import re
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{TESTDATA}/sf0.01/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op4_html_extract"](spark, f"{TESTDATA}/sf0.01").collect()}
    for key, page in pages.items():
        inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert got[key] == (want, len(want))


# -- fingerprints ----------------------------------------------------------------


def test_fingerprint_is_a_multiset_hash():
    f = lambda t: fingerprint.fingerprints([t])[0]
    assert f("a b\nc\nc").text() == f("c\na b\nc").text() != f("a b\nc").text()
    assert (f("a\nb") + f("c")).text() == f("a\nb\nc").text()
    assert (f("a\nb\nc") - f("b")).text() == f("c\na").text()
    assert f(None).text() == f("").text() != f("\n").text()
    assert fingerprint.Fingerprint.parse(f("x y z").text()) == f("x y z")
    assert f("a").likeness(f("a")) == 1.0 > f("a").likeness(f("b"))


def test_likeness_of_very_repetitive_texts():
    text = "w " * 100_000
    own, changed = fingerprint.fingerprints([text, fingerprint.edited(text, "other words of a text " * 5_000)])
    assert own.likeness(changed) > 0.5


def plain_next(docs):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), hashlib.sha256(r[1].encode()).hexdigest() if r[1] is not None else ""))
    out = []
    for (i, text), (_, following) in zip(order, order[1:] + order[:1]):
        text, following = text or "", following or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        a, b, c = fingerprint.fingerprints([text, edited, following])
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a.text(), b.text(), a.likeness(b), a.likeness(c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("stretches", [1, 3, 50, None])
def test_next_documents(spark, stretches):
    rng = random.Random(5)
    docs = [(i * 7 - 40, " ".join(rng.choice(["ab", "cd\n", "é漢", "x"]) for _ in range(rng.randint(0, 60)))) for i in range(120)]
    docs += [(3, "tie b"), (3, "tie a"), (3, "tie a"), (1000, None), (1001, ""), (None, "no id"), (None, None), (5, "long " * 20_000)]
    docs += [(None, f"no id {i}") for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("stretch", F.lit("clash")).repartition(5)
    rows = fingerprint.compare_with_next(frame, stretches=stretches).collect()
    assert sorted((tuple(r) for r in rows), key=str) == plain_next(docs)


def test_the_cuts_are_one_literal_in_the_plan(spark):
    cuts = [i + 0.5 for i in range(20_000)]
    found = spark.range(0, 30_000, 7).withColumn("s", fingerprint._cuts_below(F.col("id"), cuts))
    assert found.where("s <> least(id, 20000)").count() == 0
    assert "split(" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_few_documents(spark):
    for docs in ([], [(1, "alone")], [(None, None)]):
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        rows = fingerprint.compare_with_next(frame).collect()
        assert sorted((tuple(r) for r in rows), key=str) == plain_next(docs)


def test_likeness_tells_edited_from_next(spark):
    rows = QUERIES["op3_fingerprint"](spark, f"{TESTDATA}/sf0.001").collect()
    long = [r for r in rows if r.n_chars > 500]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)
