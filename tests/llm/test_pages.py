"""URL filter and HTML extraction."""
import html
import math
import re
from html.parser import HTMLParser

import duckdb
import pytest
from pyspark.sql import functions as F

from cleanspark.llm import url_filter as UF
from cleanspark.llm.main_text import Page, extract, extract_pages
from cleanspark.llm.queries import QUERIES

from ..conftest import SF001

URLS = [
    ("https://a.net/x", "a.net", "/x", "net/"), ("https://a.net", "a.net", "", None), ("https://net/", "net", "/", "net/"),
    ("http://WWW.Example.NET/en/1?q#f", "www.example.net", "/en/1", "example.net/en/"), ("http://example.net/EN/1", "example.net", "/EN/1", "net/"),
    ("http://badexample.net/en/1", "badexample.net", "/en/1", "net/"), ("https://example.com/de/", "example.com", "/de/", "example.com/de/"),
    ("https://example.com/de", "example.com", "/de", None), ("ftp://x.org/fr/a?b", "x.org", "/fr/a", "org/fr/"), ("x.org/fr/", "", "", None),
    ("https://h.org?x=/fr/", "h.org", "", None), ("https://h.org#/fr/", "h.org", "", None), ("a://b://c/d", "b:", "//c/d", None),
    ("://x.net/y", "x.net", "/y", "net/"), ("https://é.ORG/fr/ü", "é.org", "/fr/ü", "org/fr/"), ("", "", "", None), (None, "", "", None),
    ("https://x.net:80/a", "x.net:80", "/a", None), ("https://a.com/" + "p" * 20000, "a.com", "/" + "p" * 20000, None),
    ("https://x.net\n/a", "x.net\n", "/a", None),
]


def frame(spark, urls):
    return spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(2)


def test_hosts_paths_and_rules(spark):
    got = {r.page_id: r for r in UF.filter_urls(frame(spark, [u for u, *_ in URLS]).withColumn("rule", F.lit("clash"))).collect()}
    verdict = {h + p: v for h, p, v in UF.RULES}
    for i, (_, host, path, rule) in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule), URLS[i]
        assert got[i].verdict == verdict[rule] if rule else got[i].verdict in ("allow", "block")


def test_model_follows_the_ruled_urls(spark):
    good = [f"https://news{i % 7}.org/fr/story-{i}.html" for i in range(300)]
    bad = [f"https://casino{i % 7}.net/win-money-{i}" for i in range(300)]
    free = [f"https://news{i % 9}.com/story-{i}.html" for i in range(50)] + [f"https://casino{i % 9}.com/win-money-{i}" for i in range(50)]
    got = {r.page_id: r for r in UF.filter_urls(frame(spark, good + bad + free)).collect()}
    assert all(got[600 + i].verdict == "allow" and got[600 + i].rule is None for i in range(50))
    assert all(got[650 + i].verdict == "block" for i in range(50))


def test_probabilities_sum_to_one(spark):
    """The smoothed model is a distribution over the bytes that follow a context."""
    import numpy as np
    rows = spark.createDataFrame([(f"http://ab{i % 3}c.org/fr/", UF.ACCEPT) for i in range(50)], "url string, label int")
    model = UF.train(rows, 0.0)
    model.counts[UF.REJECT, 0] = model.counts[UF.REJECT, 1] = UF._Counts(np.zeros(0, np.uint64), np.zeros(0))
    symbols = [b for b in range(128) if chr(b) not in "123456789" and not chr(b).isupper()]
    for context in ("ab", "abc", "zzzz", ""):  # without counts the rejected class gives every byte 1 / 256
        texts = [context + chr(b) for b in symbols]
        codes, lengths = UF._codes(texts)
        assert lengths[0] == len(context) + 2 and len(codes) == sum(lengths) + UF.ORDER * len(lengths)
        difference, lengths = model.differences(texts)
        p = np.exp(difference[np.cumsum(lengths) - lengths + len(context)]) / 256
        assert sum(p) + (256 - len(p)) * p[symbols.index(0x7F)] == pytest.approx(1.0)  # the other bytes were never seen
        assert np.isfinite(model.scores(texts)).all()


def test_one_class_or_no_rows(spark):
    got = UF.filter_urls(frame(spark, ["https://a.org/fr/1", "https://b.org/x", None])).collect()
    assert len(got) == 3 and all(r.verdict in ("allow", "block") for r in got)
    assert UF.filter_urls(frame(spark, []).filter("false")).count() == 0
    assert {r.verdict for r in UF.filter_urls(frame(spark, ["https://b.com/x", ""])).collect()} == {"allow"}


def test_rare_grams_count(spark):
    """Over 100,000 characters a class: what occurs once still counts, and every score is that of all counts."""
    urls = [f"https://{h}.{top}/fr/{i * 7919 % 10007}-{'abcdefgh'[i % 8]}{'stuvwxyz'[i // 8 % 8]}-{h}-story-of-the-day.html"
            for i in range(3600) for h, top in ((f"n{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}{chr(97 + i // 676)}", "org"),
                                                (f"c{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}", "net"))]
    urls += ["https://nqjc.com/qjc", "https://ceve.com/eve", "", None] * 3
    got = {r.page_id: r.score for r in UF.filter_urls(frame(spark, urls)).collect()}
    ruled = frame(spark, urls).filter("(url LIKE '%.org/%' OR url LIKE '%.net/%') AND crc32(url) % 5 <> 0")
    model = UF.train(ruled.selectExpr("url", f"if(url LIKE '%.org/%', {UF.ACCEPT}, {UF.REJECT}) AS label"), 0.0)
    assert min(model.counts[x, 1].of(UF.np.zeros(1, UF.np.uint64))[0] for x in (UF.ACCEPT, UF.REJECT)) > 100_000
    assert min(model.counts[x, 0].n.min() for x in (UF.ACCEPT, UF.REJECT)) == 1
    assert [got[i] for i in range(len(urls))] == pytest.approx(list(model.scores([u or "" for u in urls])), abs=1e-9)


def test_op3_query_rules_in_sql(spark):
    """Everything but the model's verdict has a SQL form."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{SF001}/pages.parquet')")
    expected = con.execute(r"""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
        p AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        rules(rh, rp) AS (VALUES ('net', '/'), ('example.net', '/en/'), ('example.com', '/de/'), ('org', '/fr/'))
        SELECT page_id, host, path, (SELECT rh || rp FROM rules WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
                                     ORDER BY length(rh || rp) DESC LIMIT 1) AS rule FROM p""").fetchall()
    got = QUERIES["op3_url_filter"](spark, SF001)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(map(str, expected)) == sorted(str(tuple(r)[:4]) for r in got.collect())


# ---------------------------------------------------------------- HTML

P1 = "A long paragraph &amp; text with words enough to be dense, really many words here."
P2 = "Another one that goes on for a while, and on, and on, and on, until it ends."
WHOLE = f"{html.unescape(P1)}\n{P2}"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("   ", ""), ("just text &lt;b&gt; <b>bo</b>ld &nbsp; x", "just text <b> bold x"),
    (f"<body><nav>menu</nav><div id=content><p>{P1}</p><p>{P2}</p></div><footer>foot</footer></body>", WHOLE),
    (f"<body><header><h2>Site</h2></header><div class='main-sidebar'>{P2}</div><article><h1>T</h1><p>{P1}<p>{P2}</article></body>", "T\n" + WHOLE),
    (f"<article><header><h1>H</h1></header><p>{P1}</p><div class=comments><p>{P2 * 9}</p></div></article>", "H\n" + html.unescape(P1)),
    (f"<main><p>{P1}</p><form><p>Your name</p><input></form><aside>{P2}</aside><script>if (a < b) '</p>'</script><style>p{{}}</style></main>", html.unescape(P1)),
    (f"<article><p>{P1}</p></article><section id=comments><article class=comment><p>{P2 * 20}</p></article></section>", html.unescape(P1)),
    (f"<div><div class='cookie-notice'>{P2}</div><div class='ad banner'>{P2}</div><div><p>{P1}</p><p>{P2}</p></div></div>", WHOLE),
    (f"<article><p>{P1}</p><ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul><ul><li>point<li>next</ul></article>",
     html.unescape(P1) + "\npoint\nnext"),
    (f"<div class='page-header'>{P2}</div><article><div class='entry-header'><h1>H</h1></div><p>{P1}</p></article>", "H\n" + html.unescape(P1)),
    ("<article>x</article><footer>a footer that is far longer than the whole article</footer>", "x"),
    ("<body><nav>only a menu</nav></body>", ""), ("<p>a<br>b<script>x</script>c<!-- <p>no</p> -->d</p>", "a bcd"),
    ("<p>un\n  closed\t&#233;&eacute; <a href='x>y", "un closed éé y"), ("<article><table><tr><td>a<td>b</table></article>", "a\nb"),
    ("<P CLASS=x>Up<B>per</P>", "Upper"), ("a < b and c > d", "a < b and c > d"), ("<p hidden>no</p><p>yes</p>", "yes"),
    ("<div>" * 3000 + "deep" + "</div>" * 10, "deep"), ("<article><p>" + "w " * 100_000 + "</article>", ("w " * 100_000).strip()),
])
def test_extract(page, text):
    assert extract(page) == text


MANY, MANY_TEXT = f"<p>{P1}</p><p>{P2}</p>" * 5, "\n".join([WHOLE] * 5)


@pytest.mark.parametrize("page, text", [
    (f"<body><nav>menu</nav><article>{MANY}</article><div><article>{MANY}</article></div><article><p>{P2 * 4}</p></article></body>",
     f"{MANY_TEXT}\n{MANY_TEXT}\n{P2 * 4}"),
    (f"<body><main><p>{P2 * 4}</p><article><h1>T</h1>{MANY}</article><article>{MANY}</article></main><footer>{P2}</footer></body>",
     f"{P2 * 4}\nT\n{MANY_TEXT}\n{MANY_TEXT}"),
    (f"<body><article>{MANY}</article><article><a href=1>More</a> <a href=2>of</a> <a href=3>this</a></article><p>{P2 * 4}</p></body>", MANY_TEXT),
])
def test_extract_several_articles(page, text):
    assert extract(page) == text


LINKS = "".join(f"<li><a href={i}>Reference number {i}</a> {i}" for i in range(5))
ROWS = "".join(f"<tr><td><a href={i}>Row {i}</a></td></tr>" for i in range(4))


@pytest.mark.parametrize("within, text", [
    (f"<section id=discussion><h2 id=related-work>Work</h2><p>{P2}</p></section>", "Work\n" + P2),
    (f"<h2 id=search class=search>Search</h2><p id=notice-of-change>{P2}</p>", "Search\n" + P2),
    (f"<div class='notice-of-change'>{P2}</div><div class='comments-area'>{P2}</div><p class='related'>{P2}</p>", P2),
    (f"<div class=social_share>{P2}</div><div role=search>{P2}</div><nav>{P2}</nav><p hidden>{P2}</p>", ""),
    (f"<ol>{LINKS}</ol>", "\n".join(f"Reference number {i} {i}" for i in range(5))),
    (f"<ul>{LINKS}</ul>", "\n".join(f"Reference number {i} {i}" for i in range(5))),
    (f"<table>{ROWS}</table>", "\n".join(f"Row {i}" for i in range(4))),
    ("<div><a href=1>One</a>, <a href=2>two</a>, <a href=3>three</a></div>", "One, two, three"),
    (f"<ul class=menu>{LINKS}</ul><article class=comment-body><p>{P2}</p></article>", ""),
])
@pytest.mark.parametrize("element", ["article", "main"])
def test_extract_keeps_the_article(element, within, text):
    if "<article" in within and element == "main":
        pytest.skip("the comment would be the page's article")
    assert extract(f"<body><nav>menu</nav><{element}><p>{P1}</p>{within}</{element}></body>") == "\n".join(filter(None, [html.unescape(P1), text]))


SHORT = "A short lead."
LINKED_WORDS = "".join(f"<tr><td><a href={i}>word{i}</a><td>means {i} of the things that words can mean" for i in range(6))


@pytest.mark.parametrize("body, text", [
    (f"<div>{MANY}<div class='related-work'><p>{P2}</p></div></div>", f"{MANY_TEXT}\n{P2}"),
    (f"<div>{MANY}<section id='discussion'><p>{P2}</p></section></div>", f"{MANY_TEXT}\n{P2}"),
    (f"<div><h2 id=search-methods>Search methods</h2>{MANY}</div>", f"Search methods\n{MANY_TEXT}"),
    (f"<h1>Title</h1><p>{SHORT}</p><div>{MANY}</div>", f"Title\n{SHORT}\n{MANY_TEXT}"),
    (f"<div>{MANY}<table>{LINKED_WORDS}</table></div>", MANY_TEXT + "".join(f"\nword{i}\nmeans {i} of the things that words can mean" for i in range(6))),
    (f"<div>{MANY}<h2>References</h2><ul>{''.join(f'<li><a href={i}>Reference {i}</a>' for i in range(4))}</ul></div>",
     MANY_TEXT + "\nReferences\n" + "\n".join(f"Reference {i}" for i in range(4))),
    (f"<div>{MANY}<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul></div>", MANY_TEXT),
    (f"<div>{MANY}</div><div id=comments><p>{P2 * 30}</p></div><div class='main sidebar'>{P2}</div>", MANY_TEXT),
    (f"<form id=all><div class=widget><h1>Title</h1>{MANY}</div></form>", "Title\n" + MANY_TEXT),
    (f"<div class=widget>{MANY}</div><nav>menu</nav>", MANY_TEXT),
    (f"<article>{MANY}<h2>References</h2><ul>{''.join(f'<li><a href={i}>Reference {i}</a>' for i in range(4))}</ul></article>",
     MANY_TEXT + "\nReferences\n" + "\n".join(f"Reference {i}" for i in range(4))),
    (f"<article>{MANY}</article><article><p>{P2} <a href=1>{P2} {P2}</a> {P2}</p></article>", f"{MANY_TEXT}\n{P2} {P2} {P2} {P2}"),
])
def test_extract_drops_nothing_else(body, text):
    assert extract(f"<html><body><nav><a href=0>Home</a></nav>{body}<footer>foot</footer></body></html>") == text


class PlainTree(HTMLParser):
    """Nested [tag, own text, children] of well-formed markup."""

    def __init__(self, source):
        super().__init__()
        self.root = ["", "", []]
        self.stack = [self.root]
        self.feed(source)

    def handle_starttag(self, tag, attrs):
        node = [tag, "", []]
        self.stack[-1][2].append(node)
        self.stack.append(node)

    def handle_endtag(self, tag):
        self.stack.pop()

    def handle_data(self, data):
        self.stack[-1][1] += data


def plain_densities(source):
    """Density and density sum of every node in document order, by the published formulas, one recursion a figure."""
    root = PlainTree(source).root

    def walk(node):
        yield node
        for x in node[2]:
            yield from walk(x)

    chars = lambda node: sum(len("".join(x[1].split())) for x in walk(node))
    link_chars = lambda node: chars(node) if node[0] == "a" else sum(link_chars(x) for x in node[2])
    tags = lambda node: sum(1 for x in walk(node)) - 1
    links = lambda node: sum(x[0] == "a" for x in walk(node)) - (node[0] == "a")
    body = next(x for x in walk(root) if x[0] == "body")

    def density(node):
        n, ln = chars(node), link_chars(node)
        if not n:
            return 0.0
        t, lt = max(1, tags(node)), max(1, links(node))
        base = math.log(n / max(1, n - ln) * ln + link_chars(body) / max(1, chars(body)) * n + math.e)
        value = n / max(1, ln) * t / lt
        return n / t * max(0.0, math.log(value, base) if base > 1 else math.log(max(value, 1)))

    return [(density(x), sum(density(y) for y in x[2])) for x in walk(root)]


@pytest.mark.parametrize("inner", [
    f"<div><p>{P2}</p><p>{P1}</p></div>", f"<div><p>{P2} <a href=1>more</a></p></div><div><a href=2>x</a><a href=3>yy</a></div>",
    f"<div><div><p>{P2 * 3}</p></div><table><tr><td><a href=1>cell</a></td><td>{P1}</td></tr></table></div><p></p>", "<p><a href=1>all linked text</a></p>",
])
def test_density_formulas(inner):
    source = f"<html><body>{inner}</body></html>"
    page = Page(source)
    _, _, dense, sums, _, _ = page.measure([False] * len(page.tag))
    assert list(zip(dense, sums))[1:] == [pytest.approx(x) for x in plain_densities(source)][1:]


@pytest.mark.parametrize("page", ["<a href=\"" * 5000, "<p '=\"x" * 5000, "<div>" * 20_000, "</b>" * 20_000, "<" * 20_000, "<!--" * 9000,
                                  "<p><table>" + "<b>" * 9000 + "<div>" * 9000, "<script>" * 500, "&" * 5000, "<li>" * 9000, "</" * 9000])
def test_extract_hostile(page):
    assert isinstance(extract(page), str)


def test_extract_frames(spark):
    rows = [(1, "u", f"<p>{P1}</p>"), (1, "u", f"<p>{P1}</p>"), (None, None, None), (2, "v", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2).withColumn("text", F.lit("clash"))
    got = extract_pages(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(i, u, extract(h)) for i, u, h in rows]))
    assert extract_pages(df.limit(0)).count() == 0


def test_op9_query(spark):
    """The articles of the test pages, read by a pattern that fits their markup."""
    pages = duckdb.sql(f"SELECT page_id, html FROM read_parquet('{SF001}/pages.parquet')").fetchall()
    expected = {}
    for i, page in pages:
        article = re.search(r"<article>(.*)</article>", page, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|article)>", article)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in blocks]
        expected[i] = "\n".join(b for b in blocks if b)
    got = QUERIES["op9_html_extraction"](spark, SF001).collect()
    assert {r.page_id: r.text for r in got} == expected and all(r.n_chars == len(r.text) for r in got)
