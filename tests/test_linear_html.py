"""Links and structure of a page, read in one walk, against the definitions stated with searches over all tags."""

import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import html as H
from holdsift.operators.links import discover
from holdsift.sources import registry

BLANK = H._BLANK


def without_noise(html):
    return re.sub(r"(?isa)<!--.*?-->|<script(?u:\b).*?</script\s*>|<style(?u:\b).*?</style\s*>", "", html)


def plain_tokens(html):
    out, depth = [], 0
    for raw in re.findall(r"(?s)<[^>]*>|[^<]+", without_noise(html)):
        name = re.match(r"</?([A-Za-z][A-Za-z0-9\-]*)", raw)
        kind = ("text" if raw[0] != "<" else "other" if not name else "void" if name[1].lower() in R.VOID_TAGS
                else "close" if raw[1] == "/" else "open")
        depth -= kind == "close"
        out.append((raw, kind, name[1].lower() if name else "", depth))
        depth += kind == "open"
    return out


def plain_links(html):
    toks = plain_tokens(html)
    n = len(toks)

    def end_of(at, depth):
        return next((i for i in range(at + 1, n) if toks[i][1] == "close" and toks[i][3] == depth), n)

    def around(at, depth):
        return next((i for i in range(at - 1, -1, -1) if toks[i][1] == "open" and toks[i][3] == depth), None)

    def text(at, depth, chars):
        if at is None:
            return ""
        joined = "".join(t[0] for t in toks[at + 1: end_of(at, depth)] if t[1] == "text")
        return H._decoded(joined).strip(BLANK)[:chars]

    found = []
    for i, (raw, kind, name, depth) in enumerate(toks):
        if kind == "open" and name == "a" and H._value(raw, "href"):
            found.append((H._value(raw, "href"), text(i, depth, 200), text(around(i, depth - 1), depth - 1, 500),
                          text(around(i, depth - 2), depth - 2, 500)))
    return found


def read_links(html):
    return [(x["href"], x["link_text"], x["parent_text"], x["grandparent_text"]) for x in H._read_links(H._clean(html))]


PIECES = st.sampled_from([
    "<div>", "</div>", "<p class=' k '>", "</p>", "<a href='/x.pdf'>", "<A HREF=/y>", "</a>", "<a>", "<br>", "</br>", "<td/>", "<", ">", "<>",
    "< a", "&amp;", "&am", "p;", "&nbsp;", "&lt", ";", " ", "\n\t", "\x85", "text", "é", "x" * 90, "<!--", "-->", "<script>", "</script >",
    "<style>", "</style>", "<body>", "</body>", "<body class=\"q\" id='i'>", "<scripté>", "&" * 7, "&amp;" * 150, " " * 700, "&nbsp;" * 80, "&nb", "sp;"])


@settings(max_examples=400, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join))
def test_links_equal_the_searches(html):
    assert H._clean(html) == without_noise(html)
    assert "".join(H._pieces(html)) == "".join(t for t in re.findall(r"(?s)<[^>]*>|[^<]+", html))
    assert read_links(html) == plain_links(html)


def plain_structure(html, max_depth):
    body = re.search(r"(?isa)(<body(?u:\b).*?)(?:</body\s*>|\Z)", without_noise(html))
    out, depth = [], 0
    for tag in re.findall(r"(?s)</?[A-Za-z][^>]*>", body[1] if body else ""):
        name = re.match(r"</?([A-Za-z][A-Za-z0-9\-]*)", tag)[1].lower()
        if not tag.startswith("</") and depth <= max_depth + 1:
            node = f"{name}.{H._value(tag, 'class').strip(' ')[:50]}#{H._value(tag, 'id')}"
            out.append(node if depth <= max_depth else "")
        depth += 0 if name in R.VOID_TAGS else -1 if tag.startswith("</") else 1
    return ">".join(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join), st.integers(0, 3))
def test_structure_equals_the_plain_reading(html, depth):
    html = "<body>" + html
    assert H._read_structure(H._clean(html), depth) == plain_structure(html, depth)


def test_time_follows_the_length():
    """Flat, nested, endless and blank pages: eight times the elements take about eight times as long, not sixty-four."""
    flat = "<div>" + "<p>word <a href='/a.pdf'>one</a></p>"
    makers = [lambda n: flat * n, lambda n: "<div><a href='/x'>" * n, lambda n: "<!--" * n + "<script>" * n, lambda n: "<" * n,
              lambda n: "<body>" + "<a href=/q>" + "<p>x" * n, lambda n: "<td><a href=/a></a>" * n + " &nbsp;" * n]
    for make in makers:
        took = []
        for n in (1000, 8000):
            html, best = make(n), 1e9
            for _ in range(2):
                at = time.process_time()
                H._read_links(H._clean(html))
                H._read_structure(H._clean(html), 5)
                best = min(best, time.process_time() - at)
            took.append(best)
        assert took[1] < 24 * took[0] + 0.05, (make(1), took)


def test_columns_and_nulls(spark):
    html = "<body><ul><li>June <a href='/a.xlsx' title='T &amp; U' aria-label=\"L\" data-Code='7' data-x download>Get</a></li></ul></body>"
    df = spark.createDataFrame([(1, html), (2, ""), (3, None)], "id int, html string").orderBy("id")
    got = df.select(H.page_parts(F.col("html")).alias("p"), H.anchors(F.col("html")).alias("a"),
                    H.structure_hash(F.col("html")).alias("h")).collect()
    link = got[0].a[0]
    assert (link.link_idx, link.href, link.download, link.link_text, link.parent_text, link.grandparent_text, link.title, link.aria_label) == (
        0, "/a.xlsx", True, "Get", "June Get", "June Get", "T & U", "L")
    assert [(x.k, x.v) for x in link.data_attrs] == [("data-code", "7"), ("data-x", "")]
    for row in got:
        assert row.p.links == row.a and row.p.structure_hash == row.h
    assert got[1].a == [] and got[2].a is None and got[2].h is None


def test_structure_of_a_source_is_that_of_its_first_page(spark):
    key = next(s["source_key"] for s in R.SOURCES if s["strategy"] != "link_extraction")
    pages = spark.createDataFrame(
        [(key, "https://h.org/b", "<body><p></p></body>"), (key, "https://h.org/a", "<body><i></i></body>"), (key, None, "<body><b></b></body>")],
        "source_key string, url string, html string")
    responses = spark.createDataFrame([(key, 1, "https://h.org/f.xlsx", "application/vnd.ms-excel")],
                                      "source_key string, seq long, url string, content_type string")
    got = discover(pages, responses, registry.sources(spark)).select("page_structure_hash").collect()
    want = pages.filter("url = 'https://h.org/a'").select(H.structure_hash(F.col("html"))).first()[0]
    assert [r[0] for r in got] == [want]
