"""URL, period, fuzzy, header and number functions against plain Python."""

import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import cells as C
from holdsift.functions import fuzzy as Z
from holdsift.functions import html as H
from holdsift.functions import urls as U
from holdsift.functions.periods import period_from_text, period_label


def col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[1] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_normalize_url(spark):
    cases = {
        "HTTPS://Cdn.Example.org/Docs//A.pdf?V=2&b=2&a=x%20y+z&a=9&e=#top": "https://Cdn.Example.org/Docs//A.pdf?a=x y z&b=2",
        "https://h/p;v=1?_=3": "https://h/p",
        "https://h/a;1/b;2?k=100%&j=%zz": "https://h/a;1/b?j=%zz&k=100%",
        "https://h/p?novalue&x=": "https://h/p",
    }
    assert col(spark, list(cases), U.normalize_url) == list(cases.values())


def test_extended_profile(spark):
    got = col(
        spark, ["HTTPS://cdn.SBIMF.com/Docs//Portfolio/file.pdf?_ts=123456&type=pdf", "http://H:80/a/./b/../%41c/"],
        lambda c: U.normalize_url(c, "extended", lower_path=True),
    )
    assert got == ["https://cdn.sbimf.com/docs/portfolio/file.pdf?type=pdf", "http://h/a/ac"]


def test_resolve_url(spark):
    base = "https://h.org/a/b/c.html?q=1#f"
    hrefs = ["x.pdf", "../x.pdf", "../../../x", "/r/./s/../t.pdf?y=1#z", "?n=2", "#frag", "//o.org/p", "mailto:a@b",
             "https://z.org/q", ".", "..", "d/"]
    got = col(spark, hrefs, lambda c: U.resolve_url(F.lit(base), c))
    assert got == [urljoin(base, h) for h in hrefs]


def test_file_type_and_names(spark):
    assert col(spark, ["https://h/a/b.PDF", "https://h/a/", "https://h/.pdf", "https://h/x.tar/"], U.filename_from_url) == ["b.PDF", None, ".pdf", "x.tar"]
    assert col(spark, ["https://h/a/b.PDF", "https://h/.pdf", "https://h/a"], lambda c: U.file_type(c, F.lit("X/Excel"))) == ["pdf", "xlsx", "xlsx"]


@pytest.mark.parametrize("text,want", [
    ("Portfolio June 2026", (6, 2026)), ("June-26", (6, 2026)), ("as on 31st May 2026", (5, 2026)),
    ("for April, 2026", (4, 2026)), ("2026-06", (None, 2026)), ("files 19 25", (None, 2025)),
    ("december 2024 and jan 2025", (12, 2024)), ("jan 2025 december 2024", (12, 2024)), ("may", (5, None)), ("", (None, None)),
])
def test_period_from_text(spark, text, want):
    r = col(spark, [text], period_from_text)[0]
    assert (r["month"], r["year"]) == want


def test_period_label(spark):
    df = spark.createDataFrame([(6, 2026), (13, 2026), (None, 2026)], "m int, y int")
    assert [r[0] for r in df.select(period_label(F.col("m"), F.col("y"))).collect()] == ["June 2026", None, None]


def _lcs(a, b):
    d = [0] * (len(b) + 1)
    for x in a:
        p = 0
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], p + 1 if x == y else max(d[j], d[j - 1])
    return d[-1]


def _ratio(a, b):
    return 200.0 * _lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def _partial(a, b):
    if not a or not b:
        return 100.0 if len(a) == len(b) else 0.0
    if len(a) > len(b):
        a, b = b, a
    one = lambda s, t: max(_ratio(s, t[max(i, 0): min(i + len(s), len(t))]) for i in range(1 - len(s), len(t)))
    return max(one(a, b), one(b, a)) if len(a) == len(b) else one(a, b)


def test_fuzzy_scores_against_plain_lcs(monkeypatch):
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("ab cé") for _ in range(rnd.randint(0, n)))
    for _ in range(300):
        a, b = word(12), word(40)
        assert Z.indel_ratio(a, b) == pytest.approx(_ratio(a, b))
        assert Z.partial_ratio(a, b) == pytest.approx(_partial(a, b))
    long = "x" * 70 + "ab"
    assert Z.partial_ratio(long, "y" + long + "z") == 100.0
    names = [w for w in (word(12) for _ in range(25)) if w]
    texts = [word(70) for _ in range(60)]
    for block in (1 << 18, 31, 19):  # small blocks cut texts into pieces
        monkeypatch.setattr(Z, "_BLOCK", block)
        who, top = Z.Finder(names).best(texts, 70.0)
        for t, w, s in zip(texts, who, top):
            best, arg = 70.0, -1
            for k, n in enumerate(names):
                p = _partial(n, t)
                if p > best:
                    best, arg = p, k
            assert (w, s) == (arg, pytest.approx(best))


def test_fuzzy_columns(spark):
    names = ["sbi blue chip fund jun 2026", "top 100 hdfc fund", "nothing like it", None]
    got = col(spark, names, lambda c: Z.scheme_by_name(c, R.FUZZY_FILENAME_CUT))
    assert [g["scheme_name"] for g in got][1:] == ["HDFC Top 100 Fund", None, None]
    text = "x " * 5000 + "statement of hdfc liquid fund" + " y" * 5000
    got = col(spark, [text, "no names", None], lambda c: Z.scheme_in_text(c, R.FUZZY_HEADER_CUT))
    assert [g["scheme_name"] for g in got] == ["HDFC Liquid Fund", None, None]
    df = spark.createDataFrame([(["Sheet1", "SBI Liquid", "HDFC Liquid"],), (["Sheet1"],), (None,)], "s array<string>")
    got = [r[0] for r in df.select(Z.scheme_by_sheets(F.col("s"), R.FUZZY_SHEET_CUT)).collect()]
    pairs = [
        s.scheme_name for sheet in ("sheet1", "sbi liquid", "hdfc liquid") for s in R.SCHEME_MASTER
        if any(_partial(n.lower(), sheet) > R.FUZZY_SHEET_CUT for n in (s.scheme_name, *s.aliases))
    ]
    assert (got[0]["scheme_name"], got[0]["hits"]) == (pairs[-1], len(pairs))
    assert got[1]["hits"] == 0 and got[2]["scheme_name"] is None


@pytest.mark.parametrize("dialect,cell,field", [
    ("excel", "Instrument Type", "instrument_name"), ("excel", "% to Total", "market_value"),
    ("excel", "Face Value", "market_value"), ("pdf", "Face Value", "quantity"), ("excel", "Name", "instrument_name"),
    ("excel", "Fund Name X", None), ("excel", "Unnamed: 3", None), ("pdf", "% to NAV", "pct_to_net_assets"), ("pdf", "", None),
])
def test_header_rules_keep_their_order(spark, dialect, cell, field):
    assert col(spark, [cell], lambda c: C.header_field(c, dialect)) == [field]


def test_number_cells(spark):
    vals = ["1,23,456.50", "(12.5)", "-", "nil", "1.5d", "1e3", " 7 ", "—", None]
    got = col(spark, vals, lambda c: C.number_cell(c, "excel"))
    assert [(g["num"], g["txt"]) if g else (None, None) for g in got] == [
        (123456.5, None), (-12.5, None), (None, None), (None, "nil"), (None, "1.5d"), (1000.0, None), (7.0, None),
        (None, None), (None, None),
    ]


def test_excel_column_names(spark):
    got = col(spark, [["A", None, "A", "", "A"]], C.excel_column_names, "array<string>")[0]
    assert got == ["A", "Unnamed: 1", "A.1", "Unnamed: 3", "A.2"]


PAGE = """<html><body class="main" id="b"><!-- <a href="no.pdf">x</a> --><form><select name="ddlMonth"><option>May</option>
<option selected>June 2026</option></select><select id="y"><option value="1">2025</option></select></form>
<div class="row"><p>Monthly portfolio <a href="../f/Doc.pdf?a=1&amp;b=2" title="T" data-scheme='SBI Liquid' aria-label="L">Get <b>it</b></a> now</p></div>
<script>var s = "</div><a href='bad.pdf'>";</script></body></html>"""


def test_page_context(spark):
    df = spark.createDataFrame([(PAGE,)], "html string")
    a = df.select(H.anchors(F.col("html"))).first()[0]
    assert len(a) == 1
    link = a[0]
    assert link["href"] == "../f/Doc.pdf?a=1&b=2" and link["link_text"] == "Get it" and link["title"] == "T"
    assert link["parent_text"] == "Monthly portfolio Get it now" and link["aria_label"] == "L"
    assert [(d["k"], d["v"]) for d in link["data_attrs"]] == [("data-scheme", "SBI Liquid")]
    drops = df.select(H.dropdowns(F.col("html"))).first()[0]
    assert [(d["k"], d["v"]) for d in drops] == [("ddlMonth", "June 2026"), ("y", "2025")]


def test_structure_depth(spark):
    html = "<body>" + "<div>" * 8 + "</div>" * 8 + "<br><p class='k' id=z></body>"
    got = col(spark, [html], H.structure_sequence)[0]
    assert got == "body.#>div.#>div.#>div.#>div.#>div.#>>br.#>p.k#z"
