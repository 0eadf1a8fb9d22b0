"""Cases that once went wrong: null keys, blank lines and long quoted lines, header names by position, sheet lines."""

from pyspark.sql import functions as F

from holdsift.operators import grid as G
from holdsift.operators import keys as K
from holdsift.sources import grids, tables

CELLS = "doc_id string, table_id int, sheet_name string, sheet_idx int, row_idx int, cells array<string>"


def test_rows_with_null_keys_stay(spark):
    rows = [("a", 1, 1.0), ("a", 2, 2.0), (None, 1, 5.0), (None, 3, 7.0), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, t int, x double")
    got = {(r.g, r.t): (r.sum_before, r.n_before) for r in K.running_before(df, ["g"], ["t"], F.col("x"), F.col("t")).collect()}
    assert got == {("a", 1): (0.0, 0), ("a", 2): (1.0, 1), (None, 1): (0.0, 0), (None, 3): (5.0, 1), ("b", None): (0.0, 0)}


def read(spark, tmp_path, text):
    (tmp_path / "f.csv").write_bytes(text.encode())
    return [r.cells for r in grids.read_grid_csv(spark, str(tmp_path)).orderBy("row_idx").collect()]


def test_blank_lines_keep_their_number(spark, tmp_path):
    assert read(spark, tmp_path, 'Title\n\nh1,h2\r\n,b\n"a\nb","c ""d"""\n') == [["Title"], [None], ["h1", "h2"], [None, "b"], ["a\nb", 'c "d"']]


def test_last_line_without_a_break_and_unbalanced_quotes(spark, tmp_path):
    assert read(spark, tmp_path, 'a,b\nc,"d') == [["a", "b"], ["c", '"d']]


def test_long_quoted_line(spark, tmp_path):
    (row,) = read(spark, tmp_path, ",".join(['"x, ""y"""'] * 60_000))
    assert len(row) == 60_000 and set(row) == {'x, "y"'}


def test_columns_are_named_by_their_own_cell(spark):
    head = ["ISIN", None, "Security", "Quantity"]
    df = spark.createDataFrame([("d", 0, "s", 0, 0, head), ("d", 0, "s", 0, 1, ["x", None, "y", "1"])], CELLS)
    got = {r.field: (r.column_idx, r.column_name) for r in G.column_mapping(G.header_rows(df, "pdf")).collect()}
    assert got["isin"] == (0, "ISIN") and got["quantity"] == (3, "Quantity") and got["instrument_name"] == (2, "Security")


def test_header_text_names_each_sheet(spark):
    rows = [("d", s, f"S{s}", s, i, [f"r{s}{i}", None, "x"]) for s in range(7) for i in range(12)] + [("e", 0, None, 0, 0, [None, None])]
    got = {r.doc_id: r for r in G.header_text(spark.createDataFrame(rows, CELLS)).collect()}
    assert got["d"].header_text == "".join(" " + " ".join(f"r{s}{i} x" for i in range(10)) + f"\n[Sheet: S{s}]\n" for s in range(5))
    assert got["d"].sheet_names == [f"S{s}" for s in range(7)]
    assert got["e"].header_text == " \n[Sheet: None]\n"


def test_only_the_periods_of_a_batch(spark):
    published = spark.createDataFrame([(2026, m, m) for m in range(1, 7)], "period_year int, period_month int, x int")
    batch = spark.createDataFrame([(2026, 2), (2026, 2), (2026, 5)], "period_year int, period_month int")
    assert sorted(r.x for r in tables.only_periods(published, batch).collect()) == [2, 5]


def test_each_source_takes_the_links_its_selectors_match(spark):
    from holdsift.operators import links as L
    from holdsift.sources import registry

    html = "<a href='/a.xlsx'>x</a><a href='/portfolio/june'>y</a><a href='/a.pdf' download>z</a><a href='/download/q'>w</a>"
    keys = ["sbi_mf", "hdfc_mf", "nippon_india", "bare_net", "bare_link"]
    pages = spark.createDataFrame([(k, f"https://{i}.example.org/p", html) for i, k in enumerate(keys)], "source_key string, url string, html string")
    bare = [{"source_key": k, "amc_name": k, "base_url": "https://e.example", "strategy": s}
            for k, s in (("bare_net", "network_intercept"), ("bare_link", "link_extraction"))]
    reg = registry.sources(spark, [*registry.R.SOURCES, *bare])
    none = spark.createDataFrame([], "source_key string, seq long, url string, content_type string")
    got = {}
    for r in L.discover(pages, none, reg).collect():
        got.setdefault(r.source_key, set()).add(r.url.split("org", 1)[1])
    files = {"/a.xlsx", "/a.pdf"}
    words = {"/portfolio/june", "/download/q"}
    assert got == {"sbi_mf": files, "hdfc_mf": files | words, "nippon_india": files, "bare_link": files | words}


def test_nameless_rows_are_numbered_among_the_kept(spark):
    rows = spark.createDataFrame([("d", 0, 1, "a"), ("d", 0, 4, None), ("d", 0, 9, None), ("e", 0, 7, None)], "doc_id string, table_id int, row_idx int, isin string")
    assert sorted((r.doc_id, r.row_idx) for r in G.number_kept_rows(rows).collect()) == [("d", 0), ("d", 1), ("d", 2), ("e", 0)]


def test_a_stopped_run_finds_its_drift_again_and_a_finished_one_is_not_repeated(spark, tmp_path, monkeypatch):
    import pytest
    from test_jobs import AS_OF, cells, docs

    from holdsift.operators import novelty
    from holdsift.plans import ingest

    store = str(tmp_path / "store")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(novelty, "ledger_upsert", stop)
        with pytest.raises(RuntimeError):
            ingest.run(spark, store, 1, docs(spark), cells(spark), AS_OF)
    before = spark.read.parquet(f"{store}/run=1/drift").count()
    first = ingest.run(spark, store, 1, docs(spark), cells(spark), AS_OF).first()
    assert spark.read.parquet(f"{store}/run=1/drift").count() == before
    staged = sorted(map(tuple, ingest.read_staging(spark, store).collect()))
    assert ingest.run(spark, store, 1, docs(spark), cells(spark), AS_OF).first() == first
    assert sorted(map(tuple, ingest.read_staging(spark, store).collect())) == staged
