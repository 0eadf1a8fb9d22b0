"""Discovered documents keep their page context; the stream decides as the whole classification does."""

from holdsift.operators import links as L
from holdsift.operators.classify import classify
from holdsift.plans import catalog
from holdsift.plans.queries_signals import AS_OF, docs
from holdsift.sources import registry


def test_discovered_documents_keep_their_page_context(spark):
    html = "<div>June 2026 <p>SBI Liquid Fund <a href='/a.xlsx'>Monthly portfolio</a></p></div>"
    keys = ["sbi_mf", "hdfc_mf", "nippon_india"]
    pages = spark.createDataFrame([(k, f"https://{k}.example.org/p", html) for k in keys], "source_key string, url string, html string")
    seen = spark.createDataFrame([(k, 1, f"https://{k}.example.org/r.pdf", "application/pdf") for k in keys],
                                 "source_key string, seq long, url string, content_type string")
    got = {(r.source_key, r.filename): r.page_context for r in L.discover(pages, seen, registry.sources(spark)).collect()}
    assert {k for k, name in got if name == "a.xlsx"} == set(keys)
    for (_, name), context in got.items():
        if name == "a.xlsx":
            assert context.link_text == "Monthly portfolio" and "SBI Liquid Fund" in context.parent_text
        else:
            assert context is None
    assert any(name == "r.pdf" for _, name in got)


def test_stream_decides_as_the_whole_classification(spark, sf):
    d = docs(spark, sf)
    decisions = lambda df: sorted((r.doc_id, r.decision) for r in df.select("doc_id", "decision").collect())
    whole = decisions(classify(d, AS_OF, keep=("doc_id", "source_id")))
    without = decisions(classify(d, AS_OF, fuzzy=False, keep=("doc_id", "source_id")))
    stream = dict(decisions(catalog.QUERIES["stream_ingest"](spark, sf)))
    assert whole != without
    assert stream == {d: x for d, x in whole if d in stream}
