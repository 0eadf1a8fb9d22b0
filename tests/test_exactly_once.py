"""Publishing exactly once, whatever is stopped or overtaken; and the review loop up to published rows."""

import pytest
from pyspark.sql import functions as F
from test_jobs import AS_OF, HOLD, cells, docs, folder, holding  # noqa: F401

from holdsift.operators import lifecycle, novelty
from holdsift.operators import warehouse as W
from holdsift.plans import ingest
from holdsift.sources import commits
from holdsift.sources.commits import PublishedStore

ORDER = ["document_id", "row_idx"]


def batch(spark, *rows):
    return W.publish_rows(spark.createDataFrame([holding(*r[:4], **(r[4] if len(r) > 4 else {})) for r in rows], HOLD))


def state(store):
    return sorted((r.isin, r.period_month, r.quantity, r.version, r.touched_by) for r in store.read().collect())


class Stopped(RuntimeError):
    pass


@pytest.mark.parametrize("step", ["_staged", "_merge", "_add"])
@pytest.mark.parametrize("after", [False, True])
def test_a_run_stopped_anywhere_ends_like_one_clean_run(spark, folder, monkeypatch, step, after):  # noqa: F811
    first = batch(spark, ("d1", 0, "INE1", "1"), ("d1", 1, "INE2", "2", {"month": 6}))
    again = batch(spark, ("d2", 0, "INE1", "5"), ("d2", 1, "INE1", "6"), ("d2", 2, "INE3", "7", {"month": 7}))
    clean, broken = PublishedStore(spark, f"{folder}/clean"), PublishedStore(spark, f"{folder}/broken")
    for s in (clean, broken):
        s.publish("run-1", first, ORDER, AS_OF)
    clean.publish("run-2", again, ORDER, AS_OF)
    real, before = getattr(PublishedStore, step), state(broken)

    def stop(self, *args):
        if after:
            real(self, *args)
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(PublishedStore, step, stop)
        with pytest.raises(Stopped):
            broken.publish("run-2", again, ORDER, AS_OF)
    committed = step == "_add" and after
    assert state(broken) == (state(clean) if committed else before)  # nothing in between is ever seen
    broken.publish("run-2", again, ORDER, AS_OF)
    broken.publish("run-1", first, ORDER, AS_OF)  # an older run, started once more
    assert state(broken) == state(clean) and broken.head().number == 2
    assert state(clean) == [("INE1", 5, 6.0, 3, "run-2"), ("INE2", 6, 2.0, 1, "run-1"), ("INE3", 7, 7.0, 1, "run-2")]


def test_an_overtaken_run_merges_into_what_stands(spark, folder, monkeypatch):  # noqa: F811
    store = PublishedStore(spark, f"{folder}/p")
    store.publish("run-1", batch(spark, ("d1", 0, "INE1", "1"), ("d1", 1, "INE2", "2", {"month": 6})), ORDER, AS_OF)
    real, merge, merges = PublishedStore._add, PublishedStore._merge, []
    others = [("run-a", batch(spark, ("a", 0, "INE1", "10"))), ("run-b", batch(spark, ("b", 0, "INE2", "20", {"month": 6})))]

    def overtaken(self, commit):
        if commit.run == "run-2" and others:
            name, rows = others.pop(0)
            PublishedStore(spark, store.path).publish(name, rows, ORDER, AS_OF)
        real(self, commit)

    monkeypatch.setattr(PublishedStore, "_add", overtaken)
    monkeypatch.setattr(PublishedStore, "_merge", lambda self, *a: (merges.append(a[5]), merge(self, *a)))
    store.publish("run-2", batch(spark, ("d2", 0, "INE1", "3")), ORDER, AS_OF)
    assert state(store) == [("INE1", 5, 3.0, 3, "run-2"), ("INE2", 6, 20.0, 2, "run-b")]
    assert merges == ["run-2", "run-a", "run-2", "run-b"]  # merged anew for run-a's month, not for run-b's
    with pytest.raises(commits.Taken):
        real(store, commits.Commit(1, "late", {}))


def test_a_run_stopped_after_publishing_keeps_versions(spark, folder, monkeypatch):  # noqa: F811
    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(novelty, "ledger_upsert", stop)
        with pytest.raises(Stopped):
            ingest.run(spark, folder, 1, docs(spark), cells(spark), AS_OF)
    ingest.run(spark, folder, 1, docs(spark), cells(spark), AS_OF)
    got = {(r.isin, r.instrument_name): r.version for r in ingest.refresh_published(spark, folder).collect()}
    assert got == {("INE000", "A"): 1, ("INE001", "A"): 1, (None, "B"): 2}
    assert all(r.content_hash for r in ingest.read_ledger(spark, folder).collect())


REVIEW = ("review_id long, doc_id string, decision string, reviewer string, notes string, reviewed_at timestamp, corrected_amc_name string, "
          "corrected_scheme_name string, corrected_period_month int, corrected_period_year int")


def test_reviewed_documents_are_published(spark, folder, monkeypatch):  # noqa: F811
    vague = docs(spark, 3).withColumns({
        "file_hash_sha256": F.concat(F.lit("h"), "doc_id"), "filename": F.concat("doc_id", F.lit(".xlsx")),
        "url": F.concat(F.lit("https://files.example.org/"), "doc_id"), "header_text": F.lit("portfolio"), "source_amc": F.lit(None).cast("string"),
        "page_context": F.lit(None).cast(docs(spark).schema["page_context"].dataType)})
    both = vague.unionByName(docs(spark, 4, 3).filter("file_type = 'xlsx' and doc_id = 'doc4'"))
    ingest.run(spark, folder, 1, both, cells(spark, 5), AS_OF)
    assert {r.doc_id: r.status for r in ingest.read_ledger(spark, folder).collect()} == {
        "doc0": "QUARANTINED", "doc1": "QUARANTINED", "doc2": "QUARANTINED", "doc4": "PUBLISHED"}
    at = [f"2026-07-0{i}" for i in range(1, 6)]
    rows = [(1, "doc0", "REJECTED", "ann", "", at[0]), (2, "doc0", "RECLASSIFIED", "ann", "n", at[1], "SBI Mutual Fund", "SBI Liquid Fund", 6, 2026),
            (3, "doc1", "REJECTED", "bob", "", at[2]), (4, "doc4", "ACCEPTED", "bob", "", at[3]), (5, "doc9", "ACCEPTED", "bob", "", at[4])]
    reviews = spark.createDataFrame([(*r, None, None, None, None)[:10] for r in rows], REVIEW.replace("reviewed_at timestamp", "reviewed_at string"))
    reviews = reviews.withColumn("reviewed_at", F.col("reviewed_at").cast("timestamp"))

    def stop(*_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(novelty, "ledger_upsert", stop)
        with pytest.raises(Stopped):
            ingest.resume(spark, folder, 2, reviews, cells(spark, 5), AS_OF)
    got = {r.doc_id: r.status for r in ingest.resume(spark, folder, 2, reviews, cells(spark, 5), AS_OF).collect()}
    assert got == {"doc0": "PUBLISHED", "doc1": "REJECTED"}
    assert {r.doc_id: r.status for r in ingest.read_ledger(spark, folder).collect()} == {
        "doc0": "PUBLISHED", "doc1": "REJECTED", "doc2": "QUARANTINED", "doc4": "PUBLISHED"}
    rows = {(r.document_id, r.isin): (r.amc_name, r.scheme_name, r.version, r.touched_by) for r in ingest.refresh_published(spark, folder).collect()}
    assert rows["doc0", "INE000"] == ("SBI Mutual Fund", "SBI Liquid Fund", 1, "run-2")
    errors = {(r.doc_id, r.error) for r in spark.read.parquet(f"{folder}/run=2/review_errors").collect()}
    assert errors == {("doc4", "ILLEGAL_EVENT: ACCEPTED in state PUBLISHED"), ("doc9", "UNKNOWN_DOCUMENT")}
    audit = {(r.entity_id, r.actor) for r in spark.read.parquet(f"{folder}/run=2/review_audit").collect()}
    assert audit == {("doc0", "ann"), ("doc1", "bob")}
    # a rejected document may still be reclassified, and a released one is no longer settled
    later = reviews.filter("review_id = 2").withColumn("doc_id", F.lit("doc1"))
    assert {r.doc_id: r.status for r in ingest.resume(spark, folder, 3, later, cells(spark, 5), AS_OF).collect()} == {"doc1": "PUBLISHED"}
    released = ingest.read_ledger(spark, folder).withColumn("status", F.lit("CLASSIFIED"))
    assert novelty.not_settled(released.select("source_id", "url_fingerprint"), released).count() == 4


def test_moves_and_histories(spark):
    known = spark.createDataFrame([("a", "QUARANTINED", 1), ("b", "PUBLISHED", 2), ("c", None, 3)], "doc_id string, status string, event_no int")
    events = spark.createDataFrame([("a", "ACCEPTED"), ("b", "REJECTED"), ("c", "HELD"), ("d", "HELD"), (None, "HELD")], "doc_id string, event string")
    moved, errors = lifecycle.move(known, events)
    assert [tuple(r) for r in moved.collect()] == [("a", "CLASSIFIED", 1, "ACCEPTED", "QUARANTINED")]
    assert sorted(r.error for r in errors.collect()) == [
        "ILLEGAL_EVENT: HELD in state none", "ILLEGAL_EVENT: REJECTED in state PUBLISHED", "UNKNOWN_DOCUMENT"]
    assert all(x.count() == 0 for x in lifecycle.move(known, events.limit(0)))
    h = spark.createDataFrame([("a", 1, "X", "DOWNLOADED"), ("a", 2, "HELD", "QUARANTINED"), ("a", 13, "ACCEPTED", "CLASSIFIED"),
                               ("a", 14, "PUBLISHED", "PUBLISHED"), ("b", 2, "X", "FAILED"), ("b", 25, "DOWNLOADED", "PUBLISHED")],
                              "doc_id string, at int, event string, status string")
    bad = lifecycle.illegal_moves(h, ["at"], F.floor(F.col("at") / 10))
    assert sorted((r.doc_id, r.at, r.status_before) for r in bad.collect()) == [("a", 14, "CLASSIFIED"), ("b", 25, "FAILED")]
    with pytest.raises(ValueError):
        lifecycle.transition_table(spark, [("DISCOVERED", "X", "NOWHERE")])
