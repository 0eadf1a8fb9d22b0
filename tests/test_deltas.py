"""The ledger as deltas, header drift in order, and the stream up to published holdings."""

import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_jobs import AS_OF, cells, docs, folder  # noqa: F401

from holdsift.operators import drift as D
from holdsift.operators import keys as K
from holdsift.plans import ingest
from holdsift.sources.commits import Commit, CommitLog
from holdsift.sources.deltas import KeyedDeltas
from holdsift.streaming import increments as X

ROW = "source_id int, name string, value long, tag string"


def table(spark, folder, **options):  # noqa: F811
    return KeyedDeltas(spark, f"{folder}/t", ROW, ["source_id", "name"], **{"buckets": 4, "runs": 3, **options})


def put(spark, store, run, rows):
    return store.write(run, lambda _: spark.createDataFrame(rows, ROW))


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_newest_rows_win_and_folders_stay_few(spark, folder):  # noqa: F811
    rng, store, want = random.Random(4), table(spark, folder), {}
    for run in range(12):
        batch = {(s, f"n{i}"): (s, f"n{i}", run, rng.choice("xyz")) for s, i in
                 {(rng.randrange(2), rng.randrange(30)) for _ in range(10)}}
        want.update(batch)
        commit = put(spark, store, f"run-{run}", list(batch.values()))
        assert all(len(runs) < 6 for runs in commit.folders.values())
    assert any(f"compaction-{n}" == store.commit_at(n).run for n in range(1, store.head().number + 1))
    assert rows_of(store.read()) == sorted(want.values())
    some = spark.createDataFrame([(0, "n1"), (1, "n2"), (9, "n1"), (None, "n1")], "source_id int, name string")
    assert rows_of(store.read(only=some)) == sorted(v for k, v in want.items() if k in {(0, "n1"), (1, "n2")})
    # a key that had the tag before and has not now is found by its older version, and left out by its newest
    tagged = spark.createDataFrame([("x",)], "tag string")
    assert rows_of(store.holding(tagged, ["tag"])) == sorted(v for v in want.values() if v[3] == "x")
    assert rows_of(store.holding(tagged, ["tag"], columns=["value"]).select("source_id", "name", "value")) == sorted(
        v[:3] for v in want.values() if v[3] == "x")


def test_a_write_touches_its_own_buckets_and_counts_once(spark, folder):  # noqa: F811
    store = table(spark, folder, runs=50)
    assert rows_of(store.read()) == []
    first = put(spark, store, "run-1", [(1, f"n{i}", i, None) for i in range(2000)])
    second = put(spark, store, "run-2", [(1, "n7", -1, None), (None, None, 5, None)])
    changed = {b for b in second.folders if second.folders[b] != first.folders.get(b)}
    assert len(changed) <= 2 and all(second.folders[b][:-1] == first.folders[b] for b in changed)
    added = sum(second.folders[b][-1][1] for b in changed)
    assert added < sum(n for runs in first.folders.values() for _, n in runs) / 2  # two rows against two thousand
    assert put(spark, store, "run-2", [(1, "n7", -9, None)]) == second  # the same run again changes nothing
    got = {r.name: r.value for r in store.read().collect()}
    assert got["n7"] == -1 and got["n8"] == 8 and got[None] == 5 and len(got) == 2001
    assert {r.name: r.value for r in store.read(first).collect()}["n7"] == 7  # as it stood
    assert put(spark, store, "run-3", []).folders == second.folders  # nothing to record is a commit too
    other = KeyedDeltas(spark, f"{folder}/t", ROW, ["source_id", "name"], buckets=16)
    put(spark, other, "run-4", [(1, "n9", -2, None)])  # a stored table keeps its number of buckets
    assert {b.split("/")[1] for b in other.head().folders} == {"4"} and {r.name: r.value for r in other.read().collect()}["n9"] == -2


def test_overtaken_and_stopped_writes(spark, folder, monkeypatch):  # noqa: F811
    store = table(spark, folder)
    put(spark, store, "run-1", [(1, "a", 1, None)])
    real, others = CommitLog._add, [("run-x", 10)]

    def overtaken(self, commit: Commit):
        if commit.run == "run-2" and others:
            name, n = others.pop()
            table(spark, folder).write(name, lambda head: store.read(head).withColumn("value", F.col("value") + n))
        real(self, commit)

    more = lambda head: store.read(head).withColumn("value", F.col("value") + 100)
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_add", overtaken)
        store.write("run-2", more)
    assert rows_of(store.read()) == [(1, "a", 111, None)]  # counted on what the other had written

    def stop(self, commit):
        if commit.run.startswith("compaction"):
            raise RuntimeError("stopped")
        real(self, commit)

    with monkeypatch.context() as m:
        m.setattr(CommitLog, "_add", stop)
        try:
            for i in range(3, 9):
                store.write(f"run-{i}", more)
        except RuntimeError:
            pass
    at = rows_of(store.read())[0][2]
    store.write("run-9", more)
    assert rows_of(store.read()) == [(1, "a", at + 100, None)]
    assert any(store.commit_at(n).run.startswith("compaction") for n in range(1, store.head().number + 1))


def in_order(rows, n):
    """Plain reading: (document, previous hash) of tables whose hash is not among the last n entered of their source."""
    seen, out = {}, []
    for source, batch, doc, h, enters in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        last = seen.setdefault(source, [])
        if batch and last and h is not None and h not in last[-n:]:
            out.append((doc, last[-1], h))
        if enters and h is not None:
            last.append(h)
    return sorted(out)


@pytest.mark.parametrize("n", [1, 2, 5])
def test_header_drift_in_order(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([1, 1, 1, 2, 3]), int(i > 25), f"d{i:03}", rng.choice(["a", "b", "c", "d", None][:3 + (i > 90) * 2]),
             i <= 25 or rng.random() < 0.7) for i in range(120)]
    rows.append((9, 1, "x", "a", True))  # a source without history
    df = spark.createDataFrame([(s, b, d, h, e, [h or ""]) for s, b, d, h, e in rows],
                               "source_id int, batch int, document_id string, header_hash string, enters boolean, column_names array<string>")
    df = df.repartition(5, "document_id")
    got = D.header_drift_in_order(df.filter("batch = 1"), df.filter("batch = 0"), F.lit(AS_OF), ["document_id"], F.col("enters"), n)
    assert sorted((r.document_id, r.previous_signature, r.current_signature) for r in got.collect()) == in_order(rows, n)
    assert D.header_drift_in_order(df.limit(0), df.limit(0), F.lit(AS_OF), ["document_id"]).count() == 0


def test_last_entered_across_buckets(spark):
    rng = random.Random(1)
    rows = [(None if rng.random() < 0.2 else rng.randrange(2), t, rng.random() < 0.5) for t in range(80)]
    df = spark.createDataFrame(rows, "k int, t int, e boolean")
    got = {r.t: r.last for r in K.last_entered(df, ["k"], ["t"], F.col("e"), F.col("t"), 3, F.floor(F.col("t") / 9)).collect()}
    for k, t, _ in rows:
        before = [u for j, u, e in rows if j == k and u < t and e][-3:]
        assert got[t] == (before or None)


@pytest.mark.parametrize("stop_at", ["headers", "publish"])
def test_stream_to_published_equals_one_run(spark, folder, monkeypatch, stop_at):  # noqa: F811
    d = docs(spark, 6)
    for part in (d.filter("doc_id < 'doc2'"), d.filter("doc_id > 'doc0'")):  # doc1 arrives twice
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    start = lambda: X.start_publishing(stream, cells(spark, 6), f"{folder}/s", f"{folder}/ck", AS_OF, fuzzy=False)
    calls = []

    def stopping(real, before):
        def call(*args, **kw):
            calls.append(1)
            if before and len(calls) == 2:
                raise RuntimeError("stopped")
            out = real(*args, **kw)
            if not before and len(calls) == 2:
                raise RuntimeError("stopped")
            return out
        return call

    # in the second batch: before its tables are staged, after it has published and before it is recorded
    where, name, before = {"headers": (ingest.D, "header_drift_in_order", True), "publish": (ingest.PublishedStore, "publish", False)}[stop_at]
    with monkeypatch.context() as m:
        m.setattr(where, name, stopping(getattr(where, name), before))
        with pytest.raises(StreamingQueryException):
            start().awaitTermination()
    start().awaitTermination()
    ingest.run(spark, f"{folder}/b", 1, d, cells(spark, 6), AS_OF, fuzzy=False)
    for read, fields in ((ingest.refresh_published, ["isin", "instrument_name", "version", "quantity", "document_id"]),
                         (ingest.read_ledger, ["doc_id", "url_fingerprint", "status", "file_hash_sha256"]),
                         (ingest.read_staging, ["idempotency_key", "document_id", "header_hash"])):
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(read(spark, f"{folder}/s").select(*fields).collect(), key=key) == sorted(
            read(spark, f"{folder}/b").select(*fields).collect(), key=key)
    drift = lambda s: sorted(r.document_id for r in spark.read.parquet(f"{folder}/{s}/run=*/drift").collect())
    assert drift("s") == drift("b")
