"""Operators and whole runs on small hand-made tables."""

import tempfile

import pytest
from pyspark.sql import functions as F

from holdsift.functions import signals as G
from holdsift.functions.fusion import fuse
from holdsift.operators import keys as K
from holdsift.operators import novelty as N
from holdsift.operators import warehouse as W
from holdsift.operators.classify import classify
from holdsift.plans import ingest
from holdsift.sources import files, grids, registry
from holdsift.sources.commits import PublishedStore
from holdsift.streaming import increments as X

AS_OF = "2026-07-01"
SIGNAL = ("struct<channel:string,amc_name:string,scheme_name:string,period_month:int,period_year:int,"
          "scheme_category:string,doc_type:string,confidence:double,signals_found:int,evidence:array<string>>")


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="holdsift-test-")


def sig(channel, amc=None, m=None, y=None, conf=0.0, scheme=None):
    return (channel, amc, scheme, m, y, None, None, conf, 0, [])


def fused(spark, dh, pc, fn, ur, src="SBI Mutual Fund"):
    df = spark.createDataFrame(
        [(src, dh, pc, fn, ur)],
        f"source_amc string, doc_header_signal {SIGNAL}, page_context_signal {SIGNAL}, filename_signal {SIGNAL}, url_signal {SIGNAL}",
    )
    return fuse(df, as_of=AS_OF).first()


def test_golden_filename(spark):
    df = spark.createDataFrame([("SBI_Bluechip_Fund_May_2026.pdf", "SBI Mutual Fund")], "filename string, source_amc string")
    plain = G.with_filename_signal(df).first()["filename_signal"]
    spaced = G.with_filename_signal(df, separators="space").first()["filename_signal"]
    assert plain["amc_name"] == "SBI Mutual Fund" and plain["period_year"] is None
    assert (spaced["period_month"], spaced["period_year"]) == (5, 2026)
    assert spaced["scheme_name"] == "SBI Blue Chip Fund" and spaced["scheme_category"] == "equity"


def test_fusion_rules(spark):
    a = "SBI Mutual Fund"
    good = fused(spark, sig("d", a, 6, 2026, 1.0), sig("p", a, 6, 2026, 1.0), sig("f", a.upper(), 6, 2026, 1.0), sig("u", None, None, None, 0.5))
    assert good["decision"] == "AUTO_ACCEPT" and good["agreement_bonus"] == pytest.approx(0.1) and good["confidence_score"] == 1.0
    assert good["period_label"] == "June 2026" and good["quarantine_reason"] is None
    bad = fused(spark, sig("d", "HDFC Mutual Fund", 6, 2026, 0.9), sig("p", a, 5, 2026, 0.9), sig("f"), sig("u"))
    assert bad["disagreement_penalty"] == pytest.approx(0.3) and bad["decision"] == "REJECT"
    assert bad["amc_name"] == "HDFC Mutual Fund" and bad["quarantine_reason"] == "LOW_CONFIDENCE"
    old = fused(spark, sig("d", a, 1, 2025, 1.0), sig("p", a, 1, 2025, 1.0), sig("f", a, 1, 2025, 1.0), sig("u", a, 1, 2025, 1.0))
    assert old["decision"] == "QUARANTINE" and old["quarantine_reason"] == "STALE_PERIOD"
    low = fused(spark, sig("d", a, 6, 2026, 1.0), sig("p", a, 6, 2026, 0.6), sig("f"), sig("u"))
    assert low["decision"] == "QUARANTINE" and low["quarantine_reason_compat"] == "STALE_PERIOD" and low["quarantine_reason"] == "UNKNOWN_SCHEME"
    none = fused(spark, sig("d"), sig("p"), sig("f"), sig("u"), src=None)
    assert none["decision"] == "QUARANTINE" and "NO_AMC" in none["reason_codes"]


def test_keyed_helpers_against_brute_force(spark):
    rows = [(k % 3 if k % 2 else 0, k, f"v{k * 7 % 5}", float(k % 4)) for k in range(60)]
    df = spark.createDataFrame(rows, "g int, t int, v string, x double")
    bucket = F.floor(F.col("t") / 7)
    prev = {(r["g"], r["t"]): r["previous"] for r in K.previous_value(df, ["g"], ["t"], "v", bucket).collect()}
    run = {(r["g"], r["t"]): (r["sum_before"], r["n_before"]) for r in K.running_before(df, ["g"], ["t"], F.col("x"), bucket).collect()}
    for g in (0, 1, 2):
        mine = sorted(r for r in rows if r[0] == g)
        for i, r in enumerate(mine):
            assert prev[(g, r[1])] == (mine[i - 1][2] if i else None)
            assert run[(g, r[1])] == (sum(m[3] for m in mine[:i]), i)
    assert {r["t"] for r in K.keep_first(df, ["g"], ["t"]).collect()} == {min(r[1] for r in rows if r[0] == g) for g in (0, 1, 2)}
    top = K.latest_per_key(df, ["g"], [F.desc("t")], 2)
    assert top.count() == 6 and "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


HOLD = ("document_id string, row_idx int, isin string, instrument_name string, instrument_type string, industry string, "
        "quantity string, market_value string, pct_to_net_assets string, rating string, amc_name string, scheme_name string, "
        "scheme_category string, period_month int, period_year int")


def holding(doc, i, isin, q, rating=None, month=5):
    return (doc, i, isin, "Name", None, None, q, "1,500,000", "5.5", rating, "SBI Mutual Fund", "S", "equity", month, 2026)


def test_golden_publish(spark):
    b = W.publish_rows(spark.createDataFrame([holding("d", 0, "INE1", "1000"), holding("d", 1, "INE2", "2,000.5")], HOLD))
    out = {r["isin"]: r for r in W.publish_upsert(W.empty_published(spark), b, ["document_id", "row_idx"], AS_OF).collect()}
    assert out["INE1"]["quantity"] == 1000.0 and out["INE1"]["market_value"] == 1500000.0
    assert out["INE1"]["pct_to_net_assets"] == 5.5 and out["INE2"]["version"] == 1


def test_repeated_key_acts_like_sequential_upserts(spark):
    rows = [holding("d1", 0, "INE1", "1", "AAA"), holding("d2", 0, "INE1", "x", None)]
    b = W.publish_rows(spark.createDataFrame(rows, HOLD))
    r = W.publish_upsert(W.empty_published(spark), b, ["document_id", "row_idx"], AS_OF).collect()
    assert len(r) == 1 and r[0]["version"] == 2 and r[0]["document_id"] == "d1"
    assert r[0]["quantity"] is None and r[0]["rating"] is None  # the last row wins, nulls included


def test_publishing_rewrites_only_touched_periods(spark, folder):
    store = PublishedStore(spark, f"{folder}/published")
    may = W.publish_rows(spark.createDataFrame([holding("d1", 0, "INE1", "1"), holding("d1", 1, "INE2", "2", month=6)], HOLD))
    first = store.publish("run-1", may, ["document_id", "row_idx"], AS_OF)
    june = W.publish_rows(spark.createDataFrame([holding("d2", 0, "INE2", "9", month=6)], HOLD))
    second = store.publish("run-2", june, ["document_id", "row_idx"], AS_OF)
    assert first.folders["2026-5"] == second.folders["2026-5"] and first.folders["2026-6"] != second.folders["2026-6"]
    got = {r["isin"]: (r["quantity"], r["version"], r["touched_by"]) for r in store.read().collect()}
    assert got == {"INE1": (1.0, 1, "run-1"), "INE2": (9.0, 2, "run-2")}
    assert {r["isin"]: r["version"] for r in store.read(first).collect()} == {"INE1": 1, "INE2": 1}  # as it stood


def test_url_novelty_on_empty_ledger(spark):
    docs = spark.createDataFrame([("https://sbimf.com/doc.pdf", 1, "fp")], "url string, source_id int, url_fingerprint string")
    ledger = spark.createDataFrame([], "source_id int, url_fingerprint string, status string")
    assert N.known_urls(docs, ledger).first()["url_is_novel"] is True


def test_stage_insert_twice_changes_nothing(spark):
    b = spark.createDataFrame([("k1", "d2", "h"), ("k1", "d1", "h"), ("k2", "d3", "h")], "idempotency_key string, document_id string, content_hash string")
    once = W.stage_insert(b.limit(0), b)
    assert sorted(once.collect()) == sorted(W.stage_insert(once, b).collect())
    assert {r["document_id"] for r in once.collect()} == {"d1", "d3"}


def test_csv_grid(spark, folder):
    with open(f"{folder}/a.csv", "w") as f:
        f.write('Title,,\nISIN,Name,"Qty, total"\nINE1,"A ""B""\nC",10\n')
    rows = [r["cells"] for r in grids.read_grid_csv(spark, folder).orderBy("row_idx").collect()]
    assert rows == [["Title", None, None], ["ISIN", "Name", "Qty, total"], ["INE1", 'A "B"\nC', "10"]]


def test_landed_files(spark, folder):
    import hashlib
    with open(f"{folder}/x.PDF", "wb") as f:
        f.write(b"bytes")
    r = files.with_content_path(files.landed_files(spark, folder)).first()
    h = hashlib.sha256(b"bytes").hexdigest()
    assert (r["file_hash_sha256"], r["file_size_bytes"], r["content_path"]) == (h, 5, f"{h[:2]}/{h}.pdf")


def test_source_sync_never_updates(spark):
    reg = registry.sources(spark)
    have = reg.filter("source_key = 'sbi_mf'").withColumn("amc_name", F.lit("kept"))
    out = {r["source_key"]: r["amc_name"] for r in registry.sync_sources(have, reg).collect()}
    assert len(out) == 3 and out["sbi_mf"] == "kept"


def docs(spark, n=4, start=0):
    rows = []
    for i in range(start, start + n):
        rows.append((
            f"doc{i}", 1, "sbi_mf", "SBI Mutual Fund", f"https://www.sbimf.com/portfolio/2026/june/f{i}.xlsx",
            f"SBI Liquid Fund June 2026 {i}.xlsx" if i != 3 else "x.zip", "xlsx" if i != 3 else "zip",
            f"hash{i if i != 2 else 1}", 10, "SBI Mutual Fund monthly portfolio as on 30 June 2026 SBI Liquid Fund",
        ))
    df = spark.createDataFrame(rows, "doc_id string, source_id int, source_key string, source_amc string, url string, filename string, file_type string, file_hash_sha256 string, file_size_bytes bigint, header_text string")
    kv = F.array().cast("array<struct<k:string,v:string>>")
    return df.withColumns({
        "page_context": F.struct(F.lit("Monthly Portfolio June 2026").alias("link_text"), F.lit("SBI Liquid Fund").alias("parent_text"), F.lit("").alias("grandparent_text"),
                                 F.lit("").alias("title"), F.lit("").alias("aria_label"), kv.alias("data_attrs"), kv.alias("active_dropdowns")),
        "sheet_names": F.array(F.lit("Sheet1")), "discovered_at": F.lit("2026-06-30").cast("timestamp"),
    })


def cells(spark, n=4):
    rows = []
    for i in range(n):
        rows += [(f"doc{i}", 0, "s", 0, 0, ["Title", None, None]), (f"doc{i}", 0, "s", 0, 1, ["ISIN", "Security", "% to NAV"]),
                 (f"doc{i}", 0, "s", 0, 2, [f"ine00{i}", "A", "60"]), (f"doc{i}", 0, "s", 0, 3, ["", "B", "40"])]
    return spark.createDataFrame(rows, grids.GRID_SCHEMA)


def test_whole_run_and_rerun(spark, folder):
    c = ingest.run(spark, folder, 1, docs(spark), cells(spark), AS_OF).first().asDict()
    assert c["documents_discovered"] == 4 and c["documents_novel"] == 4
    ledger = {r["doc_id"]: r["status"] for r in ingest.read_ledger(spark, folder).collect()}
    assert ledger["doc0"] == ledger["doc1"] == "PUBLISHED" and ledger["doc2"] == "PUBLISHED"  # doc2 repeats doc1's bytes
    assert ledger["doc3"] in ("FAILED", "QUARANTINED")
    pub = ingest.refresh_published(spark, folder)
    got = {(r["isin"], r["instrument_name"]): r["version"] for r in pub.collect()}
    assert got == {("INE000", "A"): 1, ("INE001", "A"): 1, (None, "B"): 2}
    again = ingest.run(spark, folder, 2, docs(spark), cells(spark), AS_OF).first().asDict()
    assert again["documents_published"] == 0
    assert {(r["isin"], r["instrument_name"]): r["version"] for r in ingest.refresh_published(spark, folder).collect()} == got


def test_stream_equals_batch(spark, folder):
    d = docs(spark, 6).select("doc_id", "source_id", "source_amc", "url", "filename", "file_type", "header_text", "page_context", "sheet_names")
    d = d.withColumn("doc_id", F.regexp_extract("doc_id", r"(\d+)", 1).cast("bigint"))
    for part in (d.filter("doc_id < 3"), d.filter("doc_id >= 2")):  # doc 2 arrives twice
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    run = lambda x: classify(x, AS_OF, fuzzy=False, keep=("doc_id", "source_id", "url", "url_fingerprint"))
    stream = spark.readStream.schema(d.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    X.start_ingest(stream, run, f"{folder}/log", f"{folder}/ck").awaitTermination()
    got = sorted((r["doc_id"], r["decision"]) for r in X.read_log(spark, f"{folder}/log").collect())
    want = sorted((r["doc_id"], r["decision"]) for r in classify(d, AS_OF, fuzzy=False).collect())
    assert got == want
    assert spark.read.parquet(f"{folder}/log").groupBy("batch").count().count() == 2
