"""The whole run: documents and grids in, published holdings out.

Each stage writes one table below ``<store>/run=<id>`` and the next stage reads it
back: a lost executor costs tasks, not stages, and nothing is computed twice.  State
lives in ``ledger`` (deltas in buckets: a run writes the documents it recorded, and reads those its
documents can meet), ``staging`` (one partition per run) and ``published`` (snapshots of periods),
ledger and published rows under commit logs.  A run that stopped and is started again
does not take its own staging partition for history and publishes nothing twice; one that had
finished (its ledger commit is there) is not repeated, its counters are read back.

``resume`` is the run over reviewed documents: those a reviewer released go through extraction,
staging and publishing like any other, those rejected are closed, and decisions that a document's
state does not allow become error rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift.functions import urls as U
from holdsift.functions.hashing import content_hash, idempotency_key
from holdsift.operators import drift as D
from holdsift.operators import grid as G
from holdsift.operators import lifecycle as L
from holdsift.operators import novelty as N
from holdsift.operators import reports as P
from holdsift.operators import review as V
from holdsift.operators import warehouse as W
from holdsift.operators.classify import classify
from holdsift.operators.keys import keep_first
from holdsift.sources.commits import PublishedStore
from holdsift.sources.deltas import KeyedDeltas
from holdsift.sources.tables import exists

LEDGER_SCHEMA = (
    "source_id int, url_fingerprint string, doc_id string, url string, filename string, file_type string, "
    "file_size_bytes bigint, file_hash_sha256 string, content_hash string, status string, "
    "download_attempts int, discovered_at timestamp, updated_at timestamp"
)
STAGING_SCHEMA = (
    "idempotency_key string, document_id string, source_id int, table_id int, row_count bigint, "
    "column_names array<string>, header_hash string, content_hash string, created_at timestamp"
)


def ledger_of(spark: SparkSession, store: str) -> KeyedDeltas:
    return KeyedDeltas(spark, f"{store}/ledger", LEDGER_SCHEMA, ["source_id", "url_fingerprint"])


def read_ledger(spark: SparkSession, store: str) -> DataFrame:
    """The ledger as it stands."""
    return ledger_of(spark, store).read()


def read_staging(spark: SparkSession, store: str, before: int | None = None, with_run: bool = False) -> DataFrame:
    """Staged tables of all runs, other than ``before`` if that is given; with the run they were ``staged_by`` if asked."""
    path, schema = f"{store}/staging", STAGING_SCHEMA + ", staged_by int"
    rows = spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)
    rows = rows if before is None else rows.filter(F.col("staged_by") != before)
    return rows if with_run else rows.drop("staged_by")


def _stages(spark: SparkSession, store: str, run_no: int):
    """A run's folder, and the function that writes one of its tables and reads it back."""
    base = f"{store}/run={run_no}"

    def stage(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        return spark.read.schema(df.schema).parquet(f"{base}/{name}")

    return base, stage


def _reached_columns() -> list:
    """How far a document came: whether its type has a reader, a grid was read from it, tables staged and published."""
    supported = F.col("file_type").isin("pdf", "xlsx", "xls")
    return [supported.alias("type_supported"), supported.alias("extracted"), "staged_tables", "published_tables"]


def _extract_to_publish(spark: SparkSession, store: str, run_no: int, go: DataFrame, grids: DataFrame, as_of: str) -> DataFrame:
    """Extraction, drift, staging, validation and publishing of classified documents; (doc_id, staged_tables,
    published_tables) of those that had a table."""
    _, stage = _stages(spark, store, run_no)
    now = F.lit(as_of).cast("timestamp")
    pdf, sheets, _ = G.split_by_type(go)

    # extraction
    parts, heads = [], []
    for dialect, part in (("pdf", pdf), ("excel", sheets)):
        cells = grids.join(part.select("doc_id"), "doc_id", "left_semi")
        head = stage(f"headers_{dialect}", G.header_rows(cells, dialect))
        parts.append(G.holding_rows(cells, dialect, head))
        heads.append(head)
    rows = stage("holdings", parts[0].unionByName(parts[1]))
    tables = G.table_results(rows, heads[0].unionByName(heads[1]))
    fields = [c for c in rows.columns if c not in ("doc_id", "table_id", "row_idx")]
    hashes = N.data_hashes(rows, G.TABLE, "row_idx", fields).select(*G.TABLE, "data_hash")
    meta = go.select("doc_id", "source_id", "source_key", "amc_name", "scheme_name", "scheme_category",
                     "period_month", "period_year")
    staged_now = stage("tables", tables.join(hashes, G.TABLE).join(meta, "doc_id").select(
        idempotency_key(F.col("source_key"), F.col("period_year"), F.col("period_month"), F.col("scheme_name"),
                        F.col("data_hash")).alias(W.KEY),
        F.col("doc_id").alias("document_id"), "source_id", "table_id", "row_count", "column_names", "header_hash",
        F.col("data_hash").alias("content_hash"), now.alias("created_at"),
    ))

    # staging; drift, each table against those staged just before it
    history = read_staging(spark, store, run_no, with_run=True)
    new = stage("staged", W.stage_new(history, staged_now, ["document_id", "table_id"]).select(*staged_now.columns))
    entered = new.select("document_id", "table_id", F.lit(True).alias("is_staged"))
    batch = staged_now.join(entered, ["document_id", "table_id"], "left").withColumn("staged_by", F.lit(run_no))
    stage("drift", D.union_events(D.header_drift_in_order(
        batch, history, now, ["staged_by", "document_id", "table_id"], F.coalesce("is_staged", F.lit(False)))))
    new.write.mode("overwrite").parquet(f"{store}/staging/staged_by={run_no}")

    # validation and publishing
    valid = W.validate_rows(G.number_kept_rows(rows))
    summary = stage("validation", W.validation_summary(valid))
    ready = W.publishable(valid, summary).join(meta, "doc_id").withColumnRenamed("doc_id", "document_id")
    PublishedStore(spark, f"{store}/published").publish(
        f"run-{run_no}", W.publish_rows(ready), ["document_id", "table_id", "row_idx"], as_of)
    return (
        staged_now.groupBy(F.col("document_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("staged_tables"))
        .join(summary.filter("business_rules_passed").groupBy("doc_id").agg(F.count(F.lit(1)).alias("published_tables")), "doc_id", "left")
    )


def run(spark: SparkSession, store: str, run_no: int, docs: DataFrame, grids: DataFrame, as_of: str,
        force_refresh: bool = False, fuzzy: bool = True) -> DataFrame:
    """One run; returns its counters (one row).

    ``docs``: doc_id, source_id, source_key, source_amc, url, filename, file_type, file_hash_sha256,
    file_size_bytes, page_context, header_text, sheet_names, discovered_at.
    ``grids``: the cell grids of those documents.
    """
    base, stage = _stages(spark, store, run_no)
    ledger = ledger_of(spark, store)
    if ledger.commit_of(f"run-{run_no}"):
        return _counters(spark.read.parquet(f"{base}/outcomes"))
    known = ledger.head()

    # discovery, level 0 gate, level 1 gate
    found = stage("found", keep_first(
        docs.withColumns({
            "url_fingerprint": U.url_fingerprint(F.col("url")), "status": F.lit("DOWNLOADED"),
            "content_hash": content_hash(F.col("header_text")),
        }), ["source_id", "url_fingerprint"], ["doc_id"],
    ))
    todo = N.not_settled(found, ledger.read(known, found, ["status"]), force_refresh=force_refresh)
    if force_refresh:
        todo = todo.withColumn("file_seen", F.lit(False))
    else:
        todo = N.duplicates_in_batch(todo, "file_hash_sha256", ["doc_id"]).drop("first_doc_id", "copies")
        held = ledger.holding(found, ["source_id", "file_hash_sha256"], known, ["doc_id"])
        todo = N.hash_seen(todo, held, "file_hash_sha256", out="_seen")
        todo = todo.withColumn("file_seen", F.col("_seen") | F.col("is_duplicate")).drop("_seen", "is_duplicate")
    todo = stage("todo", todo)

    # classification of what was downloaded, and review gate
    classified = stage("classified", classify(
        todo.filter(~F.col("file_seen") & F.col("file_hash_sha256").isNotNull()), as_of, fuzzy=fuzzy, keep=("doc_id", "source_id", "source_key", "file_type"),
    ))
    go = classified.filter(~F.col("is_quarantined"))
    reached = _extract_to_publish(spark, store, run_no, go, grids, as_of)

    # outcomes, ledger, counters
    outcomes = stage("outcomes", W.final_status(
        found.join(todo.select("doc_id", "file_seen"), "doc_id", "left")
        .join(classified.select("doc_id", "is_quarantined"), "doc_id", "left")
        .join(reached, "doc_id", "left")
        .select(
            found["*"], "file_seen", F.col("file_seen").isNotNull().alias("is_novel"),
            F.col("file_hash_sha256").isNotNull().alias("downloaded"), "is_quarantined", *_reached_columns(),
            F.lit(f"run-{run_no}").alias("pipeline_run_id"),
        ).drop("status")
    ))
    _record(ledger, run_no, outcomes.filter("is_novel"), as_of)
    return _counters(outcomes)


def _record(ledger: KeyedDeltas, run_no: int, batch: DataFrame, as_of: str) -> None:
    """Write a run's documents into the ledger: of the ledger, their rows are read and written and no others."""
    ledger.write(f"run-{run_no}", lambda head: N.ledger_upsert(ledger.read(head, batch), batch, as_of, ["doc_id"]))


def read_classified(spark: SparkSession, store: str, before: int) -> DataFrame:
    """The newest classification of every document, over all runs before one."""
    rows = spark.read.option("basePath", store).parquet(f"{store}/run=*/classified").filter(F.col("run") < before)
    return L.newest_events(rows, "doc_id", ["run"]).drop("run")


def resume(spark: SparkSession, store: str, run_no: int, reviews: DataFrame, grids: DataFrame, as_of: str) -> DataFrame:
    """One run over reviewed documents; returns their outcomes.

    ``reviews``: review_id, doc_id, decision, reviewer, notes, reviewed_at, corrected_amc_name, corrected_scheme_name,
    corrected_period_month, corrected_period_year. The newest review of a document decides. Accepted and reclassified
    documents are published under the corrected names, rejected ones closed; what the state of a document does not allow
    (it is published, rejected before, unknown) changes nothing and stands in ``review_errors``. Every change of a
    classification stands in ``review_audit``. A resume that stopped is started again like a run.
    """
    base, stage = _stages(spark, store, run_no)
    ledger = ledger_of(spark, store)
    if ledger.commit_of(f"run-{run_no}"):
        return spark.read.parquet(f"{base}/outcomes")
    reviews = stage("reviews", reviews)
    events = L.newest_events(reviews.select("doc_id", F.col("decision").alias("event"), "reviewed_at", "review_id"),
                             "doc_id", ["reviewed_at", "review_id"])
    moved, errors = L.move(ledger.holding(events, ["doc_id"]), events)
    moved = stage("moved", moved)
    stage("review_errors", errors)

    # decisions and corrections go into the classification of the documents they moved
    empty = {c: F.lit(None).cast(t) for c, t in (
        ("review_decision", "string"), ("reviewed_by", "string"), ("review_notes", "string"), ("reviewed_at", "timestamp"))}
    before = read_classified(spark, store, run_no).withColumns(empty).join(moved.select("doc_id"), "doc_id", "left_semi")
    before = stage("reviewable", before)
    decided = reviews.join(before.select("doc_id", "classification_id"), "doc_id").drop("doc_id")
    after = stage("classified", V.apply_reviews(before, decided))
    fields = [*V.CORRECTABLE, "is_quarantined", "review_decision", "reviewed_by", "review_notes"]
    stage("review_audit", V.audit_rows(before, after, "doc_id", "classified_document", "REVIEW", as_of, F.col("reviewed_by"), fields))
    reached = _extract_to_publish(spark, store, run_no, V.resumed(after), grids, as_of)

    recorded = moved.drop("event", "status_before").withColumnRenamed("status", "moved_to")
    outcomes = stage("outcomes", W.final_status(
        recorded.join(reached, "doc_id", "left")
        .select("*", F.lit(True).alias("downloaded"), F.lit(False).alias("file_seen"), F.lit(False).alias("is_quarantined"),
                F.lit(f"run-{run_no}").alias("pipeline_run_id"),
                *[c for c in _reached_columns() if not isinstance(c, str)])
    ).withColumn("last_error", F.when(F.col("moved_to") != "REJECTED", F.col("last_error")))
     .withColumn("status", F.when(F.col("moved_to") == "REJECTED", F.lit("REJECTED")).otherwise(F.col("status"))))
    _record(ledger, run_no, outcomes, as_of)
    return outcomes


def _counters(outcomes: DataFrame) -> DataFrame:
    return P.run_counters(outcomes.withColumn("is_quarantined", F.coalesce("is_quarantined", F.lit(False))))


def refresh_published(spark: SparkSession, store: str) -> DataFrame:
    """Published table as it stands: the newest commit."""
    return PublishedStore(spark, f"{store}/published").read()
