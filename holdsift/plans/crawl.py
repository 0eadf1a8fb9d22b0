"""The run that starts at landing pages: pages and responses in, published holdings out.

Discovery finds the documents of every enabled source; those whose file has landed get its hash, header text and sheet
names, and go through ``ingest.run``; one that did not land is a failed download. Beside the tables of the run itself the
crawl keeps (``sources.stored``): the sources with the structure their pages had, the documents with their outcomes, their
classifications, validation, drift, one row per source and run, and the audit of states.

A file is known by its hash: grids are keyed by it, so a file that two documents share is parsed once. A crawl that was
stopped is started again with the same number; it writes the same folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift.operators import drift as D
from holdsift.operators import grid as G
from holdsift.operators import links as L
from holdsift.operators import reports as P
from holdsift.operators import warehouse as W
from holdsift.operators.keys import keep_first
from holdsift.plans import ingest
from holdsift.sources import stored

#: Moments and signature of a source that are not configuration.
_STATE = {"page_structure_hash": "string", "last_crawled_at": "timestamp", "last_success_at": "timestamp"}


def current_sources(spark: SparkSession, store: str, sources: DataFrame, run_no: int) -> DataFrame:
    """Sources as the last crawl left them, and registry rows that no crawl has seen yet."""
    fresh = sources.withColumns({c: F.lit(None).cast(t) for c, t in _STATE.items()})
    before = stored.rows_before(spark, store, "source_config", run_no, newest=True)
    if before is None:
        return fresh
    return before.drop("run").unionByName(fresh.join(before.select("source_key"), "source_key", "left_anti"))


def documents(found: DataFrame, sources: DataFrame, landed: DataFrame, grids: DataFrame, as_of: str) -> DataFrame:
    """Discovered documents as ``ingest.run`` takes them.

    ``landed``: url, file_hash_sha256, file_size_bytes; a url that landed twice counts with its least hash.
    """
    files = keep_first(landed.filter(F.col("file_hash_sha256").isNotNull()).select("url", "file_hash_sha256", "file_size_bytes"),
                       ["url"], ["file_hash_sha256"])
    read = G.header_text(grids.withColumnRenamed("file_hash_sha256", "doc_id")).withColumnRenamed("doc_id", "file_hash_sha256")
    told = sources.select("source_key", "source_id", F.col("amc_name").alias("source_amc"))
    return (
        found.join(told, "source_key").join(files, "url", "left").join(read, "file_hash_sha256", "left")
        .select("doc_id", "source_id", "source_key", "source_amc", "url", "filename", "file_type", "file_hash_sha256",
                "file_size_bytes", "page_context", "header_text", "sheet_names",
                F.lit(as_of).cast("timestamp").alias("discovered_at"))
    )


def _per_source(outcomes: DataFrame, crawled: DataFrame, run_no: int, as_of: str) -> DataFrame:
    """One row per enabled source with its counters; one that found nothing has zeroes."""
    counts = P.run_counters(outcomes.withColumn("is_quarantined", F.coalesce("is_quarantined", F.lit(False))), run="source_id")
    now = F.lit(as_of).cast("timestamp")
    numbers = [c for c in counts.columns if c != "source_id"]
    return crawled.select("source_id").join(counts, "source_id", "left").select(
        F.lit(f"run-{run_no}").alias("run_id"), "source_id", F.lit("COMPLETED").alias("status"),
        now.alias("started_at"), now.alias("completed_at"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers))


def run(spark: SparkSession, store: str, run_no: int, pages: DataFrame, responses: DataFrame, landed: DataFrame,
        grids: DataFrame, sources: DataFrame, as_of: str, force_refresh: bool = False) -> DataFrame:
    """One crawl; returns its rows of ``pipeline_run``, one per enabled source.

    ``pages``: source_key, url, html; ``responses``: source_key, seq, url, content_type; ``landed``: url,
    file_hash_sha256, file_size_bytes; ``grids``: file_hash_sha256 in place of doc_id, else as ``sources.grids`` has them;
    ``sources``: the registry's columns and source_id. Sources that are not enabled keep their state and nothing of them is
    read; a page, response or file of an unknown source counts for nothing; empty tables give rows of zeroes.
    """
    now = F.lit(as_of).cast("timestamp")
    known = current_sources(spark, store, sources, run_no)
    crawled = known.filter("enabled")
    pages = pages.join(crawled.select("source_key"), "source_key", "left_semi")
    responses = responses.join(crawled.select("source_key"), "source_key", "left_semi")
    base = f"{store}/run={run_no}"

    # discovery, and whether the pages still look as they did
    observed = L.page_structures(pages).join(crawled.select("source_key", "source_id"), "source_key").select(
        "source_id", "page_structure_hash")
    events, moved = D.page_drift(known, observed, now)
    found = L.discover(pages, responses, crawled, f"run-{run_no}")
    docs = documents(found, crawled, landed, grids, as_of)
    path = f"{base}/discovered"
    docs.write.mode("overwrite").parquet(path)
    docs = spark.read.schema(docs.schema).parquet(path)

    mine = grids.join(docs.select("doc_id", "file_hash_sha256"), "file_hash_sha256").drop("file_hash_sha256")
    ingest.run(spark, store, run_no, docs, mine, as_of, force_refresh=force_refresh)

    # what the crawl leaves behind
    outcomes = spark.read.parquet(f"{base}/outcomes")
    stored.write_table(outcomes.select(*_names("discovered_document")), store, "discovered_document", run_no)
    stored.write_table(spark.read.parquet(f"{base}/classified").select(*_names("classified_document")), store, "classified_document", run_no)
    stored.write_table(spark.read.parquet(f"{base}/validation"), store, "validated_data", run_no)
    drift = D.union_events(events).unionByName(spark.read.parquet(f"{base}/drift"))
    stored.write_table(drift.select(*_names("drift_detection")), store, "drift_detection", run_no)
    runs = stored.write_table(_per_source(outcomes, crawled, run_no, as_of), store, "pipeline_run", run_no)
    good = runs.filter("documents_published > 0").select("source_id", F.lit(True).alias("_good"))
    left = moved.join(good, "source_id", "left").withColumns({
        "last_crawled_at": F.when(F.col("enabled"), now).otherwise(F.col("last_crawled_at")),
        "last_success_at": F.when(F.col("_good"), now).otherwise(F.col("last_success_at"))})
    stored.write_table(left.select(*_names("source_config")), store, "source_config", run_no)
    stored.write_table(_audit(outcomes, run_no, as_of), store, "audit_log", run_no)
    return runs


def _audit(outcomes: DataFrame, run_no: int, as_of: str) -> DataFrame:
    """A row for every document that the run brought to a state."""
    return outcomes.filter("is_novel").select(
        F.lit("discovered_document").alias("entity_type"), F.col("doc_id").alias("entity_id"), F.lit("STATUS").alias("action"),
        F.to_json(F.struct("status", "last_error")).alias("after_state"), F.lit("system").alias("actor"),
        F.lit(f"run-{run_no}").alias("pipeline_run_id"), F.lit(as_of).cast("timestamp").alias("created_at"))


def _names(table: str) -> list[str]:
    return [c.split()[0] for c in stored.SCHEMAS[table].split(", ")]


def alerts(spark: SparkSession, store: str) -> DataFrame:
    """Alert flags of all runs of the store."""
    return P.run_alerts(stored.read_table(spark, store, "pipeline_run").drop("run"))


def state_problems(spark: SparkSession, store: str) -> DataFrame:
    """Documents of the ledger whose state disagrees with the staged and published tables."""
    ledger = ingest.read_ledger(spark, store)
    return W.status_audit(ledger, ingest.read_staging(spark, store), ingest.refresh_published(spark, store))
