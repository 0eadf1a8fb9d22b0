"""Streaming entries: response events, incremental classification, and ingest up to published holdings."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from holdsift.functions import urls as U
from holdsift.operators.keys import keep_first, keep_last
from holdsift.operators.links import select_responses
from holdsift.operators.novelty import not_settled
from holdsift.plans import ingest
from holdsift.sources.tables import exists


def first_responses(stream: DataFrame, event_time: str, delay: str, patterns: Sequence[str] = (),
                    group: Sequence[str] = ("source_id",)) -> DataFrame:
    """Document responses, one per (group, url) within the watermark; state older than ``delay`` is dropped."""
    kept = select_responses(stream, patterns)
    return kept.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([*group, "url"])


LOG_SCHEMA = "source_id int, url_fingerprint string, doc_id bigint, url string, status string, decision string"


def read_log(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Ledger state folded from the append-only log: the newest entry per (source, fingerprint)."""
    if not exists(spark, path):
        return spark.createDataFrame([], LOG_SCHEMA + ", batch bigint")
    log = spark.read.schema(LOG_SCHEMA + ", batch bigint").parquet(path)
    if before is not None:
        log = log.filter(F.col("batch") < before)
    return keep_last(log, ["source_id", "url_fingerprint"], ["batch", "doc_id"])


def ingest_batch(classify: Callable[[DataFrame], DataFrame], log_path: str):
    """Function for ``foreachBatch``: gate against the ledger, classify what is new, log the outcome.

    A batch writes its own partition of the log in overwrite mode and reads only
    earlier ones, so a batch that is run again after a failure gives the same log.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        docs = batch.withColumn("url_fingerprint", U.url_fingerprint(F.col("url")))
        docs = keep_first(docs, ["source_id", "url_fingerprint"], ["doc_id"])
        todo = not_settled(docs, read_log(spark, log_path, batch_id))
        done = classify(todo).select(
            "source_id", "url_fingerprint", "doc_id", "url",
            F.when(F.col("is_quarantined"), F.lit("QUARANTINED")).otherwise(F.lit("CLASSIFIED")).alias("status"),
            "decision",
        )
        done.write.mode("overwrite").parquet(f"{log_path}/batch={batch_id}")

    return run


def start_ingest(stream: DataFrame, classify: Callable[[DataFrame], DataFrame], log_path: str,
                 checkpoint: str) -> StreamingQuery:
    """Process everything there is, in file batches, then stop."""
    return (
        stream.writeStream.foreachBatch(ingest_batch(classify, log_path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def publish_batch(store: str, grids: DataFrame, as_of: str, first_run: int = 1, fuzzy: bool = True):
    """Function for ``foreachBatch``: a micro-batch is a run of its own, up to published holdings.

    The run takes its number from the batch, so a batch that comes again after a failure is the same run: it finds what
    it had published and recorded, and does the rest. State is the ledger of the store, of which a batch reads and
    writes the rows of its own documents. ``first_run`` must be above the runs made on the store before the stream, and stay
    the same as long as the stream's checkpoint does; reviews are resumed under numbers the stream does not reach.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        ingest.run(batch.sparkSession, store, first_run + batch_id, batch, grids, as_of, fuzzy=fuzzy)

    return run


def start_publishing(stream: DataFrame, grids: DataFrame, store: str, checkpoint: str, as_of: str, first_run: int = 1,
                     fuzzy: bool = True) -> StreamingQuery:
    """Ingest everything there is from documents to published holdings, in batches, then stop.

    ``stream`` has the columns of ``ingest.run``'s documents, ``grids`` their cells: a static table that is read in each
    batch for the documents of the batch alone.
    """
    return (
        stream.writeStream.foreachBatch(publish_batch(store, grids, as_of, first_run, fuzzy))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
