"""Streaming queries over the given tables read as file streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdsift.operators.classify import classify
from holdsift.plans import inputs as I
from holdsift.plans import sqltext as S
from holdsift.plans.queries_signals import AS_OF, docs
from holdsift.plans.registry import query
from holdsift.rules import DOCUMENT_MIME_TYPES
from holdsift.session import shared_work
from holdsift.streaming import increments as X

RESPONSES = """
SELECT ts, CAST(user_id % 7 AS INT) AS source_id, concat('https://cdn.example.org/', event_type, '/doc_', CAST(event_id % 300 AS STRING), '.pdf') AS url,
 CASE event_id % 4 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/html' WHEN 2 THEN 'text/csv' ELSE '' END AS content_type FROM {events}
"""


def _stream(spark, sf, name):
    schema = I.table(spark, sf, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf)


@query("stream_responses", f"""
SELECT DISTINCT source_id, url FROM ({I.duck(RESPONSES)}) r WHERE {S.any_contains('content_type', DOCUMENT_MIME_TYPES)}
 OR regexp_matches(url, '(?i)/purchase/.*_1')""")
def stream_responses(spark, sf):
    work = shared_work(spark)
    stream = spark.sql(RESPONSES, events=_stream(spark, sf, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    first = X.first_responses(stream, "ts", "60 days", ["/purchase/*_1"])
    q = first.select("source_id", "url").writeStream.format("parquet").option("path", f"{work}/out").option(
        "checkpointLocation", f"{work}/checkpoint"
    ).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema("source_id int, url string").parquet(f"{work}/out")


@query("stream_ingest")
def stream_ingest(spark, sf):
    work = shared_work(spark)
    stream = docs(spark, sf, _stream(spark, sf, "orders"))
    run = lambda d: classify(d, AS_OF, keep=("doc_id", "source_id", "url", "url_fingerprint"))
    X.start_ingest(stream, run, f"{work}/log", f"{work}/checkpoint").awaitTermination()
    return X.read_log(spark, f"{work}/log").select("source_id", "doc_id", "url_fingerprint", "status", "decision")
