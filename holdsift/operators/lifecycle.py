"""Document states as a table: which event leads from which state to which.

Moving documents is a join of their state and their event with that table. A pair the table lacks is illegal: the
document stays as it is and an error row says so.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.operators.keys import previous_value

#: (state, event, next state); review events are the reviewers' decisions.
TRANSITIONS = [
    ("DISCOVERED", "DOWNLOADED", "DOWNLOADED"), ("DISCOVERED", "DOWNLOAD_FAILED", "FAILED"),
    ("FAILED", "DOWNLOADED", "DOWNLOADED"), ("FAILED", "DOWNLOAD_FAILED", "FAILED"),
    ("DOWNLOADED", "SEEN", "PUBLISHED"), ("DOWNLOADED", "CLASSIFIED", "CLASSIFIED"), ("DOWNLOADED", "HELD", "QUARANTINED"),
    ("QUARANTINED", "ACCEPTED", "CLASSIFIED"), ("QUARANTINED", "RECLASSIFIED", "CLASSIFIED"), ("QUARANTINED", "REJECTED", "REJECTED"),
    ("CLASSIFIED", "EXTRACTED", "EXTRACTED"), ("CLASSIFIED", "EXTRACTION_FAILED", "FAILED"),
    ("EXTRACTED", "STAGED", "STAGED"), ("STAGED", "VALIDATED", "VALIDATED"), ("VALIDATED", "PUBLISHED", "PUBLISHED"),
    ("REJECTED", "RECLASSIFIED", "CLASSIFIED"),
]


def transition_table(spark: SparkSession, transitions: Sequence[tuple[str, str, str]] = tuple(TRANSITIONS)) -> DataFrame:
    unknown = {s for a, _, b in transitions for s in (a, b)} - set(R.DOCUMENT_STATUSES)
    if unknown:
        raise ValueError(f"unknown states: {sorted(unknown)}")
    return spark.createDataFrame(list(transitions), "status string, event string, next_status string")


def newest_events(events: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One event per document, its last by ``order``; an aggregate, so a document with very many costs a row per task."""
    rest = [c for c in events.columns if c != key]
    return events.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_e")).select(key, "_e.*")


def move(docs: DataFrame, events: DataFrame, key: str = "doc_id",
         transitions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(documents that moved, errors) of one event per document.

    Moved rows are those of ``docs`` with their new ``status``, the ``event`` and ``status_before``. Errors are
    (key, status, event, error): an event the state does not allow, or one of a document that is not known.
    """
    table = transitions if transitions is not None else transition_table(docs.sparkSession)
    asked = events.select(F.col(key).alias("_key"), "event").filter(F.col("_key").isNotNull())
    met = asked.join(docs, F.col("_key") == F.col(key), "left").join(table, ["status", "event"], "left")
    moved = met.filter(F.col("next_status").isNotNull()).select(
        *[F.col("next_status").alias("status") if c == "status" else F.col(c) for c in docs.columns],
        "event", F.col("status").alias("status_before"))
    error = F.when(F.col(key).isNull(), "UNKNOWN_DOCUMENT").otherwise(
        F.concat(F.lit("ILLEGAL_EVENT: "), "event", F.lit(" in state "), F.coalesce("status", F.lit("none"))))
    errors = met.filter(F.col("next_status").isNull()).select(F.col("_key").alias(key), "status", "event", error.alias("error"))
    return moved, errors


def illegal_moves(history: DataFrame, order: Sequence[str], bucket: Column, key: str = "doc_id",
                  transitions: DataFrame | None = None) -> DataFrame:
    """Rows of a state history (key, event, status reached) whose status does not follow from the one before.

    The first row of a document is its entry and always right. ``bucket`` grows with ``order``; see
    :func:`previous_value`, which never holds a whole document's history in one task.
    """
    table = transitions if transitions is not None else transition_table(history.sparkSession)
    rows = previous_value(history, [key], order, "status", bucket, out="status_before")
    table = table.select(F.col("status").alias("status_before"), "event", F.col("next_status").alias("status"))
    return rows.filter(F.col("status_before").isNotNull()).join(
        table, ["status_before", "event", "status"], "left_anti").select(*history.columns, "status_before")
