"""Drift checks: page structure, table headers, column counts, validation failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.operators.keys import in_ranges, last_entered, latest_per_key, previous_value

EVENT = ["source_id", "document_id", "detection_type", "severity", "previous_signature", "current_signature",
         "similarity_score", "description", "detected_at"]


def _event(df: DataFrame, kind: str, severity: Column, previous: Column, current: Column, similarity: Column,
           description: Column, detected_at: Column, document_id: Column | None = None) -> DataFrame:
    return df.select(
        F.col("source_id"),
        (F.lit(None) if document_id is None else document_id).cast("string").alias("document_id"),
        F.lit(kind).alias("detection_type"),
        severity.alias("severity"),
        previous.alias("previous_signature"),
        current.alias("current_signature"),
        similarity.cast("double").alias("similarity_score"),
        description.alias("description"),
        detected_at.alias("detected_at"),
    )


def page_drift(sources: DataFrame, observed: DataFrame, detected_at: Column,
               severity: Mapping[str, str] = R.DRIFT_SEVERITY) -> tuple[DataFrame, DataFrame]:
    """(events, sources with moved baselines) for one crawl.

    ``observed``: one row per source with ``page_structure_hash``.  No baseline yet
    sets it silently; a different hash gives an event and moves the baseline.
    """
    cur = observed.select("source_id", F.col("page_structure_hash").alias("_now"))
    j = sources.join(cur, "source_id", "left")
    old, now = F.col("page_structure_hash"), F.col("_now")
    had = old.isNotNull() & (old != "")
    events = _event(
        j.filter(had & now.isNotNull() & (old != now)), "page_structure", F.lit(severity["page_structure"]),
        old, now, F.lit(0.0),
        F.concat(F.lit("Page structure changed from "), F.substring(old, 1, 12), F.lit(" to "), F.substring(now, 1, 12)),
        detected_at,
    )
    return events, j.withColumn("page_structure_hash", F.coalesce(now, old)).drop("_now")


def page_drift_history(observed: DataFrame, bucket: Column, severity: str = R.DRIFT_SEVERITY["page_structure"]) -> DataFrame:
    """Every change of page structure in a log of crawls (source_id, crawled_at, page_structure_hash)."""
    prev = previous_value(observed, ["source_id"], ["crawled_at", "page_structure_hash"], "page_structure_hash", bucket)
    old, now = F.col("previous"), F.col("page_structure_hash")
    return _event(
        prev.filter(old.isNotNull() & (old != now)), "page_structure", F.lit(severity), old, now, F.lit(0.0),
        F.concat(F.lit("Page structure changed from "), F.substring(old, 1, 12), F.lit(" to "), F.substring(now, 1, 12)),
        F.col("crawled_at"),
    )


def _newest(staged: DataFrame, n: int, scope: str) -> DataFrame:
    hist = staged.filter(F.col("header_hash").isNotNull()).select(
        "source_id", "header_hash", "column_names", "created_at", "document_id"
    )
    newest = [F.desc("created_at"), F.desc("document_id")]
    if scope == "source":
        top = latest_per_key(hist, ["source_id"], newest, n)
        keys = ["source_id"]
    else:
        top = hist.orderBy(*newest).limit(n)
        keys = []
    return top.groupBy(*keys).agg(
        F.collect_set("header_hash").alias("_known"),
        F.max_by(F.struct("header_hash", "column_names"), F.struct("created_at", "document_id")).alias("_prev"),
    )


def header_drift(current: DataFrame, staged: DataFrame, detected_at: Column, n: int = R.HEADER_BASELINES,
                 scope: str = "source", severity: str = R.DRIFT_SEVERITY["table_header"]) -> DataFrame:
    """Tables whose header hash is not among the newest ``n`` staged ones; no history, no event.

    ``scope="source"`` compares within the source, ``"global"`` with the newest of all sources.
    """
    base = _newest(staged, n, scope)
    if scope == "source":
        j = current.join(base, "source_id")
    else:
        one = current.withColumn("_g", base.select(F.struct("_known", "_prev").alias("g")).scalar())
        j = one.filter(F.size("_g._known") > 0).select("*", "_g.*")
    return _event(
        j.filter(~F.array_contains("_known", F.col("header_hash"))), "table_header", F.lit(severity),
        F.col("_prev.header_hash"), F.col("header_hash"), F.lit(None),
        F.concat(
            F.lit("Table columns changed from ["), F.array_join("_prev.column_names", ", "),
            F.lit("] to ["), F.array_join("column_names", ", "), F.lit("]"),
        ),
        detected_at, F.col("document_id"),
    )


def header_drift_in_order(current: DataFrame, staged: DataFrame, detected_at: Column, order: Sequence[str],
                          entering: Column | None = None, n: int = R.HEADER_BASELINES,
                          severity: str = R.DRIFT_SEVERITY["table_header"]) -> DataFrame:
    """Each table against the ``n`` staged just before it, those of the same batch included: a new layout is reported
    by the first table that has it, not by all of the batch.

    ``staged`` comes before ``current``; both are in ``order`` (total within a source) and hold it. Tables for which
    ``entering`` is not true (by default: those without a header hash) are checked, but are no history for later ones.
    Of ``staged`` only the newest ``n`` of each source matter.
    """
    entering = F.lit(True) if entering is None else entering
    names = list(dict.fromkeys(["source_id", "document_id", "header_hash", "column_names", *order]))
    hist = staged.filter(F.col("header_hash").isNotNull())
    hist = latest_per_key(hist, ["source_id"], [F.desc(c) for c in order], n).select(
        *names, F.lit(0).alias("_batch"), F.lit(True).alias("_in"))
    batch = current.select(*names, F.lit(1).alias("_batch"), (entering & F.col("header_hash").isNotNull()).alias("_in"))
    both = in_ranges(hist.unionByName(batch), ["source_id", "_batch", *order], "_range")
    seen = last_entered(both, ["source_id"], ["_batch", *order], F.col("_in"), F.struct("header_hash", "column_names"), n,
                        F.col("_range"))
    prev = F.element_at("last", -1)
    known = F.array_contains(F.col("last.header_hash"), F.col("header_hash"))
    return _event(
        seen.filter((F.col("_batch") == 1) & F.col("last").isNotNull() & ~known), "table_header", F.lit(severity),
        prev["header_hash"], F.col("header_hash"), F.lit(None),
        F.concat(
            F.lit("Table columns changed from ["), F.array_join(prev["column_names"], ", "),
            F.lit("] to ["), F.array_join("column_names", ", "), F.lit("]"),
        ),
        detected_at, F.col("document_id"),
    )


def column_count_drift(current: DataFrame, staged: DataFrame, detected_at: Column, scope: str = "source",
                       expected: str | None = None, tolerance: int = R.COLUMN_COUNT_WARNING) -> DataFrame:
    """Tables whose column count differs from the expected one (given, or the half-even rounded mean)."""
    actual = F.size("column_names")
    if expected is not None:
        j = current.withColumn("_exp", F.col(expected))
    else:
        mean = F.bround(F.avg(F.when(F.size("column_names") > 0, F.size("column_names"))), 0).cast("int")
        hist = staged.filter(F.col("column_names").isNotNull())
        if scope == "source":
            j = current.join(hist.groupBy("source_id").agg(mean.alias("_exp")), "source_id")
        else:
            j = current.withColumn("_exp", hist.agg(mean.alias("_exp")).scalar())
    diff = F.abs(actual - F.col("_exp"))
    return _event(
        j.filter(F.col("_exp").isNotNull() & (diff > 0)), "column_count",
        F.when(diff <= tolerance, F.lit("WARNING")).otherwise(F.lit("CRITICAL")),
        F.col("_exp").cast("string"), actual.cast("string"),
        F.lit(1.0) - diff / F.greatest(F.col("_exp"), F.lit(1)),
        F.concat(F.lit("Column count changed from "), F.col("_exp").cast("string"), F.lit(" to "), actual.cast("string")),
        detected_at, F.col("document_id"),
    )


def validation_drift(rows: DataFrame, failed: Column, detected_at: Column,
                     threshold: float = R.FAILURE_THRESHOLD, critical: float = R.FAILURE_CRITICAL) -> DataFrame:
    """Sources whose share of failed rows is above ``threshold``."""
    per = rows.groupBy("source_id").agg(
        F.count(F.lit(1)).alias("_total"), F.sum(F.when(failed, 1).otherwise(0)).alias("_failed")
    ).withColumn("_rate", F.col("_failed") / F.col("_total"))
    rate = F.col("_rate")
    return _event(
        per.filter(rate > threshold), "schema_validation",
        F.when(rate > critical, F.lit("CRITICAL")).otherwise(F.lit("WARNING")),
        F.lit(threshold).cast("string"), F.round(rate, 4).cast("string"), F.lit(1.0) - rate,
        F.concat(F.col("_failed").cast("string"), F.lit("/"), F.col("_total").cast("string"), F.lit(" rows failed")),
        detected_at,
    )


def type_checks(rows: DataFrame) -> DataFrame:
    """Per source: share of 12-sign ISINs, of numeric quantities, and mean percentage total per table."""
    per_table = rows.groupBy("source_id", "doc_id", "table_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.length("isin") == 12, 1).otherwise(0)).alias("isin_ok"),
        F.sum(F.when(F.col("quantity").isNotNull(), 1).otherwise(0)).alias("qty_ok"),
        F.sum("pct_to_net_assets").alias("pct"),
    )
    return per_table.groupBy("source_id").agg(
        F.sum("n").alias("row_count"),
        (F.sum("isin_ok") / F.sum("n")).alias("isin_ok_rate"),
        (F.sum("qty_ok") / F.sum("n")).alias("quantity_numeric_rate"),
        F.avg(F.when(F.col("pct").between(*R.PCT_TOTAL_RANGE), 1.0).otherwise(0.0)).alias("pct_total_ok_rate"),
    )


def union_events(*events: DataFrame) -> DataFrame:
    out = events[0]
    for e in events[1:]:
        out = out.unionByName(e)
    return out.withColumns({"alert_sent": F.lit(False), "resolved": F.lit(False)})


def unresolved(events: DataFrame, source_id=None) -> DataFrame:
    open_ = events.filter(~F.col("resolved"))
    if source_id is not None:
        open_ = open_.filter(F.col("source_id") == source_id)
    return open_.orderBy(F.desc("detected_at"))


def halt_critical(docs: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that go on, documents held because their source has an open CRITICAL event)."""
    bad = events.filter((F.col("severity") == "CRITICAL") & ~F.col("resolved")).select("source_id").distinct()
    held = docs.join(bad, "source_id", "left_semi").withColumns(
        {"status": F.lit("QUARANTINED"), "quarantine_reason": F.lit("DRIFT_DETECTED")}
    )
    return docs.join(bad, "source_id", "left_anti"), held


def baselines(staged: DataFrame, events: DataFrame) -> DataFrame:
    """Signature each source is measured against: the first staged table after its last resolved drift."""
    since = events.filter(F.col("resolved")).groupBy("source_id").agg(F.max("resolved_at").alias("_since"))
    later = staged.join(since, "source_id", "left").filter(
        F.col("_since").isNull() | (F.col("created_at") > F.col("_since"))
    )
    return later.groupBy("source_id").agg(
        F.min_by(
            F.struct("header_hash", F.size("column_names").alias("column_count"), "created_at"),
            F.struct("created_at", "document_id"),
        ).alias("_b")
    ).select("source_id", "_b.*")
