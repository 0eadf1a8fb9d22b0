"""Reports and run monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.operators.keys import running_before
from holdsift.operators.review import pending


def human_bytes(size: Column) -> Column:
    """1024-based size with up to two decimals; null as a dash."""
    units = F.array(*[F.lit(u) for u in R.SIZE_UNITS])
    power = F.when(size < 1024, 0).when(size < 1024**2, 1).when(size < 1024**3, 2).otherwise(3)
    number = F.format_string("%.2f", size / F.pow(F.lit(1024.0), power))
    return F.when(size.isNull(), F.lit("—")).otherwise(
        F.concat(F.regexp_replace(number, r"\.?0+$", ""), F.lit(" "), F.get(units, power))
    )


def page(df: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    """One page of an ordered frame."""
    return df.offset(offset).limit(limit) if offset else df.limit(limit)


def page_with_more(df: DataFrame, limit: int, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """(the page, one-row frame ``has_more``): a single extra row is fetched to know."""
    probe = page(df, limit + 1, offset)
    return probe.limit(limit), probe.agg((F.count(F.lit(1)) > limit).alias("has_more"))


def stats(sources: DataFrame, documents: DataFrame, classified: DataFrame, published: DataFrame,
          runs: DataFrame, drifts: DataFrame, since: Column) -> DataFrame:
    """One row of headline counts; runs since ``since`` and open drift alerts included."""
    one = sources.sparkSession.range(1)

    def count(df, cond=None):
        n = F.count(F.lit(1)) if cond is None else F.count(F.when(cond, 1))
        return df.agg(n.alias("n")).scalar()

    return one.select(
        count(sources).alias("total_sources"),
        count(sources, F.col("enabled")).alias("enabled_sources"),
        count(documents).alias("total_documents"),
        count(classified, F.col("is_quarantined")).alias("total_quarantined"),
        count(published).alias("total_published"),
        count(runs, F.col("started_at") >= since).alias("recent_runs"),
        count(drifts, ~F.col("resolved")).alias("active_drift_alerts"),
    )


def sources_running(sources: DataFrame, runs: DataFrame) -> DataFrame:
    active = runs.filter(F.col("status") == "RUNNING").select("source_id").distinct().withColumn("_r", F.lit(True))
    return sources.join(active, "source_id", "left").withColumn(
        "is_running", F.col("_r").isNotNull()
    ).drop("_r")


def quarantine_queue(classified: DataFrame, documents: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Documents pending review, lowest confidence first (id breaks ties)."""
    q = pending(classified).join(documents.select(F.col("doc_id"), "url", "filename"), "doc_id")
    return page(q.orderBy("confidence_score", "classification_id"), limit, offset)


def documents_list(documents: DataFrame, sources: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Newest documents with their fund house."""
    j = documents.join(sources.select("source_id", "amc_name"), "source_id")
    return page(j.orderBy(F.desc("discovered_at"), "doc_id"), limit, offset)


def published_top(published: DataFrame, amc_name: str | None = None, scheme_like: str | None = None,
                  limit: int = 100, offset: int = 0) -> DataFrame:
    """Holdings by weight, then value, nulls last; filters reach the scan."""
    q = published
    if amc_name:
        q = q.filter(F.col("amc_name") == amc_name)
    if scheme_like:
        q = q.filter(F.col("scheme_name").ilike(f"%{scheme_like}%"))
    return page(
        q.orderBy(F.desc_nulls_last("pct_to_net_assets"), F.desc_nulls_last("market_value"), "idempotency_key"),
        limit, offset,
    )


def run_counters(outcomes: DataFrame, run: str = "pipeline_run_id") -> DataFrame:
    """Document counters per run from the stage outcomes (published counts tables, not documents)."""
    def n(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    went_on = F.col("is_novel") & F.col("downloaded") & ~F.coalesce("file_seen", F.lit(False))
    return outcomes.groupBy(run).agg(
        F.count(F.lit(1)).alias("documents_discovered"),
        n(F.col("is_novel")).alias("documents_novel"),
        n(went_on & ~F.col("is_quarantined")).alias("documents_classified"),
        n(went_on & F.col("is_quarantined")).alias("documents_quarantined"),
        n(went_on & ~F.col("is_quarantined") & F.col("extracted")).alias("documents_extracted"),
        F.sum(F.coalesce("published_tables", F.lit(0))).alias("documents_published"),
    )


def run_listing(runs: DataFrame, limit: int = 20) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), "run_id").limit(limit)


def close_dangling(runs: DataFrame, as_of, message: str = "Dangling run cleaned up on system startup.",
                   source_id=None) -> DataFrame:
    """RUNNING runs become FAILED, of one source or of all."""
    hit = F.col("status") == "RUNNING"
    if source_id is not None:
        hit = hit & (F.col("source_id") == source_id)
    return runs.withColumns(
        {
            "errors": F.when(hit, F.lit(message)).otherwise(F.col("errors")),
            "status": F.when(hit, F.lit("FAILED")).otherwise(F.col("status")),
        }
    )


def run_alerts(runs: DataFrame, bucket: Column | None = None) -> DataFrame:
    """One row per run with its alert flags.

    The mean duration is taken over the earlier runs of the same source, with running
    sums bucketed by month so that one busy source is not one task.
    """
    b = F.date_trunc("month", "started_at") if bucket is None else bucket
    timed = runs.withColumn(
        "duration_sec", F.unix_micros("completed_at") / F.lit(1e6) - F.unix_micros("started_at") / F.lit(1e6)
    )
    w = running_before(timed, ["source_id"], ["started_at", "run_id"], F.col("duration_sec"), b)
    mean = F.when(F.col("n_before") > 0, F.col("sum_before") / F.col("n_before"))
    handled = F.col("documents_classified") + F.col("documents_quarantined")
    flags = {
        "alert_no_documents": F.col("documents_discovered") == 0,
        "alert_quarantine": (handled > 0) & (F.col("documents_quarantined") > R.QUARANTINE_ALERT_RATE * handled),
        "alert_nothing_published": (F.col("documents_published") == 0) & (F.col("documents_novel") > 0),
        "alert_status": F.col("status").isin("FAILED", "PARTIAL"),
        "alert_duration": F.coalesce(F.col("duration_sec") > R.DURATION_ALERT_FACTOR * F.col("mean_before"), F.lit(False)),
    }
    return w.withColumn("mean_before", mean).withColumns(flags).drop("sum_before", "n_before")


def key_metrics(runs: DataFrame, classified: DataFrame, drifts: DataFrame, published: DataFrame,
                as_of: Column) -> DataFrame:
    """One row of pipeline health figures at ``as_of``."""
    done = F.col("status").isin("COMPLETED", "FAILED", "PARTIAL")
    day = as_of.cast("date")
    run = runs.agg(
        (F.count(F.when(F.col("status") == "COMPLETED", 1)) / F.count(F.when(done, 1))).alias("success_rate"),
        F.avg(F.unix_micros("completed_at") / F.lit(1e6) - F.unix_micros("started_at") / F.lit(1e6)).alias("avg_duration_sec"),
        F.count(
            F.when((F.col("status") == "FAILED") & (F.datediff(day, F.col("started_at").cast("date")).between(0, 7)), 1)
        ).alias("failed_runs_7d"),
        F.count(F.lit(1)).alias("runs"),
    )
    cls = classified.agg(
        F.avg("confidence_score").alias("avg_confidence"),
        F.avg(F.when(F.col("is_quarantined"), 1.0).otherwise(0.0)).alias("quarantine_rate"),
        F.count(F.when(F.col("is_quarantined") & F.col("review_decision").isNull(), 1)).alias("queue_depth"),
    )
    now = (F.col("period_year") == F.year(day)) & (F.col("period_month") == F.month(day))
    pub = published.agg(F.countDistinct(F.when(now, F.col("amc_name"))).alias("amcs_this_month"))
    drift = drifts.agg(F.count(F.lit(1)).alias("drift_events"))
    parts = [df.select(F.struct(*df.columns).alias("s")).scalar() for df in (run, cls, pub, drift)]
    one = runs.sparkSession.range(1).select(*[p.alias(f"p{i}") for i, p in enumerate(parts)])
    return one.select("p0.*", "p1.*", "p2.*", "p3.*").withColumn("drift_per_run", F.col("drift_events") / F.col("runs"))


def source_freshness(sources: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """Days since each source's last completed run; null when it never had one."""
    last = runs.filter(F.col("status") == "COMPLETED").groupBy("source_id").agg(F.max("completed_at").alias("_l"))
    return sources.join(last, "source_id", "left").withColumn(
        "days_since_success", F.datediff(as_of.cast("date"), F.col("_l").cast("date"))
    ).drop("_l")
