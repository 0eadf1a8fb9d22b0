"""Warehouse stages: staging, validation, publishing, status and audit of states.

Staging keeps one metadata row per extracted table; the holding rows themselves stay
in the long rows table, so no stage ever builds a whole table as one value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions.cells import publish_number
from holdsift.functions.hashing import holding_key
from holdsift.operators.keys import keep_first, keep_last, running_before

KEY = "idempotency_key"
MEASURES = ["quantity", "market_value", "pct_to_net_assets", "rating"]
IDENTITY = ["document_id", "amc_name", "scheme_name", "scheme_category", "period_month", "period_year",
            "isin", "instrument_name", "instrument_type", "industry"]


def _moment(as_of) -> Column:
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


# ---------------------------------------------------------------------------
# Staging
# ---------------------------------------------------------------------------
def stage_new(staged: DataFrame, batch: DataFrame, order: Sequence[str] = ("document_id",)) -> DataFrame:
    """Rows to append: first per key in the batch whose key is not staged yet."""
    return keep_first(batch, [KEY], list(order)).join(staged.select(KEY), KEY, "left_anti")


def stage_insert(staged: DataFrame, batch: DataFrame, order: Sequence[str] = ("document_id",)) -> DataFrame:
    return staged.unionByName(stage_new(staged, batch, order))


def stage_upsert(staged: DataFrame, batch: DataFrame, as_of, order: Sequence[str] = ("document_id",)) -> DataFrame:
    """Insert new keys; update a known key only when its content hash differs (then touch ``updated_at``)."""
    rest = [c for c in staged.columns if c != KEY]
    new = keep_last(batch, [KEY], list(order))
    new = new.select(KEY, F.struct(*[c for c in rest if c in batch.columns]).alias("_n"))
    old = staged.select(KEY, F.struct(*rest).alias("_o"))
    j = old.join(new, KEY, "full_outer")
    insert = F.col("_o").isNull()
    changed = insert | F.coalesce(F.col("_o.content_hash") != F.col("_n.content_hash"), F.lit(False))
    cols = []
    for c in rest:
        if c == "updated_at":
            cols.append(F.when(changed, _moment(as_of)).otherwise(F.col("_o.updated_at")).alias(c))
        elif c in batch.columns:
            cols.append(F.when(changed, F.col("_n")[c]).otherwise(F.col("_o")[c]).alias(c))
        else:
            cols.append(F.col("_o")[c].alias(c))
    return j.select(KEY, *cols)


# ---------------------------------------------------------------------------
# Validation
# ---------------------------------------------------------------------------
def validate_rows(rows: DataFrame, rules: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``warnings`` and ``errors``; ``rules`` maps an error message to the condition that raises it."""
    nameless = F.col("isin").isNull() & F.col("instrument_name").isNull()
    errs = [F.when(c, F.lit(m)) for m, c in (rules or {}).items()]
    return rows.withColumns(
        {
            "warnings": F.when(nameless, F.array(F.lit("Missing both ISIN and Instrument Name"))).otherwise(
                F.array().cast("array<string>")
            ),
            "errors": F.array_compact(F.array(*errs)) if errs else F.array().cast("array<string>"),
        }
    )


def validation_summary(validated: DataFrame, table: Sequence[str] = ("doc_id", "table_id")) -> DataFrame:
    return validated.groupBy(*table).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(F.size("errors")).alias("error_count"),
        F.sum(F.size("warnings")).alias("warning_count"),
    ).withColumns(
        {
            "validation_status": F.when(F.col("error_count") == 0, "PASSED").otherwise("FAILED"),
            "business_rules_passed": F.col("error_count") == 0,
        }
    )


def publishable(validated: DataFrame, summary: DataFrame, table: Sequence[str] = ("doc_id", "table_id")) -> DataFrame:
    """Rows of tables that passed every rule."""
    failed = summary.filter(~F.col("business_rules_passed")).select(*table)
    return validated.join(failed, list(table), "left_anti")


# ---------------------------------------------------------------------------
# Publishing
# ---------------------------------------------------------------------------
def publish_rows(rows: DataFrame) -> DataFrame:
    """Name defaults, numeric parse and holding key; measures may come as numbers or as text."""
    def number(c):
        raw = f"{c}_raw"
        if dict(rows.dtypes)[c] == "string":
            return publish_number(F.col(c))
        return F.coalesce(F.col(c), publish_number(F.col(raw))) if raw in rows.columns else F.col(c)

    out = rows.withColumns(
        {
            "amc_name": F.coalesce(F.when(F.col("amc_name") != "", F.col("amc_name")), F.lit(R.UNKNOWN_AMC)),
            "scheme_name": F.coalesce(F.when(F.col("scheme_name") != "", F.col("scheme_name")), F.lit(R.UNKNOWN_SCHEME)),
            "period_year": F.coalesce("period_year", F.lit(0)),
            "period_month": F.coalesce("period_month", F.lit(0)),
            **{c: number(c) for c in R.NUMERIC_FIELDS},
        }
    )
    return out.withColumn(
        KEY,
        holding_key(F.col("amc_name"), F.col("scheme_name"), F.col("period_year"), F.col("period_month"),
                    F.col("isin"), F.col("instrument_name"), F.col("row_idx")),
    )


def collapse_batch(batch: DataFrame, order: Sequence[str]) -> DataFrame:
    """One row per holding key: identity of its first row, measures of its last, number of rows.

    One aggregate with map-side combine; a key repeated any number of times costs one
    row per task in the shuffle.
    """
    o = F.struct(*order)
    return batch.groupBy(KEY).agg(
        F.min_by(F.struct(*IDENTITY), o).alias("_id"),
        F.max_by(F.struct(*MEASURES), o).alias("_m"),
        F.count(F.lit(1)).alias("_n"),
    )


def publish_upsert(current: DataFrame, batch: DataFrame, order: Sequence[str], as_of, run: str | None = None) -> DataFrame:
    """New snapshot of the published table after applying the batch row by row in ``order``.

    A known key has its measures overwritten (also by null) and its version raised once
    per row; a new key is inserted at version 1 and its repeats raise it further.  With
    ``run``, rows of the batch carry it as ``touched_by`` and others keep theirs.
    """
    new = collapse_batch(batch, order)
    stored = [*IDENTITY, *MEASURES, "version", "is_current", "published_at", "updated_at", *(["touched_by"] if run else [])]
    old = current.select(KEY, F.struct(*stored).alias("_o"))
    j = old.join(new, KEY, "full_outer")
    known, touched = F.col("_o").isNotNull(), F.col("_n").isNotNull()
    return j.select(
        KEY,
        *[F.when(known, F.col("_o")[c]).otherwise(F.col("_id")[c]).alias(c) for c in IDENTITY],
        *[F.when(touched, F.col("_m")[c]).otherwise(F.col("_o")[c]).alias(c) for c in MEASURES],
        (F.coalesce(F.col("_o.version"), F.lit(0)) + F.coalesce(F.col("_n"), F.lit(0))).cast("int").alias("version"),
        F.coalesce(F.col("_o.is_current"), F.lit(True)).alias("is_current"),
        F.coalesce(F.col("_o.published_at"), _moment(as_of)).alias("published_at"),
        F.when(touched, _moment(as_of)).otherwise(F.col("_o.updated_at")).alias("updated_at"),
        *([F.when(touched, F.lit(run)).otherwise(F.col("_o.touched_by")).alias("touched_by")] if run else []),
    )


PUBLISHED_SCHEMA = (
    f"{KEY} string, document_id string, amc_name string, scheme_name string, scheme_category string, "
    "period_month int, period_year int, isin string, instrument_name string, instrument_type string, "
    "industry string, quantity double, market_value double, pct_to_net_assets double, rating string, "
    "version int, is_current boolean, published_at timestamp, updated_at timestamp"
)


def empty_published(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PUBLISHED_SCHEMA)


#: Keys are counted in so many slots of their hash; those of a slot above ``HOT_ROWS`` rows are numbered by bucket.
KEY_SLOTS = 4096
HOT_ROWS = 1_000_000


def publish_history(history: DataFrame, batch: DataFrame, order: Sequence[str], bucket: Column, as_of,
                    hot_rows: int = HOT_ROWS) -> DataFrame:
    """Versioned mode: every batch row is a version of its own; only the newest per key is current.

    Rows meet their key's history in one window, so they are shuffled once. A key with very many
    versions is not numbered in one task: slots of keys above ``hot_rows`` rows take bucketed
    running counts instead, with the same result. ``bucket`` must grow with ``order``.
    """
    batch = batch.filter(F.col(KEY).isNotNull())
    slot = F.pmod(F.xxhash64(KEY), F.lit(KEY_SLOTS))
    sizes = history.select(KEY).unionByName(batch.select(KEY)).groupBy(slot.alias("_slot")).count()
    hot = [r["_slot"] for r in sizes.filter(F.col("count") > hot_rows).select("_slot").collect()]
    if not hot:
        return _history_by_key(history, batch, order, as_of)
    far = slot.isin(hot)
    return _history_by_key(history.filter(~far), batch.filter(~far), order, as_of).unionByName(
        _history_by_bucket(history.filter(far), batch.filter(far), order, bucket, as_of)
    )


def _history_by_key(history: DataFrame, batch: DataFrame, order: Sequence[str], as_of) -> DataFrame:
    old = history.withColumn("_new", F.lit(False))
    new = batch.select(KEY, *IDENTITY, *MEASURES, F.struct(*order).alias("_at"), F.lit(True).alias("_new"))
    w = Window.partitionBy(KEY).orderBy("_new", "_at")
    before = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = old.unionByName(new, allowMissingColumns=True).withColumns(
        {
            "_top": F.max("version").over(before),
            "_n": F.count(F.when(F.col("_new"), 1)).over(before),
            "_last": F.lead("_new").over(w).isNull(),
            "_hit": F.max("_new").over(whole),
        }
    )
    added, now = F.col("_new"), _moment(as_of)
    return rows.withColumns(
        {
            "version": F.when(added, F.coalesce("_top", F.lit(0)) + F.col("_n")).otherwise(F.col("version")).cast("int"),
            "is_current": F.when(added, F.col("_last")).otherwise(F.col("is_current") & ~F.col("_hit")),
            "published_at": F.when(added, now).otherwise(F.col("published_at")),
            "updated_at": F.when(added | (F.col("_hit") & F.col("is_current")), now).otherwise(F.col("updated_at")),
        }
    ).select(*history.columns)


def _history_by_bucket(history: DataFrame, batch: DataFrame, order: Sequence[str], bucket: Column, as_of) -> DataFrame:
    numbered = running_before(batch, [KEY], order, F.lit(1.0), bucket)
    totals = batch.groupBy(KEY).agg(F.count(F.lit(1)).alias("_t"))
    tops = history.groupBy(KEY).agg(F.max("version").alias("_top"))
    new = numbered.join(totals, KEY).join(tops, KEY, "left").select(
        KEY, *IDENTITY, *MEASURES,
        (F.coalesce("_top", F.lit(0)) + F.col("n_before") + 1).cast("int").alias("version"),
        (F.col("n_before") + 1 == F.col("_t")).alias("is_current"),
        _moment(as_of).alias("published_at"), _moment(as_of).alias("updated_at"),
    )
    superseded = history.join(totals.select(KEY, F.lit(True).alias("_hit")), KEY, "left").withColumns(
        {
            "updated_at": F.when(F.col("_hit") & F.col("is_current"), _moment(as_of)).otherwise(F.col("updated_at")),
            "is_current": F.col("is_current") & F.col("_hit").isNull(),
        }
    ).drop("_hit")
    return superseded.unionByName(new)


def stored_types(published: DataFrame) -> DataFrame:
    """Column types of the stored table: fixed-point measures."""
    return published.withColumns(
        {
            "quantity": F.col("quantity").cast("decimal(20,4)"),
            "market_value": F.col("market_value").cast("decimal(20,4)"),
            "pct_to_net_assets": F.col("pct_to_net_assets").cast("decimal(8,4)"),
        }
    )


# ---------------------------------------------------------------------------
# Status
# ---------------------------------------------------------------------------
def final_status(outcomes: DataFrame) -> DataFrame:
    """Document status from its stage outcomes.

    Columns read (booleans, null = stage not reached): downloaded, file_seen, is_quarantined,
    type_supported, extracted, staged_tables, published_tables (counts).
    """
    def yes(c):
        return F.coalesce(F.col(c), F.lit(False))

    status = (
        F.when(~yes("downloaded"), "FAILED")
        .when(yes("file_seen"), "PUBLISHED")
        .when(yes("is_quarantined"), "QUARANTINED")
        .when(~yes("type_supported") | ~yes("extracted"), "FAILED")
        .when(F.coalesce("published_tables", F.lit(0)) > 0, "PUBLISHED")
        .when(F.coalesce("staged_tables", F.lit(0)) > 0, "VALIDATED")
        .otherwise("EXTRACTED")
    )
    error = (
        F.when(~yes("downloaded"), "download failed")
        .when(yes("file_seen") | yes("is_quarantined"), F.lit(None))
        .when(~yes("type_supported"), F.concat(F.lit("Extraction error: Unsupported file type: "), F.coalesce("file_type", F.lit("None"))))
        .when(~yes("extracted"), "Extraction error")
    )
    return outcomes.withColumns({"status": status, "last_error": error})


def status_audit(docs: DataFrame, staged: DataFrame, published: DataFrame) -> DataFrame:
    """Documents whose status is unknown or disagrees with the stage tables."""
    s = staged.groupBy("document_id").agg(F.count(F.lit(1)).alias("_s"))
    p = published.groupBy("document_id").agg(F.count(F.lit(1)).alias("_p"))
    j = docs.join(s, docs["doc_id"] == s["document_id"], "left").drop("document_id")
    j = j.join(p, j["doc_id"] == p["document_id"], "left").drop("document_id")
    st, has_s, has_p = F.col("status"), F.col("_s").isNotNull(), F.col("_p").isNotNull()
    problem = (
        F.when(st.isNull() | ~st.isin(R.DOCUMENT_STATUSES), "UNKNOWN_STATUS")
        .when((st == "PUBLISHED") & ~has_p, "PUBLISHED_WITHOUT_ROWS")
        .when(st.isin("STAGED", "VALIDATED") & ~has_s, "STAGED_WITHOUT_ROWS")
        .when(st.isin("QUARANTINED", "REJECTED", "DISCOVERED", "DOWNLOADED") & has_p, "PUBLISHED_ROWS_BEHIND_STATUS")
    )
    return j.withColumn("problem", problem).filter(F.col("problem").isNotNull()).drop("_s", "_p")
