"""Manual review: queue, applying decisions, resuming, audit rows, feedback mining."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R

CORRECTABLE = {"amc_name": "corrected_amc_name", "scheme_name": "corrected_scheme_name",
               "period_month": "corrected_period_month", "period_year": "corrected_period_year"}


def pending(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("is_quarantined") & F.col("review_decision").isNull())


def split_for_extraction(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that go on to extraction, documents waiting for review)."""
    held = F.coalesce(F.col("is_quarantined"), F.lit(False))
    return classified.filter(~held), classified.filter(held)


def _given(name: str, dtype: str) -> Column:
    c = F.col(name)
    return F.when(c != "", c) if dtype == "string" else F.when(c != 0, c)


def fold_reviews(reviews: DataFrame, order: Sequence[str] = ("reviewed_at", "review_id")) -> DataFrame:
    """One row per classification: newest decision, and per field the newest correction that applies."""
    o = F.struct(*order)
    types = dict(reviews.dtypes)
    applies = F.col("decision").isin(R.APPLYING_DECISIONS)
    aggs = [F.max_by(F.struct("decision", "reviewer", "notes", "reviewed_at"), o).alias("_r")]
    for field, corr in CORRECTABLE.items():
        v = F.when(applies, _given(corr, types[corr]))
        aggs.append(F.max_by(v, F.when(v.isNotNull(), o)).alias(f"_c_{field}"))
    return reviews.groupBy("classification_id").agg(*aggs)


def apply_reviews(classified: DataFrame, reviews: DataFrame,
                  order: Sequence[str] = ("reviewed_at", "review_id")) -> DataFrame:
    """Record decisions and corrections; any decision takes the document out of quarantine."""
    j = classified.join(fold_reviews(reviews, order), "classification_id", "left")
    hit = F.col("_r").isNotNull()
    cols = {
        "review_decision": F.when(hit, F.col("_r.decision")).otherwise(F.col("review_decision")),
        "reviewed_by": F.when(hit, F.col("_r.reviewer")).otherwise(F.col("reviewed_by")),
        "review_notes": F.when(hit, F.col("_r.notes")).otherwise(F.col("review_notes")),
        "reviewed_at": F.when(hit, F.col("_r.reviewed_at")).otherwise(F.col("reviewed_at")),
        "is_quarantined": F.when(hit, F.lit(False)).otherwise(F.col("is_quarantined")),
        **{f: F.coalesce(F.col(f"_c_{f}"), F.col(f)) for f in CORRECTABLE},
    }
    return j.withColumns(cols).select(*classified.columns)


def resumed(reviewed: DataFrame) -> DataFrame:
    """Documents a reviewer released to extraction."""
    return reviewed.filter(F.col("review_decision").isin(R.APPLYING_DECISIONS))


def audit_rows(before: DataFrame, after: DataFrame, key: str, entity: str, action: str, as_of,
               actor: Column | None = None, fields: Sequence[str] | None = None) -> DataFrame:
    """One row per entity whose fields changed (or that appeared), with both states as JSON."""
    cols = list(fields or [c for c in after.columns if c != key])
    b = before.select(F.col(key).alias("entity_id"), F.to_json(F.struct(*cols)).alias("before_state"))
    a = after.select(
        F.col(key).alias("entity_id"), F.to_json(F.struct(*cols)).alias("after_state"),
        (actor if actor is not None else F.lit("system")).alias("actor"),
    )
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    return a.join(b, "entity_id", "left").filter(~F.col("before_state").eqNullSafe(F.col("after_state"))).select(
        F.lit(entity).alias("entity_type"), "entity_id",
        F.when(F.col("before_state").isNull(), "CREATE").otherwise(action).alias("action"),
        "before_state", "after_state", F.coalesce("actor", F.lit("system")).alias("actor"),
        day.cast("timestamp").alias("created_at"),
    )


def feedback_rates(classified: DataFrame, reviewed: DataFrame, signals: dict[str, str],
                   source: str = "source_id") -> DataFrame:
    """Per source and channel: how often the channel named another fund house than the reviewer settled on."""
    truth = resumed(reviewed).select("classification_id", F.col("amc_name").alias("_true"))
    j = classified.join(truth, "classification_id")
    named = F.explode(F.array(*[
        F.struct(F.lit(ch).alias("channel"), F.col(col)["amc_name"].alias("value")) for ch, col in signals.items()
    ]))
    return j.select(source, "_true", named.alias("x")).filter(F.col("x.value").isNotNull()).groupBy(
        source, F.col("x.channel").alias("channel")
    ).agg(
        F.count(F.lit(1)).alias("reviewed"),
        F.sum(F.when(F.lower("x.value") != F.lower("_true"), 1).otherwise(0)).alias("wrong"),
    ).withColumn("wrong_rate", F.col("wrong") / F.col("reviewed"))


def correction_dictionary(classified: DataFrame, reviewed: DataFrame, field: str = "scheme_name") -> DataFrame:
    """(name as classified, name as corrected, how often)."""
    old = classified.select("classification_id", F.col(field).alias("classified_as"))
    new = resumed(reviewed).select("classification_id", F.col(field).alias("corrected_to"))
    return old.join(new, "classification_id").filter(
        F.col("corrected_to").isNotNull() & ~F.col("classified_as").eqNullSafe(F.col("corrected_to"))
    ).groupBy("classified_as", "corrected_to").agg(F.count(F.lit(1)).alias("times"))
