"""Score fusion: four channel structs to one decision, as plain column arithmetic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions.periods import months_old, period_label
from holdsift.functions.text import clamp01, hit, settle

SIGNALS = {
    "doc_header": "doc_header_signal",
    "page_context": "page_context_signal",
    "filename": "filename_signal",
    "url": "url_signal",
}
FIELDS = ["amc_name", "scheme_name", "period_month", "period_year", "scheme_category", "doc_type"]


def _sum(cols: Sequence[Column]) -> Column:
    out = cols[0]
    for c in cols[1:]:
        out = out + c
    return out


def weighted_score(weights: Mapping[str, float], sig: Mapping[str, Mapping[str, Column]]) -> Column:
    return _sum([F.lit(weights[c]) * sig[c]["confidence"] for c in R.CHANNELS])


def best_value(field: str, weights: Mapping[str, float], sig: Mapping[str, Mapping[str, Column]]) -> Column:
    """Non-null value with the highest weight x confidence; ties go to the earlier channel."""
    ranked = [
        F.when(
            sig[c][field].isNotNull(),
            F.struct(
                (F.lit(weights[c]) * sig[c]["confidence"]).alias("score"),
                F.lit(-i).alias("prio"),
                sig[c][field].alias("value"),
            ),
        )
        for i, c in enumerate(R.CHANNELS)
    ]
    return F.array_max(F.array(*ranked))["value"]


def _clean(values: Sequence[Column]) -> list[Column]:
    """Lower-cased, trimmed; empty and null become null."""
    return [F.when(v != "", F.trim(F.lower(v))) for v in values]


def _most_common(values: Sequence[Column]) -> Column:
    return F.greatest(*[_sum([hit(v == w) for w in values]) for v in values])


def _distinct(values: Sequence[Column]) -> Column:
    return F.size(F.array_distinct(F.array_compact(F.array(*values))))


def _count(values: Sequence[Column]) -> Column:
    return _sum([hit(v.isNotNull()) for v in values])


def fuse(df: DataFrame, source_amc: str = "source_amc", as_of: Column | str | None = None,
         signals: Mapping[str, str] = SIGNALS, weights: Mapping[str, float] = R.WEIGHTS,
         thresholds: R.Thresholds = R.Thresholds(), agreement: float = R.AGREEMENT_BONUS,
         disagreement: float = R.DISAGREEMENT_PENALTY, stale_months: float = R.STALE_MONTHS) -> DataFrame:
    """Add fused identity fields, score parts, decision and quarantine columns.

    ``as_of`` is the date ages are measured at; a constant or a column, never "now".
    """
    if as_of is None:
        raise ValueError("as_of is required: ages must not depend on the wall clock")
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    day = day.cast("date")
    # plain columns first: struct fields would be inlined again at every use below
    flat = [*FIELDS, "confidence"]
    df = df.withColumns({f"_{c}_{f}": F.col(signals[c])[f] for c in R.CHANNELS for f in flat})
    sig = {c: {f: F.col(f"_{c}_{f}") for f in flat} for c in R.CHANNELS}
    src = F.when(F.col(source_amc) != "", F.col(source_amc))

    best = {f: best_value(f, weights, sig) for f in FIELDS}
    out = df.withColumns(
        {
            "amc_name": F.coalesce(F.when(best["amc_name"] != "", best["amc_name"]), src),
            **{f: best[f] for f in FIELDS if f != "amc_name"},
            "weighted_score": weighted_score(weights, sig),
        }
    )

    raw_amc = [sig[c]["amc_name"] for c in R.CHANNELS]
    amcs = _clean(raw_amc)
    lowered = [F.when(v != "", F.lower(v)) for v in raw_amc]
    periods = [
        F.concat_ws("-", sig[c]["period_month"].cast("string"), sig[c]["period_year"].cast("string"))
        for c in R.CHANNELS
    ]
    periods = [
        F.when(sig[c]["period_month"].isNotNull() & sig[c]["period_year"].isNotNull(), p)
        for c, p in zip(R.CHANNELS, periods)
    ]
    months = [sig[c]["period_month"] for c in R.CHANNELS]

    bonus_amc = F.when(_most_common(amcs) >= 3, F.lit(agreement / 2)).when(
        (_count(lowered) == 2) & (_distinct(lowered) == 1), F.lit(agreement / 4)
    ).otherwise(F.lit(0.0))
    same_period = _distinct(periods) == 1
    bonus_period = F.when((_count(periods) >= 3) & same_period, F.lit(agreement / 2)).when(
        (_count(periods) == 2) & same_period, F.lit(agreement / 4)
    ).otherwise(F.lit(0.0))

    amc_conflict = _distinct(amcs) > 1
    amc_mismatch = F.coalesce(F.lower(src) != F.lower(F.col("amc_name")), F.lit(False))
    month_conflict = _distinct(months) > 1
    penalty = (
        F.when(amc_conflict, F.lit(disagreement)).otherwise(F.lit(0.0))
        + F.when(amc_mismatch, F.lit(disagreement / 2)).otherwise(F.lit(0.0))
        + F.when(month_conflict, F.lit(disagreement / 2)).otherwise(F.lit(0.0))
    )
    out = out.withColumns(
        {
            "agreement_bonus": bonus_amc + bonus_period,
            "disagreement_penalty": penalty,
            "_amc_conflict": amc_conflict,
            "_amc_mismatch": amc_mismatch,
            "_month_conflict": month_conflict,
            "_age": months_old(F.col("period_month"), F.col("period_year"), day),
        }
    ).withColumn(
        "confidence_score",
        clamp01(F.col("weighted_score") + F.col("agreement_bonus") - F.col("disagreement_penalty")),
    )

    score = F.col("confidence_score")
    tiers = (
        F.when(score >= thresholds.auto_accept, F.lit("AUTO_ACCEPT"))
        .when(score >= thresholds.accept_flag, F.lit("ACCEPT_WITH_FLAG"))
        .when(score >= thresholds.quarantine, F.lit("QUARANTINE"))
        .otherwise(F.lit("REJECT"))
    )
    out = out.withColumn("_tier", tiers)
    tier = F.col("_tier")
    no_amc = F.col("amc_name").isNull()
    no_period = F.col("period_month").isNull() | F.col("period_year").isNull()
    stale = F.coalesce(F.col("_age") > stale_months, F.lit(False))
    step1 = F.when(no_amc, F.lit("QUARANTINE")).otherwise(tier)
    step2 = F.when(no_period & (step1 == "AUTO_ACCEPT"), F.lit("ACCEPT_WITH_FLAG")).otherwise(step1)
    decision = F.when(stale & step2.isin("AUTO_ACCEPT", "ACCEPT_WITH_FLAG"), F.lit("QUARANTINE")).otherwise(step2)

    below_accept, below_quarantine = tier == "QUARANTINE", tier == "REJECT"
    facts = [
        (F.col("_amc_conflict"), "AMC_CONFLICT", F.lit("AMC signals contradict across channels")),
        (F.col("_amc_mismatch"), "AMC_MISMATCH",
         F.concat(F.lit("AMC mismatch: source="), src, F.lit(", resolved="), F.col("amc_name"))),
        (F.col("_month_conflict"), "PERIOD_CONFLICT", F.lit("Period month contradicts across channels")),
        (below_accept, "BELOW_ACCEPT",
         F.format_string(f"Confidence %.2f below accept threshold {thresholds.accept_flag}", score)),
        (below_quarantine, "BELOW_QUARANTINE",
         F.format_string(f"Confidence %.2f below quarantine threshold {thresholds.quarantine}", score)),
        (no_amc, "NO_AMC", F.lit("AMC name could not be determined")),
        (no_period, "NO_PERIOD", F.lit("Period (month/year) could not be fully determined")),
        (stale, "STALE",
         F.format_string(f"Document period is %.0f months old (threshold: {stale_months})", F.col("_age"))),
    ]
    out = out.withColumns(
        {
            "decision": settle(decision),
            "reason_codes": F.array_compact(F.array(*[F.when(c, F.lit(code)) for c, code, _ in facts])),
            "reasons": F.array_compact(F.array(*[F.when(c, text) for c, _, text in facts])),
        }
    )

    held = F.col("decision").isin("QUARANTINE", "REJECT")
    codes = F.col("reason_codes")

    def has(*names):
        return F.arrays_overlap(codes, F.array(*[F.lit(n) for n in names]))

    def mentions(*words):
        return F.exists(F.col("reasons"), lambda r: F.lower(r).rlike("|".join(words)))

    compat = (
        F.when(F.col("decision") == "REJECT", F.lit("LOW_CONFIDENCE"))
        .when(mentions("contradict"), F.lit("CLASSIFICATION_CONFLICT"))
        .when(mentions("stale", "old"), F.lit("STALE_PERIOD"))
        .when(mentions("scheme"), F.lit("UNKNOWN_SCHEME"))
        .otherwise(F.lit("LOW_CONFIDENCE"))
    )
    meant = (
        F.when(F.col("decision") == "REJECT", F.lit("LOW_CONFIDENCE"))
        .when(has("AMC_CONFLICT", "PERIOD_CONFLICT"), F.lit("CLASSIFICATION_CONFLICT"))
        .when(has("STALE"), F.lit("STALE_PERIOD"))
        .when(F.col("scheme_name").isNull(), F.lit("UNKNOWN_SCHEME"))
        .otherwise(F.lit("LOW_CONFIDENCE"))
    )
    return out.withColumns(
        {
            "is_quarantined": held,
            "quarantine_reason_compat": F.when(held, compat),
            "quarantine_reason": F.when(held, meant),
            "quarantine_details": F.when(held, F.array_join(F.col("reasons"), "; ")),
            "period_label": period_label(F.col("period_month"), F.col("period_year")),
        }
    ).drop(
        "_amc_conflict", "_amc_mismatch", "_month_conflict", "_age", "_tier",
        *[f"_{c}_{f}" for c in R.CHANNELS for f in flat],
    )


def percent_label(score: Column) -> Column:
    return F.round(score * F.lit(100)).cast("int")
