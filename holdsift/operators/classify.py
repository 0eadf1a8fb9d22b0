"""Document classification: four signals and their fusion in one map-only projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import signals as S
from holdsift.functions.fusion import FIELDS, SIGNALS, fuse


def with_signals(docs: DataFrame, separators: str = "literal", master: Sequence[R.Scheme] = R.SCHEME_MASTER,
                 fuzzy: bool = True) -> DataFrame:
    """Add the four channel structs.

    Reads filename, url, page_context, header_text, sheet_names, file_type, source_amc.
    """
    out = S.with_filename_signal(docs, separators=separators, master=master, fuzzy=fuzzy)
    out = S.with_url_signal(out)
    out = S.with_page_context_signal(out, master=master, fuzzy=fuzzy)
    return S.with_doc_header_signal(out, master=master, fuzzy=fuzzy)


def classify(docs: DataFrame, as_of: Column | str, separators: str = "literal",
             master: Sequence[R.Scheme] = R.SCHEME_MASTER, fuzzy: bool = True,
             weights: Mapping[str, float] = R.WEIGHTS, thresholds: R.Thresholds = R.Thresholds(),
             stale_months: float = R.STALE_MONTHS, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Classified rows: fused fields, score parts, decision, quarantine columns and the channel structs."""
    fused = fuse(with_signals(docs, separators, master, fuzzy), as_of=as_of, weights=weights,
                 thresholds=thresholds, stale_months=stale_months)
    return fused.select(
        *keep, F.sha2(F.concat(F.lit("cls|"), F.col("doc_id").cast("string")), 256).alias("classification_id"),
        *FIELDS, "period_label", "weighted_score", "agreement_bonus", "disagreement_penalty", "confidence_score",
        "decision", "is_quarantined", "quarantine_reason", "quarantine_reason_compat", "quarantine_details",
        "reason_codes", *SIGNALS.values(),
    )


def extra_triggers(classified: DataFrame, as_of: Column | str, stale_months: float = R.STALE_MONTHS_STRICT,
                   source_amc: str = "source_amc") -> DataFrame:
    """Flags of the stricter review policy: stale over three months, unknown scheme, header of another house."""
    from holdsift.functions.periods import months_old

    day = (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("date")
    header = F.col(f"{SIGNALS['doc_header']}.amc_name")
    return classified.withColumns(
        {
            "stale_strict": F.coalesce(months_old(F.col("period_month"), F.col("period_year"), day) > stale_months, F.lit(False)),
            "unknown_scheme": F.col("scheme_name").isNull(),
            "header_amc_mismatch": F.coalesce(F.lower(header) != F.lower(F.col(source_amc)), F.lit(False)),
        }
    )
