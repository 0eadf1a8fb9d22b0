"""Content, data and identity hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_hash(text: Column) -> Column:
    """Hash of lower-cased text with every run of blanks as one space."""
    return F.sha2(F.trim(F.regexp_replace(F.lower(text), r"(?U)[\s\x1c-\x1f]+", " ")), 256)


def canonical_row(fields: list[str], cols=None) -> Column:
    """One row as text: ``name=value`` of its non-null fields in name order, quoted."""
    parts = []
    for f in sorted(fields):
        c = F.col(f) if cols is None else cols[f]
        parts.append(F.concat(F.lit(f + "="), F.to_json(F.struct(c.alias("v")))))
    usable = [F.when((F.col(f) if cols is None else cols[f]).isNotNull(), p) for f, p in zip(sorted(fields), parts)]
    return F.array_join(F.array_compact(F.array(*usable)), "\x1f")


def idempotency_key(source_key: Column, year: Column, month: Column, scheme: Column, data_hash: Column) -> Column:
    return F.sha2(
        F.concat_ws(
            "|",
            source_key,
            F.coalesce(year, F.lit(0)).cast("string"),
            F.coalesce(month, F.lit(0)).cast("string"),
            F.coalesce(F.when(scheme != "", scheme), F.lit("unknown")),
            data_hash,
        ),
        256,
    )


def holding_key(amc: Column, scheme: Column, year: Column, month: Column,
                isin: Column, name: Column, row_idx: Column) -> Column:
    instrument = F.coalesce(
        F.when(isin != "", isin), F.when(name != "", name), F.concat(F.lit("row_"), row_idx.cast("string"))
    )
    return F.sha2(
        F.concat_ws("|", amc, scheme, year.cast("string"), month.cast("string"), instrument), 256
    )


def document_id(source: Column, fingerprint: Column) -> Column:
    """Deterministic id: a re-run gives the same one."""
    return F.sha2(F.concat_ws("|", source.cast("string"), fingerprint), 256)
