"""Novelty: URL, file and content checks, the cascade, the ledger upsert, data hashes.

Every check is a keyed join with the ledger.  Lookup sides are reduced to one row
per key first, null keys never join, and the hot side of a skewed key can be split
by AQE because the other side has a single row for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions.hashing import canonical_row, content_hash
from holdsift.operators.keys import keep_first, keep_last


def with_content_hash(docs: DataFrame, text: str = "text", out: str = "content_hash") -> DataFrame:
    return docs.withColumn(out, content_hash(F.col(text)))


def known_urls(docs: DataFrame, ledger: DataFrame, scope: str = "source_id") -> DataFrame:
    """Each document with the ledger status of its URL; null status means the URL is new."""
    seen = ledger.select(scope, "url_fingerprint", F.col("status").alias("known_status"))
    return docs.join(seen, [scope, "url_fingerprint"], "left").withColumn(
        "url_is_novel", F.col("known_status").isNull()
    )


def new_urls(docs: DataFrame, ledger: DataFrame, scope: str = "source_id") -> DataFrame:
    return docs.join(ledger.select(scope, "url_fingerprint"), [scope, "url_fingerprint"], "left_anti")


def _holders(ledger: DataFrame, hash_col: str, scope: str, doc_id: str) -> DataFrame:
    """Per (scope, hash): smallest and largest document id, enough to tell "held by another document"."""
    return ledger.filter(F.col(hash_col).isNotNull()).groupBy(scope, hash_col).agg(
        F.min(doc_id).alias("_lo"), F.max(doc_id).alias("_hi")
    )


def hash_seen(docs: DataFrame, ledger: DataFrame, hash_col: str, scope: str = "source_id",
              doc_id: str = "doc_id", out: str | None = None, exclude_self: bool = True) -> DataFrame:
    """Flag documents whose hash another document of the same scope already has in the ledger."""
    held = _holders(ledger, hash_col, scope, doc_id)
    other = F.col("_lo").isNotNull()
    if exclude_self:
        other = other & ((F.col("_lo") != F.col(doc_id)) | (F.col("_hi") != F.col(doc_id)))
    return docs.join(held, [scope, hash_col], "left").withColumn(
        out or f"{hash_col}_seen", F.coalesce(other, F.lit(False))
    ).drop("_lo", "_hi")


def duplicates_in_batch(docs: DataFrame, hash_col: str, order: Sequence[str], scope: str | None = "source_id",
                        doc_id: str = "doc_id") -> DataFrame:
    """Mark all but the first document of every (scope, hash); null hashes are never duplicates.

    The first one is found with an aggregate and joined back, so a hash shared by a
    large part of the batch is not gathered in one task.
    """
    keys = [hash_col] if scope is None else [scope, hash_col]
    first = docs.filter(F.col(hash_col).isNotNull()).groupBy(*keys).agg(
        F.min_by(F.col(doc_id), F.struct(*order)).alias("first_doc_id"),
        F.count(F.lit(1)).alias("copies"),
    )
    return docs.join(first, keys, "left").withColumn(
        "is_duplicate", F.coalesce(F.col("first_doc_id") != F.col(doc_id), F.lit(False))
    )


def novelty_cascade(docs: DataFrame, ledger: DataFrame, scope: str = "source_id", force_refresh: bool = False,
                    duplicate_label: str | None = None) -> DataFrame:
    """(is_novel, novelty_reason) per document: URL status first, then file hash, then content hash.

    A URL whose status is neither processed nor retryable falls through to the hashes.
    """
    if force_refresh:
        return docs.withColumns({"is_novel": F.lit(True), "novelty_reason": F.lit("force_refresh")})
    j = known_urls(docs, ledger, scope)
    j = hash_seen(j, ledger, "file_hash_sha256", scope, out="_file", exclude_self=False)
    j = hash_seen(j, ledger, "content_hash", scope, out="_content", exclude_self=False)
    status = F.col("known_status")
    reason = (
        F.when(status.isin(R.PROCESSED_STATUSES), F.concat(F.lit("url_seen:status="), status))
        .when(status.isin(R.RETRY_STATUSES), F.concat(F.lit("retry:previous_status="), status))
        .when(F.col("_file"), F.lit("file_hash_duplicate"))
        .when(F.col("_content"), F.lit("content_hash_duplicate"))
        .otherwise(F.lit("novel"))
    )
    j = j.withColumn("novelty_reason", reason).withColumn(
        "is_novel", F.col("novelty_reason").rlike("^(novel|retry:)")
    )
    if duplicate_label:
        j = j.withColumn("status", F.when(F.col("is_novel"), F.col("status")).otherwise(F.lit(duplicate_label)))
    return j.drop("_file", "_content", "known_status", "url_is_novel")


def not_settled(docs: DataFrame, ledger: DataFrame, scope: str = "source_id", force_refresh: bool = False,
                settled: Sequence[str] = tuple(R.SETTLED_STATUSES)) -> DataFrame:
    """Documents still to process: unknown URLs and known ones whose status is not settled."""
    if force_refresh:
        return docs
    done = ledger.filter(F.col("status").isin(list(settled))).select(scope, "url_fingerprint")
    return docs.join(done, [scope, "url_fingerprint"], "left_anti")


def mark_file_duplicates(docs: DataFrame, ledger: DataFrame, scope: str = "source_id",
                         label: str = "PUBLISHED") -> DataFrame:
    """Documents whose bytes another document already has take ``label`` without being published."""
    return hash_seen(docs, ledger, "file_hash_sha256", scope, out="file_seen").withColumn(
        "status", F.when(F.col("file_seen"), F.lit(label)).otherwise(F.col("status"))
    )


LEDGER_COLUMNS = [
    "source_id", "url_fingerprint", "doc_id", "url", "filename", "file_type", "file_size_bytes",
    "file_hash_sha256", "content_hash", "local_path", "status", "page_context", "download_attempts",
    "discovered_at", "updated_at",
]


def ledger_upsert(ledger: DataFrame, batch: DataFrame, as_of: Column | str, order: Sequence[str],
                  keys: Sequence[str] = ("source_id", "url_fingerprint")) -> DataFrame:
    """Merge a batch of recorded documents into the ledger.

    On a known key status and page context are overwritten, attempts grow by one per
    recording, and hashes, path and size change only where the new value is there.
    A key repeated in the batch acts as that many recordings in ``order``; its first
    row creates the record when the key is new.
    """
    cols = [c for c in LEDGER_COLUMNS if c in ledger.columns]
    keep_old = [c for c in ("file_size_bytes", "file_hash_sha256", "content_hash", "local_path") if c in cols]
    overwrite = [c for c in ("status", "page_context") if c in cols]
    create = [c for c in cols if c not in keys and c not in keep_old and c not in overwrite
              and c not in ("download_attempts", "updated_at")]
    o = F.struct(*order)
    filled = {c: F.when(F.col(c) != 0, F.col(c)) if c == "file_size_bytes" else F.when(F.col(c) != "", F.col(c))
              for c in keep_old}
    new = batch.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.struct(*create), o).alias("_first"),
        F.max_by(F.struct(*overwrite), o).alias("_last"),
        *[F.max_by(filled[c], F.when(filled[c].isNotNull(), o)).alias(f"_v_{c}") for c in keep_old],
    ).withColumn("_new", F.lit(True))
    old = ledger.select(*keys, F.struct(*[c for c in cols if c not in keys]).alias("_old"))
    j = old.join(new, list(keys), "full_outer")
    known, touched = F.col("_old").isNotNull(), F.coalesce(F.col("_new"), F.lit(False))
    day = as_of if isinstance(as_of, Column) else F.lit(as_of)
    val = {}
    for c in create:
        val[c] = F.when(known, F.col("_old")[c]).otherwise(F.col("_first")[c])
    for c in overwrite:
        val[c] = F.when(touched, F.col("_last")[c]).otherwise(F.col("_old")[c])
    for c in keep_old:
        val[c] = F.coalesce(F.col(f"_v_{c}"), F.col("_old")[c])
    if "download_attempts" in cols:
        n = F.coalesce(F.col("_n"), F.lit(0))
        val["download_attempts"] = F.when(known, F.col("_old.download_attempts") + n).otherwise(n - 1).cast("int")
    if "updated_at" in cols:
        val["updated_at"] = F.when(touched, day.cast("timestamp")).otherwise(F.col("_old.updated_at"))
    return j.select(*[F.col(c) if c in keys else val[c].alias(c) for c in cols])


def data_hashes(rows: DataFrame, table: Sequence[str], order: str, fields: Sequence[str]) -> DataFrame:
    """Order-sensitive hash of each table's rows.

    Rows are hashed first and gathered as fixed-width digests.  A table is folded
    block by block (``BLOCK`` rows each), so no task ever holds more than a block of
    digests and then one digest per block.
    """
    hashed = rows.select(
        *table, F.floor(F.col(order) / F.lit(DATA_HASH_BLOCK)).alias("_b"), F.col(order).alias("_o"),
        F.sha2(canonical_row(list(fields)), 256).alias("_h"),
    )
    blocks = hashed.groupBy(*table, "_b").agg(
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_o", "_h"))), lambda x: x["_h"]), "|"), 256).alias("_bh"),
        F.count(F.lit(1)).alias("_n"),
    )
    return blocks.groupBy(*table).agg(
        F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_b", "_bh"))), lambda x: x["_bh"]), "|"), 256).alias("data_hash"),
        F.sum("_n").alias("row_count"),
    )


DATA_HASH_BLOCK = 4096


def version_decision(current: DataFrame, incoming: DataFrame, keys: Sequence[str], hash_col: str = "content_hash",
                     order: Sequence[str] = ()) -> DataFrame:
    """skip / new_version / insert per logical key."""
    inc = keep_last(incoming, keys, order) if order else incoming
    cur = current.select(*keys, F.col(hash_col).alias("_old"))
    return inc.join(cur, list(keys), "left").withColumn(
        "outcome",
        F.when(F.col("_old").isNull(), "insert").when(F.col("_old") == F.col(hash_col), "skip").otherwise("new_version"),
    ).drop("_old")


def shared_content(docs: DataFrame, hash_col: str = "content_hash", scheme: str = "scheme_name") -> DataFrame:
    """Documents whose content also appears under another scheme (any source)."""
    spread = docs.filter(F.col(hash_col).isNotNull()).groupBy(hash_col).agg(
        F.min(scheme).alias("_a"), F.max(scheme).alias("_z")
    )
    return docs.join(spread, hash_col, "left").withColumn(
        "duplicate_content", F.coalesce(F.col("_a") != F.col("_z"), F.lit(False))
    ).drop("_a", "_z")


def first_by_hash(docs: DataFrame, hash_col: str, order: Sequence[str], scope: Sequence[str] = ()) -> DataFrame:
    return keep_first(docs, [*scope, hash_col], order)
