"""Queries over grids, hashes, novelty, staging and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import cells as C
from holdsift.functions.hashing import idempotency_key
from holdsift.operators import grid as G
from holdsift.operators import novelty as N
from holdsift.operators import reports as P
from holdsift.operators import warehouse as W
from holdsift.operators.keys import keep_first
from holdsift.plans import inputs as I
from holdsift.plans import sqltext as S
from holdsift.plans.registry import query
from holdsift.session import shared_work
from holdsift.sources import files as SF
from holdsift.sources import registry as SR
from holdsift.sources.deltas import KeyedDeltas

AS_OF = "2026-07-01 00:00:00"
HEAD_A = ["ISIN Code", "Name of the Instrument", "Qty", "Market Value (Rs. in Lakhs)", "% to NAV", "Rating"]
HEAD_B = ["Sr", "ISIN", "Instrument", "Quantity", "Value", "% to NAV", "Rating", "Total"]


def grid(spark, sf):
    """Holdings stacked under a title row and a header row; every fourth document has the wider layout."""
    h = I.derive(spark, sf, I.HOLDINGS)
    wide = F.col("doc_id") % 4 == 1
    arr = lambda xs: F.array(*[F.lit(x).cast("string") for x in xs])
    base = ["isin", "instrument_name", "quantity", "market_value", "pct_to_net_assets", "rating"]
    row = F.struct((F.col("row_idx") + 1).alias("row_idx"), F.when(
        wide,
        F.array(F.col("row_idx").cast("string"), *base, F.concat(F.lit("7"), F.col("row_idx").cast("string"))),
    ).otherwise(F.array(*base)).alias("cells"))
    # the two rows on top come with the first holding, so that the holdings are read once
    top = [F.struct(F.lit(i).alias("row_idx"), cells.alias("cells")) for i, cells in enumerate([
        arr(["Monthly Portfolio Statement", None, "as on 30 June 2026", None, None, None]),
        F.when(wide, arr(HEAD_B)).otherwise(arr(HEAD_A)),
    ])]
    rows = h.select("doc_id", F.inline(F.when(F.col("row_idx") == 1, F.array(*top, row)).otherwise(F.array(row))))
    return rows.select(
        F.col("doc_id").cast("string").alias("doc_id"), F.lit(0).alias("table_id"), F.lit("Sheet1").alias("sheet_name"),
        F.lit(0).alias("sheet_idx"), "row_idx", "cells",
    )


def _hash_sql(head) -> str:
    items = ", ".join(S.q(h) for h in head)
    return (
        f"substr(sha256(array_to_string(list_sort(list_transform([{items}], lambda h: "
        "trim(regexp_replace(lower(h), '[^a-z0-9\\s%.]', '', 'g')))), '|')), 1, 16)"
    )


@query("grid_header", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 1 AS header_row_idx, count(*) + 2 AS grid_rows,
 CASE WHEN doc_id % 4 = 1 THEN 8 ELSE 6 END AS n_columns,
 CASE WHEN doc_id % 4 = 1 THEN 'isin,instrument_name,quantity,market_value,pct_to_net_assets,rating,market_value' ELSE 'isin,instrument_name,quantity,market_value,pct_to_net_assets,rating' END AS fields,
 CASE WHEN doc_id % 4 = 1 THEN {_hash_sql(HEAD_B)} ELSE {_hash_sql(HEAD_A)} END AS header_hash FROM ({S.HOLDINGS}) h GROUP BY doc_id""")
def grid_header(spark, sf):
    return G.header_rows(grid(spark, sf)).select(
        "doc_id", "header_row_idx", "grid_rows", F.size("column_names").alias("n_columns"),
        F.array_join(F.array_compact("mapped_fields"), ",").alias("fields"), "header_hash",
    )


@query("header_mapping", """
SELECT field, column_name, column_idx, count(DISTINCT doc_id) AS tables FROM (SELECT doc_id, unnest(
 CASE WHEN doc_id % 4 = 1 THEN ['isin','instrument_name','quantity','market_value','pct_to_net_assets','rating'] ELSE ['isin','instrument_name','quantity','market_value','pct_to_net_assets','rating'] END) AS field,
 unnest(CASE WHEN doc_id % 4 = 1 THEN ['ISIN','Instrument','Quantity','Value','% to NAV','Rating'] ELSE ['ISIN Code','Name of the Instrument','Qty','Market Value (Rs. in Lakhs)','% to NAV','Rating'] END) AS column_name,
 unnest(CASE WHEN doc_id % 4 = 1 THEN [1,2,3,4,5,6] ELSE [0,1,2,3,4,5] END) AS column_idx FROM (SELECT DISTINCT l_orderkey AS doc_id FROM lineitem) d) t GROUP BY ALL""")
def header_mapping(spark, sf):
    h = G.header_rows(grid(spark, sf), "pdf")
    return G.column_mapping(h).groupBy("field", "column_name", "column_idx").agg(
        F.countDistinct("doc_id").alias("tables")
    )


def _num(v: str, dialect: str) -> tuple[str, str]:
    t = S.clean_number(v)
    empty = S.in_list(R.EMPTY_NUMBERS[dialect])
    n = f"CASE WHEN {t} NOT IN {empty} THEN {S.number(t)} END"
    return n, f"CASE WHEN {t} NOT IN {empty} AND ({n}) IS NULL THEN trim({v}) END"


def rows_sql(dialect: str) -> str:
    if dialect == "excel":
        nn = lambda c: f"CASE WHEN {c} NOT IN {S.in_list(R.NULL_MARKERS + R.NULL_MARKERS_LIBRARY)} THEN {c} END"
        pre = (
            f"SELECT doc_id, row_idx, upper(nullif(trim({nn('isin')}), '')) AS isin, nullif(trim({nn('instrument_name')}), '') AS instrument_name, {nn('quantity')} AS q, "
            f"coalesce({nn('market_value')}, CASE WHEN doc_id % 4 = 1 THEN '7' || CAST(row_idx AS VARCHAR) END) AS mv, {nn('pct_to_net_assets')} AS p, nullif(trim({nn('rating')}), '') AS rating FROM ({S.HOLDINGS}) h"
        )
    else:
        pre = f"SELECT doc_id, row_idx, trim(isin) AS isin, trim(instrument_name) AS instrument_name, quantity AS q, market_value AS mv, pct_to_net_assets AS p, trim(rating) AS rating FROM ({S.HOLDINGS}) h"
    (qn, qr), (mn, mr), (pn, pr) = _num("q", dialect), _num("mv", dialect), _num("p", dialect)
    return f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, row_idx - 1 AS row_idx, isin, instrument_name, rating, {qn} AS quantity, {qr} AS quantity_raw, {mn} AS market_value, {mr} AS market_value_raw, {pn} AS pct_to_net_assets FROM ({pre}) x
WHERE (CASE WHEN isin IS NULL THEN 0 ELSE 1 END + CASE WHEN instrument_name IS NULL THEN 0 ELSE 1 END + CASE WHEN rating IS NULL THEN 0 ELSE 1 END + CASE WHEN coalesce(CAST({qn} AS VARCHAR), {qr}) IS NULL THEN 0 ELSE 1 END
 + CASE WHEN coalesce(CAST({mn} AS VARCHAR), {mr}) IS NULL THEN 0 ELSE 1 END + CASE WHEN coalesce(CAST({pn} AS VARCHAR), {pr}) IS NULL THEN 0 ELSE 1 END) >= 2"""


_ROW_COLS = ["doc_id", "row_idx", "isin", "instrument_name", "rating", "quantity", "quantity_raw", "market_value",
             "market_value_raw", "pct_to_net_assets"]


@query("grid_rows", rows_sql("excel"))
def grid_rows(spark, sf):
    return G.holding_rows(grid(spark, sf)).select(*_ROW_COLS)


@query("grid_rows_pdf", rows_sql("pdf"))
def grid_rows_pdf(spark, sf):
    return G.holding_rows(grid(spark, sf), "pdf").select(*_ROW_COLS)


@query("grid_header_text", f"""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, ' Monthly Portfolio Statement as on 30 June 2026 ' || CASE WHEN doc_id % 4 = 1 THEN {S.q(' '.join(HEAD_B))} ELSE {S.q(' '.join(HEAD_A))} END || coalesce(' ' || string_agg(
 concat_ws(' ', CASE WHEN doc_id % 4 = 1 THEN CAST(row_idx AS VARCHAR) END, isin, instrument_name, quantity, market_value, pct_to_net_assets, rating, CASE WHEN doc_id % 4 = 1 THEN '7' || CAST(row_idx AS VARCHAR) END), ' ' ORDER BY row_idx) FILTER (row_idx < 9), '') || chr(10) || '[Sheet: Sheet1]' || chr(10) AS header_text
FROM ({S.HOLDINGS}) h GROUP BY doc_id""")
def grid_header_text(spark, sf):
    return G.header_text(grid(spark, sf)).select("doc_id", "header_text")


@query("pct_total_check", f"""
SELECT doc_id, count(*) AS row_count, round(coalesce(sum(pct_to_net_assets), 0), 4) AS pct_total, coalesce(sum(pct_to_net_assets), 0) > 0 AND NOT round(coalesce(sum(pct_to_net_assets), 0), 9) BETWEEN 80 AND 102 AS pct_violation FROM ({rows_sql('excel')}) r GROUP BY doc_id""")
def pct_total_check(spark, sf):
    t = G.pct_totals(G.holding_rows(grid(spark, sf)))
    return t.select("doc_id", "row_count", F.round("pct_total", 4).alias("pct_total"), "pct_violation")


@query("isin_flags", f"""
SELECT isin_up AS isin, count(*) AS row_count, bool_and(len(isin_up) = 12) AS length_ok, bool_and(regexp_matches(isin_up, {S.q(R.ISIN_SHAPE)})) AS shape_ok FROM (SELECT upper(trim(isin)) AS isin_up FROM ({S.HOLDINGS}) h) t GROUP BY isin_up""")
def isin_flags(spark, sf):
    h = I.derive(spark, sf, I.HOLDINGS).withColumn("isin", C.clean_isin(F.col("isin")))
    return h.groupBy("isin").agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and(C.isin_length_ok(F.col("isin"))).alias("length_ok"),
        F.bool_and(C.isin_shape_ok(F.col("isin"))).alias("shape_ok"),
    )


@query("publish_numbers", f"""
SELECT doc_id, row_idx, {S.number("trim(replace(quantity, ',', ''))")} AS quantity, {S.number("trim(replace(market_value, ',', ''))")} AS market_value FROM ({S.HOLDINGS}) h""")
def publish_numbers(spark, sf):
    return I.derive(spark, sf, I.HOLDINGS).select(
        "doc_id", "row_idx", *[C.publish_number(F.col(c)).alias(c) for c in ("quantity", "market_value")]
    )


@query("clean_rows_json", f"""
SELECT doc_id, row_idx, '{{' || concat_ws(',', CASE WHEN isin IS NOT NULL THEN '"isin":"' || isin || '"' END, CASE WHEN instrument_name IS NOT NULL THEN '"instrument_name":"' || instrument_name || '"' END,
 CASE WHEN rating IS NOT NULL THEN '"rating":"' || rating || '"' END) || '}}' AS clean_data FROM ({S.HOLDINGS}) h""")
def clean_rows_json(spark, sf):
    h = I.derive(spark, sf, I.HOLDINGS)
    return G.to_clean_json(h, ["isin", "instrument_name", "rating"]).select("doc_id", "row_idx", "clean_data")


@query("extract_dispatch", f"""
SELECT CASE WHEN file_type = 'pdf' THEN 'pdf' WHEN file_type IN ('xlsx', 'xls') THEN 'sheet' ELSE 'error' END AS route,
 CASE WHEN file_type NOT IN ('pdf', 'xlsx', 'xls') THEN 'Extraction error: Unsupported file type: ' || file_type END AS last_error, count(*) AS documents FROM ({S.DOCS}) d GROUP BY ALL""")
def extract_dispatch(spark, sf):
    pdf, sheets, bad = G.split_by_type(I.derive(spark, sf, I.DOCS).select("doc_id", "file_type"))
    none = F.lit(None).cast("string")
    routed = (
        pdf.select(F.lit("pdf").alias("route"), none.alias("last_error"))
        .unionByName(sheets.select(F.lit("sheet").alias("route"), none.alias("last_error")))
        .unionByName(bad.select(F.lit("error").alias("route"), "last_error"))
    )
    return routed.groupBy("route", "last_error").agg(F.count(F.lit(1)).alias("documents"))


# ---------------------------------------------------------------------------
# Sources
# ---------------------------------------------------------------------------
def _source_values() -> str:
    return ", ".join(f"({S.q(s['source_key'])}, {S.q(s['amc_name'])}, {S.q(s['strategy'])})" for s in R.SOURCES)


@query("source_sync", f"""
WITH have AS (SELECT 'house_' || CAST(s_suppkey AS VARCHAR) AS source_key, s_name AS amc_name, 'link_extraction' AS strategy FROM supplier UNION ALL SELECT 'hdfc_mf', 'Renamed House', 'api_intercept'),
reg AS (SELECT * FROM (VALUES {_source_values()}) v(source_key, amc_name, strategy))
SELECT * FROM have UNION ALL SELECT * FROM reg WHERE source_key NOT IN (SELECT source_key FROM have)""")
def source_sync(spark, sf):
    have = I.table(spark, sf, "supplier").select(
        F.concat(F.lit("house_"), F.col("s_suppkey").cast("string")).alias("source_key"), F.col("s_name").alias("amc_name"),
        F.lit("link_extraction").alias("strategy"),
    ).unionByName(spark.createDataFrame([("hdfc_mf", "Renamed House", "api_intercept")], "source_key string, amc_name string, strategy string"))
    return SR.sync_sources(have, SR.sources(spark).select("source_key", "amc_name", "strategy"))


@query("landed_files")
def landed_files(spark, sf):
    f = SF.with_content_path(SF.landed_files(spark, sf, "*.parquet"))
    return f.select("filename", "file_type", "file_size_bytes", "file_hash_sha256", "content_path",
                    P.human_bytes(F.col("file_size_bytes")).alias("size_label"))


@query("integrity_check")
def integrity_check(spark, sf):
    f = SF.with_content_path(SF.landed_files(spark, sf, "*.parquet"))
    # claim a wrong name for one file
    f = f.withColumn("content_path", F.when(F.col("filename") == "part.parquet", F.regexp_replace("content_path", "^..", "zz")).otherwise(F.col("content_path")))
    return SF.integrity(f, "content_path").select("filename", "intact")


# ---------------------------------------------------------------------------
# Hashes and novelty
# ---------------------------------------------------------------------------
_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_CONTENT = f"sha256(trim(regexp_replace(lower(text), {S.q(_WS)}, ' ', 'g')))"


@query("content_hash", f"SELECT doc_id, {_CONTENT} AS content_hash FROM documents")
def content_hash(spark, sf):
    return N.with_content_hash(I.table(spark, sf, "documents")).select("doc_id", "content_hash")


def _dups_sql(scope: str) -> str:
    return f"""
WITH h AS (SELECT doc_id, source, {_CONTENT} AS ch FROM documents), f AS (SELECT *, min(doc_id) OVER (PARTITION BY ch{scope}) AS first_doc_id, count(*) OVER (PARTITION BY ch{scope}) AS copies FROM h)
SELECT doc_id, first_doc_id, copies, first_doc_id <> doc_id AS is_duplicate FROM f"""


@query("content_duplicates", _dups_sql(""))
def content_duplicates(spark, sf):
    d = N.with_content_hash(I.table(spark, sf, "documents")).select("doc_id", "source", "content_hash")
    return N.duplicates_in_batch(d, "content_hash", ["doc_id"], scope=None).select("doc_id", "first_doc_id", "copies", "is_duplicate")


@query("content_duplicates_by_source", _dups_sql(", source"))
def content_duplicates_by_source(spark, sf):
    d = N.with_content_hash(I.table(spark, sf, "documents")).select("doc_id", "source", "content_hash")
    return N.duplicates_in_batch(d, "content_hash", ["doc_id"], scope="source").select("doc_id", "first_doc_id", "copies", "is_duplicate")


SEEN = """
SELECT o_orderkey AS doc_id, CAST(o_custkey % 3 AS INT) AS source_id, sha2(concat('u', CAST(o_orderkey % 7000 AS STRING)), 256) AS url_fingerprint,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE sha2(concat('f', CAST(o_orderkey % 9000 AS STRING)), 256) END AS file_hash_sha256,
 CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE sha2(concat('c', CAST(o_orderkey % 11000 AS STRING)), 256) END AS content_hash,
 CASE o_orderstatus WHEN 'F' THEN 'PUBLISHED' WHEN 'O' THEN 'QUARANTINED' ELSE CASE o_orderkey % 3 WHEN 0 THEN 'FAILED' ELSE 'CLASSIFIED' END END AS status,
 o_orderdate AS discovered_at, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS is_old
FROM {orders}
"""
SEEN_SQL = I.duck(SEEN)
_LEDGER = f"s AS ({SEEN_SQL}), l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_id, url_fingerprint ORDER BY doc_id) AS rn FROM s WHERE is_old = 1) t WHERE rn = 1), n AS (SELECT * FROM s WHERE is_old = 0)"


def _seen(spark, sf):
    s = I.derive(spark, sf, SEEN)
    ledger = keep_first(s.filter("is_old = 1"), ["source_id", "url_fingerprint"], ["doc_id"])
    return ledger, s.filter("is_old = 0")


@query("novelty_cascade", f"""
WITH {_LEDGER}, j AS (SELECT n.doc_id, l.status AS known, EXISTS (SELECT 1 FROM l f WHERE f.source_id = n.source_id AND f.file_hash_sha256 = n.file_hash_sha256) AS fs,
 EXISTS (SELECT 1 FROM l f WHERE f.source_id = n.source_id AND f.content_hash = n.content_hash) AS cs FROM n LEFT JOIN l ON n.source_id = l.source_id AND n.url_fingerprint = l.url_fingerprint),
r AS (SELECT doc_id, CASE WHEN known IN ('PUBLISHED', 'VALIDATED') THEN 'url_seen:status=' || known WHEN known IN ('FAILED', 'QUARANTINED') THEN 'retry:previous_status=' || known
 WHEN fs THEN 'file_hash_duplicate' WHEN cs THEN 'content_hash_duplicate' ELSE 'novel' END AS novelty_reason FROM j)
SELECT doc_id, novelty_reason, novelty_reason = 'novel' OR starts_with(novelty_reason, 'retry') AS is_novel FROM r""")
def novelty_cascade(spark, sf):
    ledger, new = _seen(spark, sf)
    return N.novelty_cascade(new, ledger).select("doc_id", "novelty_reason", "is_novel")


@query("url_gate", f"""
WITH {_LEDGER} SELECT n.doc_id, l.status IS NULL AS url_is_novel FROM n LEFT JOIN l ON n.source_id = l.source_id AND n.url_fingerprint = l.url_fingerprint
WHERE l.status IS NULL OR l.status NOT IN {S.in_list(R.SETTLED_STATUSES)}""")
def url_gate(spark, sf):
    ledger, new = _seen(spark, sf)
    return N.known_urls(N.not_settled(new, ledger), ledger).select("doc_id", "url_is_novel")


@query("file_duplicates", f"""
WITH s AS ({SEEN_SQL}) SELECT doc_id, EXISTS (SELECT 1 FROM s o WHERE o.source_id = s.source_id AND o.file_hash_sha256 = s.file_hash_sha256 AND o.doc_id <> s.doc_id) AS file_seen,
 CASE WHEN EXISTS (SELECT 1 FROM s o WHERE o.source_id = s.source_id AND o.file_hash_sha256 = s.file_hash_sha256 AND o.doc_id <> s.doc_id) THEN 'PUBLISHED' ELSE status END AS status FROM s""")
def file_duplicates(spark, sf):
    s = I.derive(spark, sf, SEEN)
    return N.mark_file_duplicates(s, s).select("doc_id", "file_seen", "status")


_UPSERTED = f"""
WITH {_LEDGER}, g AS (SELECT source_id, url_fingerprint, count(*) AS cnt, min(doc_id) AS first_id, arg_max(status, doc_id) AS last_status,
 arg_max(file_hash_sha256, doc_id) FILTER (file_hash_sha256 IS NOT NULL) AS fh, arg_max(content_hash, doc_id) FILTER (content_hash IS NOT NULL) AS ch FROM n GROUP BY 1, 2)
SELECT coalesce(l.source_id, g.source_id) AS source_id, coalesce(l.url_fingerprint, g.url_fingerprint) AS url_fingerprint, coalesce(l.doc_id, g.first_id) AS doc_id,
 CASE WHEN g.cnt IS NULL THEN l.status ELSE g.last_status END AS status, coalesce(g.fh, l.file_hash_sha256) AS file_hash_sha256, coalesce(g.ch, l.content_hash) AS content_hash,
 CAST(CASE WHEN l.doc_id IS NOT NULL THEN coalesce(g.cnt, 0) ELSE g.cnt - 1 END AS INT) AS download_attempts
FROM l FULL OUTER JOIN g ON l.source_id = g.source_id AND l.url_fingerprint = g.url_fingerprint"""


@query("ledger_upsert", _UPSERTED)
def ledger_upsert(spark, sf):
    ledger, new = _seen(spark, sf)
    ledger = ledger.withColumn("download_attempts", F.lit(0))
    return N.ledger_upsert(ledger, new, AS_OF, ["doc_id"]).select(
        "source_id", "url_fingerprint", "doc_id", "status", "file_hash_sha256", "content_hash", "download_attempts"
    )


@query("ledger_stored", _UPSERTED)
def ledger_stored(spark, sf):
    """The ledger kept as deltas: what was known, then the new documents in three runs, each reading and writing its own."""
    ledger, new = _seen(spark, sf)
    schema = ("source_id int, url_fingerprint string, doc_id bigint, status string, file_hash_sha256 string, content_hash string, "
              "download_attempts int")
    store = KeyedDeltas(spark, f"{shared_work(spark)}/ledger", schema, ["source_id", "url_fingerprint"], buckets=8)
    store.write("known", lambda _: ledger.withColumn("download_attempts", F.lit(0)))
    lo, hi = new.agg(F.min("doc_id"), F.max("doc_id")).first()
    third = F.least(F.floor((F.col("doc_id") - F.lit(lo)) * 3 / F.lit(max((hi or 0) - (lo or 0), 1))), F.lit(2))
    for i in range(3):
        part = new.filter(third == i)
        store.write(f"run-{i}", lambda head, part=part: N.ledger_upsert(store.read(head, part), part, AS_OF, ["doc_id"]))
    return store.read()


@query("data_hash", f"""
WITH r AS (SELECT doc_id, row_idx, isin, instrument_name, rating FROM ({S.HOLDINGS}) h),
c AS (SELECT doc_id, row_idx, sha256(concat_ws(chr(31), CASE WHEN instrument_name IS NOT NULL THEN 'instrument_name={{"v":"' || instrument_name || '"}}' END,
 CASE WHEN isin IS NOT NULL THEN 'isin={{"v":"' || isin || '"}}' END, CASE WHEN rating IS NOT NULL THEN 'rating={{"v":"' || rating || '"}}' END)) AS h FROM r),
b AS (SELECT doc_id, floor(row_idx / 4096) AS blk, sha256(string_agg(h, '|' ORDER BY row_idx)) AS bh, count(*) AS n FROM c GROUP BY 1, 2)
SELECT doc_id, sha256(string_agg(bh, '|' ORDER BY blk)) AS data_hash, CAST(sum(n) AS BIGINT) AS row_count FROM b GROUP BY doc_id""")
def data_hash(spark, sf):
    h = I.derive(spark, sf, I.HOLDINGS)
    return N.data_hashes(h, ["doc_id"], "row_idx", ["isin", "instrument_name", "rating"])


@query("idempotency_keys", """
SELECT o_orderkey AS doc_id, sha256(concat_ws('|', 'src_' || CAST(o_custkey % 3 AS VARCHAR), CAST(coalesce(CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE year(o_orderdate) + 25 END, 0) AS VARCHAR),
 CAST(month(o_orderdate) AS VARCHAR), coalesce(nullif(CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'Scheme ' || CAST(o_custkey % 11 AS VARCHAR) END, ''), 'unknown'), sha256(CAST(o_totalprice * 100 AS BIGINT)::VARCHAR))) AS idempotency_key FROM orders""")
def idempotency_keys(spark, sf):
    o = I.table(spark, sf, "orders")
    key = idempotency_key(
        F.concat(F.lit("src_"), (F.col("o_custkey") % 3).cast("string")),
        F.expr("CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE year(o_orderdate) + 25 END"), F.month("o_orderdate"),
        F.expr("CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('Scheme ', CAST(o_custkey % 11 AS STRING)) END"),
        F.sha2(F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"), 256),
    )
    return o.select(F.col("o_orderkey").alias("doc_id"), key.alias("idempotency_key"))


@query("version_decision", f"""
WITH {_LEDGER}, i AS (SELECT source_id, url_fingerprint, arg_max(doc_id, doc_id) AS doc_id, arg_max(coalesce(content_hash, ''), doc_id) AS ch FROM n GROUP BY 1, 2)
SELECT i.doc_id, CASE WHEN l.doc_id IS NULL THEN 'insert' WHEN coalesce(l.content_hash, '') = i.ch THEN 'skip' ELSE 'new_version' END AS outcome
FROM i LEFT JOIN l ON i.source_id = l.source_id AND i.url_fingerprint = l.url_fingerprint""")
def version_decision(spark, sf):
    ledger, new = _seen(spark, sf)
    ledger, new = (d.withColumn("content_hash", F.coalesce("content_hash", F.lit(""))) for d in (ledger, new))
    return N.version_decision(ledger, new, ["source_id", "url_fingerprint"], order=["doc_id"]).select("doc_id", "outcome")


# ---------------------------------------------------------------------------
# Staging and publishing
# ---------------------------------------------------------------------------
STAGE = """
SELECT CAST(o_orderkey AS STRING) AS document_id, o_orderkey AS doc_ord, sha2(concat('k', CAST(o_orderkey % 6000 AS STRING)), 256) AS idempotency_key,
 sha2(concat('c', CAST(o_orderkey % 9000 AS STRING)), 256) AS content_hash, CAST(o_orderkey % 50 AS INT) AS row_count, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS is_old
FROM {orders}
"""
STAGE_SQL = I.duck(STAGE)
_OLD = "s AS (" + STAGE_SQL + "), o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY doc_ord) AS rn FROM s WHERE is_old = 1) t WHERE rn = 1)"


def _staged(spark, sf):
    s = I.derive(spark, sf, STAGE)
    return keep_first(s.filter("is_old = 1").drop("is_old"), [W.KEY], ["doc_ord"]), s.filter("is_old = 0").drop("is_old")


@query("stage_insert", f"""
WITH {_OLD}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY doc_ord) AS rn FROM s WHERE is_old = 0) t WHERE rn = 1 AND idempotency_key NOT IN (SELECT idempotency_key FROM o))
SELECT idempotency_key, document_id, row_count FROM o UNION ALL SELECT idempotency_key, document_id, row_count FROM n""")
def stage_insert(spark, sf):
    old, new = _staged(spark, sf)
    return W.stage_insert(old, new, ["doc_ord"]).select(W.KEY, "document_id", "row_count")


@query("stage_upsert", f"""
WITH {_OLD}, n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY doc_ord DESC) AS rn FROM s WHERE is_old = 0) t WHERE rn = 1)
SELECT coalesce(o.idempotency_key, n.idempotency_key) AS idempotency_key, CASE WHEN o.content_hash IS NULL OR o.content_hash <> n.content_hash THEN n.document_id ELSE o.document_id END AS document_id,
 CASE WHEN o.content_hash IS NULL OR o.content_hash <> n.content_hash THEN n.content_hash ELSE o.content_hash END AS content_hash, coalesce(o.content_hash IS NULL OR o.content_hash <> n.content_hash, false) AS touched
FROM o FULL OUTER JOIN n ON o.idempotency_key = n.idempotency_key""")
def stage_upsert(spark, sf):
    old, new = _staged(spark, sf)
    old = old.withColumn("updated_at", F.lit("2020-01-01").cast("timestamp"))
    got = W.stage_upsert(old, new, AS_OF, ["doc_ord"])
    return got.select(W.KEY, "document_id", "content_hash", (F.year("updated_at") == 2026).alias("touched"))


@query("validate_rows", f"""
SELECT doc_id, count(*) AS row_count, sum(CASE WHEN i IS NULL AND instrument_name IS NULL THEN 1 ELSE 0 END) AS warning_count, sum(CASE WHEN market_value = 'nil' THEN 1 ELSE 0 END) AS error_count,
 CASE WHEN sum(CASE WHEN market_value = 'nil' THEN 1 ELSE 0 END) = 0 THEN 'PASSED' ELSE 'FAILED' END AS validation_status FROM (SELECT *, nullif(isin, '') AS i FROM ({S.HOLDINGS}) h) t GROUP BY doc_id""", warning_count="BIGINT", error_count="BIGINT")
def validate_rows(spark, sf):
    h = I.derive(spark, sf, I.HOLDINGS).withColumn("isin", F.nullif(F.col("isin"), F.lit("")))
    v = W.validate_rows(h, {"market value is no number": F.col("market_value") == "nil"})
    return W.validation_summary(v, ["doc_id"]).select("doc_id", "row_count", "warning_count", "error_count", "validation_status")


@query("publishable_rows", f"""
WITH h AS ({S.HOLDINGS}), bad AS (SELECT DISTINCT doc_id FROM h WHERE market_value = 'nil')
SELECT doc_id, count(*) AS row_count FROM h WHERE doc_id NOT IN (SELECT doc_id FROM bad) GROUP BY doc_id""")
def publishable_rows(spark, sf):
    h = I.derive(spark, sf, I.HOLDINGS)
    v = W.validate_rows(h, {"market value is no number": F.col("market_value") == "nil"})
    ok = W.publishable(v, W.validation_summary(v, ["doc_id"]), ["doc_id"])
    return ok.groupBy("doc_id").agg(F.count(F.lit(1)).alias("row_count"))


PUB = f"""
SELECT CAST(doc_id AS STRING) AS document_id, doc_id AS doc_ord, row_idx, isin, instrument_name, CAST(NULL AS STRING) AS instrument_type, CAST(NULL AS STRING) AS industry, quantity, market_value, pct_to_net_assets, rating,
 CASE doc_id % 4 WHEN 0 THEN 'SBI Mutual Fund' WHEN 1 THEN 'HDFC Mutual Fund' WHEN 2 THEN 'Nippon India Mutual Fund' ELSE '' END AS amc_name,
 CASE WHEN doc_id % 7 = 0 THEN NULL ELSE concat('Scheme ', CAST(doc_id % 7 AS STRING)) END AS scheme_name, 'equity' AS scheme_category,
 CAST(doc_id % 12 + 1 AS INT) AS period_month, CAST(2024 AS INT) AS period_year FROM ({I.HOLDINGS}) h
"""
PUB_SQL = I.duck(PUB)
_BAD = "p AS (SELECT *, coalesce(nullif(amc_name, ''), 'Unknown AMC') AS amc, coalesce(scheme_name, 'Unknown Scheme') AS sch FROM (" + PUB_SQL + ") x)"
_KEYED = (
    _BAD + ", k AS (SELECT *, sha256(concat_ws('|', amc, sch, CAST(period_year AS VARCHAR), CAST(period_month AS VARCHAR), coalesce(nullif(isin, ''), nullif(instrument_name, ''), 'row_' || CAST(row_idx AS VARCHAR)))) AS idempotency_key, "
    "CASE WHEN doc_ord % 2 = 0 THEN 1 ELSE 2 END AS batch, " + S.number("trim(replace(quantity, ',', ''))") + " AS q, " + S.number("trim(replace(market_value, ',', ''))") + " AS mv, "
    + S.number("trim(replace(pct_to_net_assets, ',', ''))") + " AS pct FROM p)"
)
_FOLD = (
    _KEYED + ", r AS (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY batch, doc_ord, row_idx) AS up, row_number() OVER (PARTITION BY idempotency_key ORDER BY batch DESC, doc_ord DESC, row_idx DESC) AS down, "
    "count(*) OVER (PARTITION BY idempotency_key) AS n FROM k), f AS (SELECT a.idempotency_key, a.document_id, a.amc, a.sch, a.isin, a.period_month, z.q, z.mv, z.pct, z.rating, CAST(a.n AS INT) AS version "
    "FROM r a JOIN r z ON a.idempotency_key = z.idempotency_key AND a.up = 1 AND z.down = 1)"
)
ORDER = ["doc_ord", "row_idx"]


def _batches(spark, sf):
    p = W.publish_rows(I.derive(spark, sf, PUB))
    return p.filter(F.col("doc_ord") % 2 == 0), p.filter(F.col("doc_ord") % 2 != 0)


def published(spark, sf):
    """Two batches upserted one after the other."""
    one, two = _batches(spark, sf)
    return W.publish_upsert(W.publish_upsert(W.empty_published(spark), one, ORDER, AS_OF), two, ORDER, AS_OF)


@query("publish_upsert", f"WITH {_FOLD} SELECT idempotency_key, document_id, amc AS amc_name, sch AS scheme_name, isin, q AS quantity, mv AS market_value, pct AS pct_to_net_assets, rating, version FROM f")
def publish_upsert(spark, sf):
    return published(spark, sf).select(
        "idempotency_key", "document_id", "amc_name", "scheme_name", "isin", "quantity", "market_value", "pct_to_net_assets", "rating", "version"
    )


@query("published_top", f"""
WITH {_FOLD} SELECT idempotency_key, scheme_name, isin, pct_to_net_assets, market_value, version FROM (SELECT idempotency_key, sch AS scheme_name, isin, pct AS pct_to_net_assets, mv AS market_value, version FROM f
WHERE amc = 'HDFC Mutual Fund' AND sch ILIKE '%scheme%') t ORDER BY pct_to_net_assets DESC NULLS LAST, market_value DESC NULLS LAST, idempotency_key LIMIT 100 OFFSET 25""")
def published_top(spark, sf):
    return P.published_top(published(spark, sf), "HDFC Mutual Fund", "scheme", 100, 25).select(
        "idempotency_key", "scheme_name", "isin", "pct_to_net_assets", "market_value", "version"
    )


@query("publish_stored", f"WITH {_FOLD} SELECT idempotency_key, CAST(q AS DECIMAL(20,4)) AS quantity, CAST(mv AS DECIMAL(20,4)) AS market_value, CAST(pct AS DECIMAL(8,4)) AS pct_to_net_assets FROM f")
def publish_stored(spark, sf):
    return W.stored_types(published(spark, sf)).select("idempotency_key", "quantity", "market_value", "pct_to_net_assets")


@query("publish_history", f"WITH {_KEYED}, r AS (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY batch, doc_ord, row_idx) AS v, count(*) OVER (PARTITION BY idempotency_key) AS n FROM k) SELECT idempotency_key, document_id, q AS quantity, rating, CAST(v AS INT) AS version, v = n AS is_current FROM r")
def publish_history(spark, sf):
    one, two = _batches(spark, sf)
    bucket = F.floor(F.col("doc_ord") / 5000)
    h = W.publish_history(W.empty_published(spark), one, ORDER, bucket, AS_OF)
    h = W.publish_history(h, two, ORDER, bucket, AS_OF)
    return h.select("idempotency_key", "document_id", "quantity", "rating", "version", "is_current")


@query("status_final", f"""
SELECT status, last_error, count(*) AS documents FROM (SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'FAILED' WHEN o_orderkey % 11 = 0 THEN 'PUBLISHED' WHEN o_orderkey % 7 = 0 THEN 'QUARANTINED' WHEN o_orderkey % 3 = 2 THEN 'FAILED'
 WHEN o_orderkey % 5 > 0 THEN 'PUBLISHED' WHEN o_orderkey % 2 = 0 THEN 'VALIDATED' ELSE 'EXTRACTED' END AS status,
 CASE WHEN o_orderkey % 13 = 0 THEN 'download failed' WHEN o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 2 THEN 'Extraction error: Unsupported file type: zip' END AS last_error FROM orders) t GROUP BY ALL""")
def status_final(spark, sf):
    k = F.col("o_orderkey")
    o = I.table(spark, sf, "orders").select(
        (k % 13 != 0).alias("downloaded"), (k % 11 == 0).alias("file_seen"), (k % 7 == 0).alias("is_quarantined"), (k % 3 != 2).alias("type_supported"),
        F.lit(True).alias("extracted"), F.when(k % 2 == 0, 1).alias("staged_tables"), (k % 5).alias("published_tables"), F.lit("zip").alias("file_type"),
    )
    return W.final_status(o).groupBy("status", "last_error").agg(F.count(F.lit(1)).alias("documents"))


@query("status_audit", f"""
WITH d AS (SELECT o_orderkey AS doc_id, CASE o_orderkey % 6 WHEN 0 THEN 'PUBLISHED' WHEN 1 THEN 'VALIDATED' WHEN 2 THEN 'QUARANTINED' WHEN 3 THEN 'LOST' WHEN 4 THEN 'FAILED' ELSE 'STAGED' END AS status,
  o_orderkey % 4 <> 0 AS s, EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AS p FROM orders)
SELECT doc_id, problem FROM (SELECT doc_id, CASE WHEN status = 'LOST' THEN 'UNKNOWN_STATUS' WHEN status = 'PUBLISHED' AND NOT p THEN 'PUBLISHED_WITHOUT_ROWS' WHEN status IN ('STAGED', 'VALIDATED') AND NOT s THEN 'STAGED_WITHOUT_ROWS'
 WHEN status = 'QUARANTINED' AND p THEN 'PUBLISHED_ROWS_BEHIND_STATUS' END AS problem FROM d) t WHERE problem IS NOT NULL""")
def status_audit(spark, sf):
    o = I.table(spark, sf, "orders")
    docs = o.select(
        F.col("o_orderkey").alias("doc_id"),
        F.expr("CASE o_orderkey % 6 WHEN 0 THEN 'PUBLISHED' WHEN 1 THEN 'VALIDATED' WHEN 2 THEN 'QUARANTINED' WHEN 3 THEN 'LOST' WHEN 4 THEN 'FAILED' ELSE 'STAGED' END").alias("status"),
    )
    staged = o.filter("o_orderkey % 4 <> 0").select(F.col("o_orderkey").alias("document_id"))
    pub = I.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("document_id"))
    return W.status_audit(docs, staged, pub).select("doc_id", "problem")


def _counted(words):
    """Each word once, with its number: a word that stands in most documents meets the word list as one row."""
    return words.groupBy(*words.columns).agg(F.count(F.lit(1)).alias("documents"))


@query("scheme_names_seen", """
WITH d AS (SELECT lower(sheet2) AS n FROM (""" + S.DOCS + """) x), c AS (SELECT * FROM (VALUES """ + ", ".join(
    f"({i}, {a}, {S.q(s.scheme_name)}, {S.q(s.category)}, {S.q(c)})" for i, s in enumerate(R.SCHEME_MASTER) for a, c in enumerate([s.scheme_name, *s.aliases])
) + """) v(scheme_ord, alias_ord, scheme_name, category, candidate))
SELECT scheme_name, category, candidate, alias_ord, count(*) AS documents FROM d JOIN c ON n = lower(candidate) GROUP BY ALL""")
def scheme_names_seen(spark, sf):
    """Documents per candidate spelling of the scheme master."""
    names = SR.scheme_candidates(SR.scheme_master(spark)).withColumn("n", F.lower("candidate"))
    d = _counted(I.derive(spark, sf, I.DOCS).select(F.lower("sheet2").alias("n")))
    return d.join(names, "n").groupBy("scheme_name", "category", "candidate", "alias_ord").agg(
        F.sum("documents").alias("documents")
    )


@query("month_words_seen", r"""
WITH t AS (SELECT unnest(regexp_split_to_array(lower(filename), '[_\-\s.]+')) AS w FROM (""" + S.DOCS + r""") x)
SELECT w AS word, month, count(*) AS documents FROM t JOIN (VALUES """ + ", ".join(f"({S.q(w)}, {n})" for w, n in R.MONTH_WORDS) + """) v(word, month) ON w = word GROUP BY w, month""")
def month_words_seen(spark, sf):
    words = SR.month_words(spark)
    t = I.derive(spark, sf, I.DOCS).select(F.explode(F.split(F.lower("filename"), r"[_\-\s.]+")).alias("word"))
    return _counted(t).join(words, "word").groupBy("word", "month").agg(F.sum("documents").alias("documents"))


@query("category_words_seen", r"""
WITH c AS (SELECT * FROM (VALUES """ + ", ".join(f"({S.q(k)}, {S.q(v)})" for k, vs in R.CATEGORY_TAXONOMY.items() for v in vs) + r""") v(category, subcategory)),
t AS (SELECT unnest(string_split(lower(sheet2), ' ')) AS w FROM (""" + S.DOCS + r""") x)
SELECT category, subcategory, count(*) AS documents FROM t JOIN c ON w = subcategory GROUP BY category, subcategory""")
def category_words_seen(spark, sf):
    c = SR.categories(spark)
    t = I.derive(spark, sf, I.DOCS).select(F.explode(F.split(F.lower("sheet2"), " ")).alias("subcategory"))
    return _counted(t).join(c, "subcategory").groupBy("category", "subcategory").agg(F.sum("documents").alias("documents"))
