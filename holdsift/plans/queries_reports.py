"""Queries over drift, review, reports and runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions.fusion import SIGNALS
from holdsift.operators import drift as D
from holdsift.operators import lifecycle as L
from holdsift.operators import reports as P
from holdsift.operators import review as V
from holdsift.operators import warehouse as W
from holdsift.plans import inputs as I
from holdsift.plans import sqltext as S
from holdsift.plans.queries_tables import ORDER, PUB, PUB_SQL, SEEN, SEEN_SQL, published
from holdsift.plans.registry import query
from holdsift.sources import registry as SR

AS_OF = "2026-07-01 00:00:00"


def staged(spark, sf):
    """(staged history, current batch) of table metadata."""
    s = I.derive(spark, sf, I.STAGED).withColumn("column_names", F.split("columns_csv", ","))
    return s.filter("is_old = 1"), s.filter("is_old = 0")


# ---------------------------------------------------------------------------
# Drift
# ---------------------------------------------------------------------------
@query("drift_page", f"""
WITH c AS ({S.CRAWLS}), now AS (SELECT source_id, arg_max(page_structure_hash, event_id) AS h FROM c GROUP BY source_id), base AS (SELECT source_id, CASE source_id WHEN 0 THEN NULL ELSE arg_min(page_structure_hash, event_id) END AS h FROM c GROUP BY source_id)
SELECT now.source_id, base.h AS previous_signature, now.h AS current_signature, 'WARNING' AS severity FROM now JOIN base ON now.source_id = base.source_id WHERE base.h <> now.h""")
def drift_page(spark, sf):
    c = I.derive(spark, sf, I.CRAWLS)
    now = c.groupBy("source_id").agg(F.max_by("page_structure_hash", "event_id").alias("page_structure_hash"))
    base = c.groupBy("source_id").agg(F.min_by("page_structure_hash", "event_id").alias("h")).select(
        "source_id", F.when(F.col("source_id") != 0, F.col("h")).alias("page_structure_hash")
    )
    events, _ = D.page_drift(base, now, F.lit(AS_OF))
    return events.select("source_id", "previous_signature", "current_signature", "severity")


@query("drift_page_baseline", f"""
WITH c AS ({S.CRAWLS}) SELECT source_id, arg_max(page_structure_hash, event_id) AS page_structure_hash FROM c GROUP BY source_id""")
def drift_page_baseline(spark, sf):
    c = I.derive(spark, sf, I.CRAWLS)
    now = c.groupBy("source_id").agg(F.max_by("page_structure_hash", "event_id").alias("page_structure_hash"))
    base = c.select("source_id", F.lit(None).cast("string").alias("page_structure_hash")).distinct()
    return D.page_drift(base, now, F.lit(AS_OF))[1].select("source_id", "page_structure_hash")


@query("drift_page_history", f"""
WITH c AS (SELECT *, lag(page_structure_hash) OVER (PARTITION BY source_id ORDER BY crawled_at, page_structure_hash) AS prev FROM ({S.CRAWLS}) x)
SELECT source_id, prev AS previous_signature, page_structure_hash AS current_signature, CAST(crawled_at AS VARCHAR) AS detected_at FROM c WHERE prev <> page_structure_hash""")
def drift_page_history(spark, sf):
    c = I.derive(spark, sf, I.CRAWLS)
    e = D.page_drift_history(c, F.to_date("crawled_at"))
    return e.select("source_id", "previous_signature", "current_signature", F.col("detected_at").cast("string").alias("detected_at"))


_ST = f"st AS ({S.STAGED}), hist AS (SELECT * FROM st WHERE is_old = 1), cur AS (SELECT * FROM st WHERE is_old = 0)"


@query("drift_header", f"""
WITH {_ST}, top AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY created_at DESC, document_id DESC) AS rn FROM hist),
b AS (SELECT source_id, list(header_hash) AS known, arg_min(header_hash, rn) AS prev FROM top WHERE rn <= 5 GROUP BY source_id)
SELECT document_id, prev AS previous_signature, header_hash AS current_signature, 'CRITICAL' AS severity FROM cur JOIN b ON cur.source_id = b.source_id WHERE NOT list_contains(known, header_hash)""")
def drift_header(spark, sf):
    old, new = staged(spark, sf)
    return D.header_drift(new, old, F.lit(AS_OF)).select("document_id", "previous_signature", "current_signature", "severity")


@query("drift_header_global", f"""
WITH {_ST}, top AS (SELECT *, row_number() OVER (ORDER BY created_at DESC, document_id DESC) AS rn FROM hist),
b AS (SELECT list(header_hash) AS known, arg_min(header_hash, rn) AS prev FROM top WHERE rn <= 5)
SELECT document_id, prev AS previous_signature, header_hash AS current_signature FROM cur, b WHERE NOT list_contains(known, header_hash)""")
def drift_header_global(spark, sf):
    old, new = staged(spark, sf)
    return D.header_drift(new, old, F.lit(AS_OF), scope="global").select("document_id", "previous_signature", "current_signature")


@query("drift_header_in_order", f"""
WITH st AS ({S.STAGED}), seen AS (SELECT *, list(header_hash) OVER (PARTITION BY source_id ORDER BY created_at, document_id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS known,
 lag(header_hash) OVER (PARTITION BY source_id ORDER BY created_at, document_id) AS prev FROM st)
SELECT document_id, prev AS previous_signature, header_hash AS current_signature FROM seen WHERE is_old = 0 AND prev IS NOT NULL AND NOT list_contains(known, header_hash)""")
def drift_header_in_order(spark, sf):
    old, new = staged(spark, sf)
    return D.header_drift_in_order(new, old, F.lit(AS_OF), ["created_at", "document_id"]).select(
        "document_id", "previous_signature", "current_signature")


@query("drift_columns", f"""
WITH {_ST}, b AS (SELECT source_id, CAST(round_even(avg(len(string_split(columns_csv, ','))), 0) AS INT) AS e FROM hist GROUP BY source_id),
j AS (SELECT document_id, e, CAST(len(string_split(columns_csv, ',')) AS INT) AS n FROM cur JOIN b ON cur.source_id = b.source_id)
SELECT document_id, CAST(e AS VARCHAR) AS previous_signature, CAST(n AS VARCHAR) AS current_signature, CASE WHEN abs(n - e) <= 2 THEN 'WARNING' ELSE 'CRITICAL' END AS severity, round(1 - CAST(abs(n - e) AS DOUBLE) / greatest(e, 1), 6) AS similarity_score FROM j WHERE n <> e""")
def drift_columns(spark, sf):
    old, new = staged(spark, sf)
    e = D.column_count_drift(new, old, F.lit(AS_OF))
    return e.select("document_id", "previous_signature", "current_signature", "severity", F.round("similarity_score", 6).alias("similarity_score"))


@query("drift_columns_global", f"""
WITH {_ST}, b AS (SELECT CAST(round_even(avg(len(string_split(columns_csv, ','))), 0) AS INT) AS e FROM hist)
SELECT count(*) AS tables, sum(CASE WHEN abs(len(string_split(columns_csv, ',')) - e) <= 2 THEN 1 ELSE 0 END) AS warnings FROM cur, b WHERE len(string_split(columns_csv, ',')) <> e""", warnings="BIGINT")
def drift_columns_global(spark, sf):
    old, new = staged(spark, sf)
    e = D.column_count_drift(new, old, F.lit(AS_OF), scope="global")
    return e.agg(F.count(F.lit(1)).alias("tables"), F.sum(F.when(F.col("severity") == "WARNING", 1).otherwise(0)).alias("warnings"))


@query("drift_validation", f"""
WITH h AS (SELECT doc_id % 9 AS source_id, CASE WHEN doc_id % 9 = 0 THEN true WHEN doc_id % 9 < 4 THEN market_value = 'nil' ELSE false END AS bad FROM ({S.HOLDINGS}) x),
g AS (SELECT source_id, count(*) AS t, sum(CASE WHEN bad THEN 1 ELSE 0 END) AS f FROM h GROUP BY source_id)
SELECT source_id, CASE WHEN CAST(f AS DOUBLE) / t > 0.5 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, round(1 - CAST(f AS DOUBLE) / t, 6) AS similarity_score FROM g WHERE CAST(f AS DOUBLE) / t > 0.1""")
def drift_validation(spark, sf):
    h = I.derive(spark, sf, I.HOLDINGS).withColumn("source_id", F.col("doc_id") % 9)
    bad = F.expr("CASE WHEN source_id = 0 THEN true WHEN source_id < 4 THEN market_value = 'nil' ELSE false END")
    e = D.validation_drift(h, bad, F.lit(AS_OF))
    return e.select("source_id", "severity", F.round("similarity_score", 6).alias("similarity_score"))


@query("drift_types", f"""
WITH h AS (SELECT doc_id % 5 AS source_id, doc_id, upper(trim(isin)) AS isin, {S.number(S.clean_number('quantity'))} AS q, {S.number('pct_to_net_assets')} AS p FROM ({S.HOLDINGS}) x),
t AS (SELECT source_id, doc_id, count(*) AS n, sum(CASE WHEN len(isin) = 12 THEN 1 ELSE 0 END) AS i, sum(CASE WHEN q IS NOT NULL THEN 1 ELSE 0 END) AS k, round(sum(p), 9) AS pct FROM h GROUP BY 1, 2)
SELECT source_id, CAST(sum(n) AS BIGINT) AS row_count, round(sum(i) / sum(n), 6) AS isin_ok_rate, round(sum(k) / sum(n), 6) AS quantity_numeric_rate, round(avg(CASE WHEN pct BETWEEN 80 AND 102 THEN 1.0 ELSE 0.0 END), 6) AS pct_total_ok_rate FROM t GROUP BY source_id""")
def drift_types(spark, sf):
    from holdsift.functions.cells import clean_isin, number_cell
    from holdsift.functions.text import parse_number

    h = I.derive(spark, sf, I.HOLDINGS).select(
        (F.col("doc_id") % 5).alias("source_id"), "doc_id", F.lit(0).alias("table_id"), clean_isin(F.col("isin")).alias("isin"),
        number_cell(F.col("quantity"), "excel")["num"].alias("quantity"), parse_number(F.col("pct_to_net_assets")).alias("pct_to_net_assets"),
    )
    t = D.type_checks(h)
    return t.select("source_id", "row_count", *[F.round(c, 6).alias(c) for c in ("isin_ok_rate", "quantity_numeric_rate", "pct_total_ok_rate")])


def events(spark, sf):
    """Header and column events of the current batch in one schema; every seventh document's are resolved."""
    old, new = staged(spark, sf)
    e = D.union_events(
        D.header_drift(new, old, F.col("created_at")), D.column_count_drift(new, old, F.col("created_at"))
    )
    done = F.col("document_id").cast("bigint") % 7 == 0
    return e.withColumns({"resolved": done, "resolved_at": F.when(done, F.col("detected_at"))})


_EV = f"""{_ST}, top AS (SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY created_at DESC, document_id DESC) AS rn FROM hist),
b AS (SELECT source_id, list(header_hash) AS known FROM top WHERE rn <= 5 GROUP BY source_id),
c AS (SELECT source_id, CAST(round_even(avg(len(string_split(columns_csv, ','))), 0) AS INT) AS e FROM hist GROUP BY source_id),
ev AS (SELECT cur.source_id, document_id, 'table_header' AS detection_type, 'CRITICAL' AS severity, created_at AS detected_at, CAST(document_id AS BIGINT) % 7 = 0 AS resolved FROM cur JOIN b ON cur.source_id = b.source_id WHERE NOT list_contains(known, header_hash)
 UNION ALL SELECT cur.source_id, document_id, 'column_count', CASE WHEN abs(len(string_split(columns_csv, ',')) - e) <= 2 THEN 'WARNING' ELSE 'CRITICAL' END, created_at, CAST(document_id AS BIGINT) % 7 = 0 FROM cur JOIN c ON cur.source_id = c.source_id WHERE len(string_split(columns_csv, ',')) <> e)"""


@query("drift_open", f"WITH {_EV} SELECT document_id, detection_type, severity FROM ev WHERE NOT resolved AND source_id = 1")
def drift_open(spark, sf):
    return D.unresolved(events(spark, sf), 1).select("document_id", "detection_type", "severity")


@query("drift_halt", f"""
WITH {_EV}, bad AS (SELECT DISTINCT source_id FROM ev WHERE severity = 'CRITICAL' AND NOT resolved)
SELECT CASE WHEN source_id IN (SELECT source_id FROM bad) THEN 'held' ELSE 'goes on' END AS fate, source_id, count(*) AS documents FROM st GROUP BY ALL""")
def drift_halt(spark, sf):
    docs = I.derive(spark, sf, I.STAGED).select("source_id", "document_id")
    go, held = D.halt_critical(docs, events(spark, sf))
    both = go.select(F.lit("goes on").alias("fate"), "source_id").unionByName(held.select(F.lit("held").alias("fate"), "source_id"))
    return both.groupBy("fate", "source_id").agg(F.count(F.lit(1)).alias("documents"))


@query("drift_baseline", f"""
WITH {_EV}, since AS (SELECT source_id, max(detected_at) AS s FROM ev WHERE resolved GROUP BY source_id),
l AS (SELECT st.*, row_number() OVER (PARTITION BY st.source_id ORDER BY created_at, document_id) AS rn FROM st LEFT JOIN since ON st.source_id = since.source_id WHERE s IS NULL OR created_at > s)
SELECT source_id, header_hash, len(string_split(columns_csv, ',')) AS column_count FROM l WHERE rn = 1""", column_count="INT")
def drift_baseline(spark, sf):
    s = I.derive(spark, sf, I.STAGED).withColumn("column_names", F.split("columns_csv", ","))
    return D.baselines(s, events(spark, sf)).select("source_id", "header_hash", "column_count")


# ---------------------------------------------------------------------------
# Review
# ---------------------------------------------------------------------------
CLASSIFIED = """
SELECT CAST(o_orderkey AS STRING) AS classification_id, o_orderkey AS doc_id, CAST(o_custkey % 4 AS INT) AS source_id,
 CASE o_custkey % 5 WHEN 0 THEN 'SBI Mutual Fund' WHEN 1 THEN 'HDFC Mutual Fund' ELSE 'Nippon India Mutual Fund' END AS amc_name,
 concat('Scheme ', CAST(o_custkey % 6 AS STRING)) AS scheme_name, CAST(month(o_orderdate) AS INT) AS period_month, CAST(year(o_orderdate) + 25 AS INT) AS period_year,
 floor(o_totalprice % 1000) / 1000.0E0 AS confidence_score, o_orderkey % 3 = 0 AS is_quarantined,
 CAST(NULL AS STRING) AS review_decision, CAST(NULL AS STRING) AS reviewed_by, CAST(NULL AS STRING) AS review_notes, CAST(NULL AS TIMESTAMP) AS reviewed_at,
 CASE o_orderkey % 4 WHEN 0 THEN 'SBI Mutual Fund' WHEN 1 THEN NULL ELSE 'HDFC Mutual Fund' END AS file_amc, CASE o_orderkey % 6 WHEN 0 THEN 'SBI Mutual Fund' ELSE 'Nippon India Mutual Fund' END AS url_amc
FROM {orders}
"""
# Several reviews may hit the same document; blank corrections change nothing.
REVIEWS = """
SELECT event_id AS review_id, CAST(event_id * 7 % 15000 AS STRING) AS classification_id, CASE user_id % 3 WHEN 0 THEN 'ACCEPTED' WHEN 1 THEN 'RECLASSIFIED' ELSE 'REJECTED' END AS decision,
 concat('reviewer ', CAST(user_id % 5 AS STRING)) AS reviewer, event_type AS notes, ts AS reviewed_at,
 CASE WHEN event_type = 'click' THEN 'Axis Mutual Fund' WHEN event_type = 'view' THEN '' ELSE NULL END AS corrected_amc_name,
 CASE WHEN event_type = 'purchase' THEN 'Scheme X' ELSE NULL END AS corrected_scheme_name,
 CAST(CASE WHEN event_type = 'error' THEN 9 ELSE 0 END AS INT) AS corrected_period_month, CAST(NULL AS INT) AS corrected_period_year
FROM {events}
"""
CLS, REV = I.duck(CLASSIFIED), I.duck(REVIEWS)
_REVIEWED = f"""c AS ({CLS}), r AS ({REV}),
f AS (SELECT classification_id, arg_max(decision, review_id) AS decision, arg_max(reviewer, review_id) AS reviewer, arg_max(notes, review_id) AS notes,
 arg_max(corrected_amc_name, review_id) FILTER (decision <> 'REJECTED' AND corrected_amc_name <> '') AS a, arg_max(corrected_scheme_name, review_id) FILTER (decision <> 'REJECTED' AND corrected_scheme_name <> '') AS s,
 arg_max(corrected_period_month, review_id) FILTER (decision <> 'REJECTED' AND corrected_period_month <> 0) AS m FROM r GROUP BY classification_id),
v AS (SELECT c.*, f.decision AS d, f.reviewer AS rv, f.notes AS nt, coalesce(f.a, c.amc_name) AS amc2, coalesce(f.s, c.scheme_name) AS scheme2, coalesce(f.m, c.period_month) AS month2 FROM c LEFT JOIN f ON c.classification_id = f.classification_id)"""


def _reviewed(spark, sf):
    c = I.derive(spark, sf, CLASSIFIED)
    return c, V.apply_reviews(c, I.derive(spark, sf, REVIEWS).withColumn("reviewed_at", F.col("reviewed_at").cast("timestamp")), ("review_id",))


@query("review_apply", f"WITH {_REVIEWED} SELECT doc_id, amc2 AS amc_name, scheme2 AS scheme_name, month2 AS period_month, d AS review_decision, rv AS reviewed_by, nt AS review_notes, CASE WHEN d IS NULL THEN is_quarantined ELSE false END AS is_quarantined FROM v")
def review_apply(spark, sf):
    return _reviewed(spark, sf)[1].select(
        "doc_id", "amc_name", "scheme_name", "period_month", "review_decision", "reviewed_by", "review_notes", "is_quarantined"
    )


@query("review_resume", f"WITH {_REVIEWED} SELECT doc_id, amc2 AS amc_name FROM v WHERE d IN ('ACCEPTED', 'RECLASSIFIED')")
def review_resume(spark, sf):
    return V.resumed(_reviewed(spark, sf)[1]).select("doc_id", "amc_name")


# States of the documents when the reviews come in; a review of anything but a held document may be illegal.
_STATE = "CASE WHEN is_quarantined THEN 'QUARANTINED' WHEN doc_id % 5 = 0 THEN 'REJECTED' ELSE 'PUBLISHED' END"
_LEGAL = "((status = 'QUARANTINED' AND d IN ('ACCEPTED', 'RECLASSIFIED', 'REJECTED')) OR (status = 'REJECTED' AND d = 'RECLASSIFIED'))"


def _moves(spark, sf):
    """(moved, errors, reviewed classifications of the moved documents)."""
    before, after = _reviewed(spark, sf)
    events = L.newest_events(I.derive(spark, sf, REVIEWS).select("classification_id", F.col("decision").alias("event"), "review_id"),
                             "classification_id", ["review_id"])
    moved, errors = L.move(before.select("classification_id", F.expr(_STATE).alias("status")), events, "classification_id")
    return moved, errors, after.join(moved.select("classification_id"), "classification_id", "left_semi")


@query("review_moves", f"""WITH {_REVIEWED}, m AS (SELECT f.classification_id, {_STATE} AS status, f.decision AS d, doc_id FROM f LEFT JOIN c ON c.classification_id = f.classification_id)
SELECT classification_id, CASE WHEN doc_id IS NULL THEN NULL WHEN NOT {_LEGAL} THEN status WHEN d = 'REJECTED' THEN 'REJECTED' ELSE 'CLASSIFIED' END AS status, d AS event,
 CASE WHEN doc_id IS NULL THEN 'UNKNOWN_DOCUMENT' WHEN NOT {_LEGAL} THEN 'ILLEGAL_EVENT: ' || d || ' in state ' || status END AS error FROM m""")
def review_moves(spark, sf):
    moved, errors, _ = _moves(spark, sf)
    return moved.select("classification_id", "status", "event", F.lit(None).cast("string").alias("error")).unionByName(errors)


@query("review_published", f"""WITH {_REVIEWED}, rel AS (SELECT doc_id AS id, amc2, scheme2, month2, period_year AS year2 FROM (SELECT *, {_STATE} AS status FROM v) t WHERE {_LEGAL} AND d <> 'REJECTED'),
k AS (SELECT h.*, amc2, scheme2, month2, year2, sha256(concat_ws('|', amc2, scheme2, CAST(year2 AS VARCHAR), CAST(month2 AS VARCHAR), coalesce(nullif(isin, ''), nullif(instrument_name, ''), 'row_' || CAST(row_idx AS VARCHAR)))) AS idempotency_key,
 {S.number("trim(replace(quantity, ',', ''))")} AS q, {S.number("trim(replace(pct_to_net_assets, ',', ''))")} AS pct FROM ({PUB_SQL}) h JOIN rel ON rel.id = h.doc_ord),
u AS (SELECT *, row_number() OVER (PARTITION BY idempotency_key ORDER BY doc_ord, row_idx) AS up, row_number() OVER (PARTITION BY idempotency_key ORDER BY doc_ord DESC, row_idx DESC) AS down, count(*) OVER (PARTITION BY idempotency_key) AS n FROM k)
SELECT a.idempotency_key, a.document_id, a.amc2 AS amc_name, a.scheme2 AS scheme_name, a.month2 AS period_month, a.isin, z.q AS quantity, z.pct AS pct_to_net_assets, z.rating, CAST(a.n AS INT) AS version
FROM u a JOIN u z ON a.idempotency_key = z.idempotency_key AND a.up = 1 AND z.down = 1""")
def review_published(spark, sf):
    """Holdings of the documents that reviewers released, under the names they settled on."""
    named = ["amc_name", "scheme_name", "period_month", "period_year"]
    released = V.resumed(_moves(spark, sf)[2]).select(F.col("doc_id").alias("doc_ord"), *named)
    rows = I.derive(spark, sf, PUB).drop(*named).join(released, "doc_ord")
    return W.publish_upsert(W.empty_published(spark), W.publish_rows(rows), ORDER, AS_OF).select(
        "idempotency_key", "document_id", "amc_name", "scheme_name", "period_month", "isin", "quantity", "pct_to_net_assets", "rating", "version")


@query("review_split", f"SELECT is_quarantined AS waiting, count(*) AS documents FROM ({CLS}) c GROUP BY is_quarantined")
def review_split(spark, sf):
    go, wait = V.split_for_extraction(I.derive(spark, sf, CLASSIFIED))
    both = go.select(F.lit(False).alias("waiting")).unionByName(V.pending(wait).select(F.lit(True).alias("waiting")))
    return both.groupBy("waiting").agg(F.count(F.lit(1)).alias("documents"))


@query("audit_rows", f"""
WITH {_REVIEWED} SELECT classification_id AS entity_id, 'REVIEW' AS action, '{{"amc_name":"' || amc_name || '","scheme_name":"' || scheme_name || '","period_month":' || period_month || '}}' AS before_state,
 '{{"amc_name":"' || amc2 || '","scheme_name":"' || scheme2 || '","period_month":' || month2 || '}}' AS after_state, rv AS actor FROM v WHERE amc_name <> amc2 OR scheme_name <> scheme2 OR period_month <> month2""")
def audit_rows(spark, sf):
    before, after = _reviewed(spark, sf)
    a = V.audit_rows(before, after, "classification_id", "classified_document", "REVIEW", AS_OF,
                     F.col("reviewed_by"), ["amc_name", "scheme_name", "period_month"])
    return a.select("entity_id", "action", "before_state", "after_state", "actor")


@query("feedback_rates", f"""
WITH {_REVIEWED}, t AS (SELECT source_id, amc2, 'filename' AS channel, file_amc AS x FROM v WHERE d <> 'REJECTED' UNION ALL SELECT source_id, amc2, 'url', url_amc FROM v WHERE d <> 'REJECTED')
SELECT source_id, channel, count(*) AS reviewed, sum(CASE WHEN x <> amc2 THEN 1 ELSE 0 END) AS wrong FROM t WHERE x IS NOT NULL GROUP BY source_id, channel""", wrong="BIGINT")
def feedback_rates(spark, sf):
    c, r = _reviewed(spark, sf)
    c = c.withColumns({SIGNALS["filename"]: F.struct(F.col("file_amc").alias("amc_name")), SIGNALS["url"]: F.struct(F.col("url_amc").alias("amc_name"))})
    f = V.feedback_rates(c, r, {k: SIGNALS[k] for k in ("filename", "url")})
    return f.select("source_id", "channel", "reviewed", "wrong")


@query("feedback_dictionary", f"WITH {_REVIEWED} SELECT scheme_name AS classified_as, scheme2 AS corrected_to, count(*) AS times FROM v WHERE d <> 'REJECTED' AND scheme_name <> scheme2 GROUP BY 1, 2")
def feedback_dictionary(spark, sf):
    return V.correction_dictionary(*_reviewed(spark, sf))


# ---------------------------------------------------------------------------
# Reports
# ---------------------------------------------------------------------------
def _sources(spark):
    return SR.sources(spark).select(
        F.expr("CASE source_key WHEN 'hdfc_mf' THEN 0 WHEN 'nippon_india' THEN 1 ELSE 2 END").alias("source_id"),
        "source_key", "amc_name", "enabled",
    )


_SRC = "src AS (SELECT row_number() OVER (ORDER BY source_key) - 1 AS source_id, source_key, amc_name, enabled FROM (VALUES " + ", ".join(
    f"({S.q(s['source_key'])}, {S.q(s['amc_name'])}, {str(s['enabled']).lower()})" for s in R.SOURCES) + ") v(source_key, amc_name, enabled))"


@query("stats", f"""
WITH {_SRC}, {_EV}, rn AS ({S.RUNS}), p AS (SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey FROM lineitem) t)
SELECT (SELECT count(*) FROM src) AS total_sources, (SELECT count(*) FROM src WHERE enabled) AS enabled_sources, (SELECT count(*) FROM orders) AS total_documents, (SELECT count(*) FROM ({CLS}) c WHERE is_quarantined) AS total_quarantined,
 (SELECT n FROM p) AS total_published, (SELECT count(*) FROM rn WHERE started_at >= TIMESTAMP '2024-01-24 00:00:00') AS recent_runs, (SELECT count(*) FROM ev WHERE NOT resolved) AS active_drift_alerts""")
def stats(spark, sf):
    pub = I.table(spark, sf, "lineitem").select("l_partkey").distinct()
    return P.stats(_sources(spark), I.table(spark, sf, "orders"), I.derive(spark, sf, CLASSIFIED), pub,
                   I.derive(spark, sf, I.RUNS), events(spark, sf), F.lit("2024-01-24 00:00:00").cast("timestamp_ntz"))


@query("sources_running", f"""
WITH {_SRC}, rn AS ({S.RUNS}) SELECT source_key, amc_name, source_id IN (SELECT source_id FROM rn WHERE status = 'RUNNING') AS is_running FROM src""")
def sources_running(spark, sf):
    return P.sources_running(_sources(spark), I.derive(spark, sf, I.RUNS)).select("source_key", "amc_name", "is_running")


@query("quarantine_queue", f"""
WITH c AS ({CLS}), d AS ({S.DOCS}) SELECT c.classification_id, d.url, d.filename, c.confidence_score FROM c JOIN d ON c.doc_id = d.doc_id WHERE is_quarantined AND review_decision IS NULL ORDER BY confidence_score, classification_id LIMIT 100 OFFSET 50""")
def quarantine_queue(spark, sf):
    q = P.quarantine_queue(I.derive(spark, sf, CLASSIFIED), I.derive(spark, sf, I.DOCS), 100, 50)
    return q.select("classification_id", "url", "filename", "confidence_score")


_SIZE = "CASE WHEN b IS NULL THEN '—' WHEN b < 1024 THEN CAST(b AS VARCHAR) || ' Bytes' WHEN b < 1048576 THEN regexp_replace(printf('%.2f', floor(b / 1024.0::DOUBLE * 100 + 0.5) / 100), '\\.?0+$', '') || ' KB' ELSE regexp_replace(printf('%.2f', floor(b / 1048576.0::DOUBLE * 100 + 0.5) / 100), '\\.?0+$', '') || ' MB' END"


@query("documents_list", f"""
WITH {_SRC}, d AS (SELECT *, file_size_bytes AS b FROM ({S.DOCS}) x) SELECT d.doc_id, d.filename, src.amc_name, {_SIZE} AS size_label FROM d JOIN src ON d.source_id = src.source_id ORDER BY discovered_at DESC, doc_id LIMIT 100 OFFSET 25""")
def documents_list(spark, sf):
    d = P.documents_list(I.derive(spark, sf, I.DOCS), _sources(spark), 100, 25)
    return d.select("doc_id", "filename", "amc_name", P.human_bytes(F.col("file_size_bytes")).alias("size_label"))


@query("size_labels", f"SELECT doc_id, {_SIZE} AS size_label FROM (SELECT doc_id, file_size_bytes AS b FROM ({S.DOCS}) x) t")
def size_labels(spark, sf):
    return I.derive(spark, sf, I.DOCS).select("doc_id", P.human_bytes(F.col("file_size_bytes")).alias("size_label"))


@query("page_has_more", f"SELECT count(*) > 15 AS has_more FROM (SELECT 1 FROM ({CLS}) c WHERE is_quarantined LIMIT 16) t")
def page_has_more(spark, sf):
    q = V.pending(I.derive(spark, sf, CLASSIFIED)).orderBy("confidence_score", "classification_id")
    return P.page_with_more(q, 15)[1]


OUTCOMES = """
SELECT concat('run-', CAST(o_custkey % 20 AS STRING)) AS pipeline_run_id, o_orderkey % 5 <> 0 AS is_novel, o_orderkey % 7 <> 0 AS downloaded, o_orderkey % 11 = 0 AS file_seen, o_orderkey % 3 = 0 AS is_quarantined,
 o_orderkey % 4 <> 0 AS extracted, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 3 <> 0 THEN o_orderkey % 4 ELSE NULL END AS published_tables FROM {orders}
"""


@query("run_counters", f"""
SELECT pipeline_run_id, count(*) AS documents_discovered, sum(CASE WHEN is_novel THEN 1 ELSE 0 END) AS documents_novel, sum(CASE WHEN w AND NOT is_quarantined THEN 1 ELSE 0 END) AS documents_classified,
 sum(CASE WHEN w AND is_quarantined THEN 1 ELSE 0 END) AS documents_quarantined, sum(CASE WHEN w AND NOT is_quarantined AND extracted THEN 1 ELSE 0 END) AS documents_extracted, sum(coalesce(published_tables, 0)) AS documents_published
FROM (SELECT *, is_novel AND downloaded AND NOT file_seen AS w FROM ({I.duck(OUTCOMES)}) o) t GROUP BY pipeline_run_id""", documents_novel="BIGINT", documents_classified="BIGINT", documents_quarantined="BIGINT", documents_extracted="BIGINT", documents_published="BIGINT")
def run_counters(spark, sf):
    return P.run_counters(I.derive(spark, sf, OUTCOMES))


@query("run_cleanup", f"SELECT run_id, CASE WHEN status = 'RUNNING' THEN 'FAILED' ELSE status END AS status, CASE WHEN status = 'RUNNING' THEN 'Dangling run cleaned up on system startup.' END AS errors FROM ({S.RUNS}) r")
def run_cleanup(spark, sf):
    return P.close_dangling(I.derive(spark, sf, I.RUNS), AS_OF).select("run_id", "status", "errors")


@query("run_listing", f"SELECT run_id, status, documents_discovered FROM ({S.RUNS}) r ORDER BY started_at DESC, run_id LIMIT 20")
def run_listing(spark, sf):
    return P.run_listing(I.derive(spark, sf, I.RUNS), 20).select("run_id", "status", "documents_discovered")


@query("run_alerts", f"""
WITH r AS (SELECT *, epoch_us(completed_at) / 1e6 - epoch_us(started_at) / 1e6 AS dur FROM ({S.RUNS}) x),
w AS (SELECT *, avg(dur) OVER (PARTITION BY source_id ORDER BY started_at, run_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mean FROM r)
SELECT run_id, documents_discovered = 0 AS alert_no_documents, documents_classified + documents_quarantined > 0 AND documents_quarantined > CAST(0.3 AS DOUBLE) * (documents_classified + documents_quarantined) AS alert_quarantine,
 documents_published = 0 AND documents_novel > 0 AS alert_nothing_published, status IN ('FAILED', 'PARTIAL') AS alert_status, coalesce(dur > 2 * mean, false) AS alert_duration, round(mean, 2) AS mean_before FROM w""")
def run_alerts(spark, sf):
    runs = I.derive(spark, sf, I.RUNS)
    runs = runs.withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "completed_at")})
    a = P.run_alerts(runs, F.date_trunc("week", "started_at"))
    return a.select("run_id", "alert_no_documents", "alert_quarantine", "alert_nothing_published", "alert_status", "alert_duration", F.round("mean_before", 2).alias("mean_before"))


@query("key_metrics", f"""
WITH {_EV}, r AS ({S.RUNS}), cl AS ({CLS})
SELECT round((SELECT count(*) FILTER (status = 'COMPLETED') / count(*) FILTER (status IN ('COMPLETED', 'FAILED', 'PARTIAL')) FROM r), 6) AS success_rate, round((SELECT avg(epoch_us(completed_at) / 1e6 - epoch_us(started_at) / 1e6) FROM r), 2) AS avg_duration_sec,
 (SELECT count(*) FROM r WHERE status = 'FAILED' AND date_diff('day', CAST(started_at AS DATE), DATE '2024-01-31') BETWEEN 0 AND 7) AS failed_runs_7d, (SELECT count(*) FROM r) AS runs,
 round((SELECT avg(confidence_score) FROM cl), 6) AS avg_confidence, round((SELECT avg(CASE WHEN is_quarantined THEN 1.0 ELSE 0.0 END) FROM cl), 6) AS quarantine_rate, (SELECT count(*) FROM cl WHERE is_quarantined) AS queue_depth,
 (SELECT count(DISTINCT amc_name) FROM cl WHERE period_year = 2024 AND period_month = 1) AS amcs_this_month, (SELECT count(*) FROM ev) AS drift_events, round((SELECT count(*) FROM ev) / (SELECT count(*) FROM r), 6) AS drift_per_run""")
def key_metrics(spark, sf):
    runs = I.derive(spark, sf, I.RUNS)
    runs = runs.withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "completed_at")})
    c = I.derive(spark, sf, CLASSIFIED)
    m = P.key_metrics(runs, c, events(spark, sf), c, F.lit("2024-01-31"))
    digits = {"success_rate": 6, "avg_duration_sec": 2, "avg_confidence": 6, "quarantine_rate": 6, "drift_per_run": 6}
    return m.select(*[F.round(x, digits[x]).alias(x) if x in digits else x for x in m.columns])


@query("source_freshness", f"""
WITH {_SRC}, r AS ({S.RUNS}) SELECT source_key, date_diff('day', CAST((SELECT max(completed_at) FROM r WHERE r.source_id = src.source_id AND status = 'COMPLETED') AS DATE), DATE '2024-02-10') AS days_since_success FROM src""", days_since_success="INT")
def source_freshness(spark, sf):
    f = P.source_freshness(_sources(spark), I.derive(spark, sf, I.RUNS), F.lit("2024-02-10"))
    return f.select("source_key", "days_since_success")
