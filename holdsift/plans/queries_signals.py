"""Queries over the signal channels, fuzzy lookups and score fusion."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import fuzzy as Z
from holdsift.functions import signals as G
from holdsift.functions.fusion import fuse, percent_label
from holdsift.functions.periods import month_in_range
from holdsift.operators.classify import classify, extra_triggers, with_signals
from holdsift.operators.novelty import shared_content
from holdsift.plans import inputs as I
from holdsift.plans import sqltext as S
from holdsift.plans.registry import query

AS_OF = "2026-07-01"
FIELDS = ["amc_name", "scheme_name", "period_month", "period_year", "scheme_category", "doc_type"]


def docs(spark, sf, orders=None):
    """The derived documents with their page context as a struct and sheets as an array."""
    d = I.derive(spark, sf, I.DOCS, spread=True) if orders is None else spark.sql(I.DOCS, orders=orders)
    kv = lambda k, v: F.struct(F.col(k).alias("k"), F.col(v).alias("v"))
    return d.withColumns(
        {
            "page_context": F.when(
                F.col("doc_id") % 11 != 0,
                F.struct(
                    "link_text", "parent_text", F.lit("").alias("grandparent_text"), "title", "aria_label",
                    F.array(kv("attr_name", "attr_value")).alias("data_attrs"),
                    F.array(kv("drop1_name", "drop1_value"), kv("drop2_name", "drop2_value")).alias("active_dropdowns"),
                ),
            ),
            "sheet_names": F.array("sheet1", "sheet2"),
        }
    )


def _flat(df, signal):
    s = F.col(signal)
    return df.select(
        "doc_id", *[s[f].alias(f) for f in FIELDS],
        F.round(s["confidence"], 6).alias("confidence"), s["signals_found"].alias("signals_found"),
    )


def _hits(*conds):
    return " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in conds)


def filename_sql(space: bool = False) -> str:
    text = "regexp_replace(low, '[_\\-.]', ' ', 'g')" if space else "low"
    y4 = f"TRY_CAST(regexp_extract(txt, {S.q(R.YEAR_4)}, 1) AS INT)"
    return rf"""
WITH a AS (SELECT doc_id, source_amc, lower(regexp_replace(filename, '\.[^.]+$', '')) AS low FROM ({S.DOCS}) d),
b AS (SELECT *, {text} AS txt, regexp_split_to_array(low, '[_\-\s.]+')[-1] AS last FROM a),
c AS (SELECT doc_id, source_amc, {S.case_contains('low', R.FILENAME_AMC)} AS amc, CAST({S.case_regex('txt', R.FILENAME_MONTHS)} AS INT) AS m,
 CAST(CASE WHEN regexp_matches(txt, {S.q(R.YEAR_4)}) THEN CASE WHEN {y4} BETWEEN 2020 AND 2030 THEN {y4} END
  WHEN regexp_matches(txt, {S.q(R.MONTH_THEN_YEAR_2)}) THEN 2000 + CAST(regexp_extract(txt, {S.q(R.MONTH_THEN_YEAR_2)}, 1) AS INT)
  WHEN regexp_matches(last, '^(2[0-9]|30)$') THEN 2000 + CAST(last AS INT) END AS INT) AS y,
 {S.case_contains('low', R.FILENAME_DOC_TYPE)} AS dt, {S.case_contains('low', R.FILENAME_CATEGORY)} AS cat FROM b),
n AS (SELECT *, CAST({_hits('amc IS NOT NULL', 'm IS NOT NULL', 'y IS NOT NULL', 'dt IS NOT NULL', 'cat IS NOT NULL')} AS INT) AS found FROM c)
SELECT doc_id, coalesce(amc, source_amc) AS amc_name, CAST(NULL AS VARCHAR) AS scheme_name, m AS period_month, y AS period_year,
 cat AS scheme_category, dt AS doc_type, round(CASE WHEN m IS NOT NULL AND y IS NOT NULL
  THEN least(1, least(1, CAST(found AS DOUBLE) / 5 * CAST(1.2 AS DOUBLE)) + CAST(0.15 AS DOUBLE)) ELSE least(1, CAST(found AS DOUBLE) / 5 * CAST(1.2 AS DOUBLE)) END, 6) AS confidence,
 found AS signals_found FROM n"""


def url_sql() -> str:
    seg_y = (
        f"CASE WHEN regexp_matches(s, {S.q(R.YEAR_4)}) THEN CAST(regexp_extract(s, {S.q(R.YEAR_4)}, 1) AS INT) "
        f"WHEN regexp_matches(s, {S.q(R.MONTH_THEN_YEAR_2)}) THEN 2000 + CAST(regexp_extract(s, {S.q(R.MONTH_THEN_YEAR_2)}, 1) AS INT) "
        "WHEN regexp_matches(s, '^[2-3][0-9]$') THEN 2000 + CAST(s AS INT) END"
    )
    num = "TRY_CAST(CASE WHEN regexp_matches(trim(v), '^[+-]?[0-9]{1,9}$') THEN trim(v) END AS INT)"
    return rf"""
WITH b AS (SELECT doc_id, url, source_amc FROM ({S.DOCS}) d), {S.url_ctes('b', 'doc_id')},
g AS (SELECT doc_id, s, i FROM (SELECT doc_id, list_filter(string_split(lower(path), '/'), lambda s: s <> '') AS ss FROM u) t, LATERAL (SELECT unnest(ss) AS s, unnest(range(len(ss))) AS i) x),
gp AS (SELECT doc_id, s, i, {S.case_contains("replace(replace(s, '-', ''), '_', '')", R.MONTH_WORDS)} AS m, {seg_y} AS y FROM g),
ga AS (SELECT doc_id, arg_max(m, i) FILTER (m IS NOT NULL) AS m, arg_max(y, i) FILTER (y IS NOT NULL) AS y, count(m) + count(y) AS n,
 {S.case_equals(f"arg_min(s, i) FILTER (s IN {S.in_list([k for k, _ in R.URL_DOC_TYPE])})", R.URL_DOC_TYPE)} AS dt FROM gp GROUP BY doc_id),
p AS (SELECT doc_id, i, CASE WHEN lower(k) IN {S.in_list(R.QUERY_MONTH_KEYS)} THEN {S.case_contains('lower(v)', R.MONTH_WORDS)} END AS mw,
  CASE WHEN lower(k) IN {S.in_list(R.QUERY_MONTH_KEYS)} AND {num} BETWEEN 1 AND 12 THEN {num} END AS mn,
  CASE WHEN lower(k) IN {S.in_list(R.QUERY_YEAR_KEYS)} THEN {S.plausible_year('v')} END AS y,
  CASE WHEN lower(k) IN {S.in_list(R.QUERY_SCHEME_KEYS)} THEN v END AS sch, CASE WHEN lower(k) IN {S.in_list(R.QUERY_CATEGORY_KEYS)} THEN lower(v) END AS cat FROM qp),
pa AS (SELECT doc_id, arg_max(coalesce(mn, mw), i) FILTER (coalesce(mn, mw) IS NOT NULL) AS m, arg_max(y, i) FILTER (y IS NOT NULL) AS y,
  arg_max(sch, i) FILTER (sch IS NOT NULL) AS sch, arg_max(cat, i) FILTER (cat IS NOT NULL) AS cat,
  count(mw) + count(mn) + count(y) + count(sch) + count(cat) AS n FROM p GROUP BY doc_id),
r AS (SELECT u.doc_id, {S.case_regex('lower(u.host)', R.URL_AMC)} AS amc, u.source_amc, ga.m AS gm, ga.y AS gy, ga.dt, pa.m AS pm, pa.y AS py, pa.sch, pa.cat,
  CAST(1 + CASE WHEN dt IS NULL THEN 0 ELSE 1 END + coalesce(ga.n, 0) + coalesce(pa.n, 0) AS INT) AS found
 FROM u LEFT JOIN ga ON u.doc_id = ga.doc_id LEFT JOIN pa ON u.doc_id = pa.doc_id)
SELECT doc_id, coalesce(amc, source_amc) AS amc_name, sch AS scheme_name, CAST(coalesce(pm, gm) AS INT) AS period_month, CAST(coalesce(py, gy) AS INT) AS period_year,
 cat AS scheme_category, dt AS doc_type, round(CASE WHEN amc IS NOT NULL THEN greatest(least(1, CAST(found AS DOUBLE) / 4 * CAST(1.1 AS DOUBLE)), CAST(0.5 AS DOUBLE))
  ELSE least(1, CAST(found AS DOUBLE) / 4 * CAST(1.1 AS DOUBLE)) END, 6) AS confidence, found AS signals_found FROM r"""


def _drop_facts(i: int) -> str:
    n, v = f"lower(drop{i}_name)", f"drop{i}_value"
    per, yr, sc = (S.any_contains(n, w) for w in (R.DROPDOWN_PERIOD_KEYS, R.DROPDOWN_YEAR_KEYS, R.DROPDOWN_SCHEME_KEYS))
    return (
        f"CASE WHEN {per} THEN {S.period_month(f'lower({v})')} END AS dm{i}, "
        f"CASE WHEN {per} THEN {S.period_year(f'lower({v})')} WHEN {yr} THEN {S.plausible_year(v)} END AS dy{i}, "
        f"CASE WHEN NOT {per} AND NOT {yr} AND {sc} THEN {v} END AS ds{i}"
    )


def page_sql() -> str:
    a_sch = S.any_contains("attr_name", R.DATA_SCHEME_KEYS)
    a_per = S.any_contains("attr_name", R.DATA_PERIOD_KEYS)
    return rf"""
WITH a AS (SELECT *, lower(link_text || ' ' || parent_text || ' ' || title || ' ' || aria_label) AS txt FROM ({S.DOCS}) d),
b AS (SELECT doc_id, source_amc, {_drop_facts(1)}, {_drop_facts(2)}, {S.period_month('txt')} AS tm, {S.period_year('txt')} AS ty,
  {S.case_regex('txt', R.PAGE_DOC_TYPE)} AS dt, {S.case_regex('txt', R.PAGE_CATEGORY)} AS cat,
  CASE WHEN {a_sch} THEN attr_value END AS asch, CASE WHEN NOT {a_sch} AND {a_per} THEN {S.period_month('lower(attr_value)')} END AS am,
  CASE WHEN NOT {a_sch} AND {a_per} THEN {S.period_year('lower(attr_value)')} END AS ay FROM a),
c AS (SELECT *, coalesce(dm2, dm1) AS dm, coalesce(dy2, dy1) AS dy, coalesce(ds2, ds1) AS ds FROM b),
n AS (SELECT *, coalesce(dm, tm, am) AS m, coalesce(dy, ty, ay) AS y, CAST(1 + {_hits('dm1 IS NOT NULL', 'dm2 IS NOT NULL', 'dy1 IS NOT NULL', 'dy2 IS NOT NULL', 'ds1 IS NOT NULL', 'ds2 IS NOT NULL', 'dm IS NULL AND coalesce(tm, am) IS NOT NULL', 'dy IS NULL AND coalesce(ty, ay) IS NOT NULL', 'dt IS NOT NULL', 'cat IS NOT NULL', 'asch IS NOT NULL')} AS INT) AS found FROM c),
k AS (SELECT *, least(1, CAST(found AS DOUBLE) / 5 * CAST(1.1 AS DOUBLE)) AS base FROM n)
SELECT doc_id, source_amc AS amc_name, coalesce(nullif(ds, ''), nullif(asch, ''), ds, asch) AS scheme_name, m AS period_month, CAST(y AS INT) AS period_year, cat AS scheme_category,
 dt AS doc_type, round(CASE WHEN dm IS NOT NULL OR ds IS NOT NULL THEN least(1, base + CAST(0.15 AS DOUBLE)) ELSE base END, 6) AS confidence, found AS signals_found
FROM k WHERE doc_id % 11 <> 0
UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, NULL, NULL, 0.0, 0 FROM k WHERE doc_id % 11 = 0"""


def _header_period(part: str) -> str:
    arms = []
    for pat, gm, gy in R.HEADER_PERIOD:
        if part == "month":
            g = f"regexp_extract(t, {S.q(pat)}, {gm})"
            names = S.case_equals(f"substr({g}, 1, 3)", [(m[:3].lower(), i + 1) for i, m in enumerate(R.MONTH_LABELS)])
            v = f"CASE WHEN regexp_matches({g}, '^[0-9]+$') THEN CASE WHEN TRY_CAST({g} AS INT) BETWEEN 1 AND 12 THEN TRY_CAST({g} AS INT) END ELSE {names} END"
        elif part == "year":
            v = S.year_of(f"regexp_extract(t, {S.q(pat)}, {gy})")
        else:
            v = "1"
        arms.append(f"WHEN regexp_matches(t, {S.q(pat)}) THEN {v}")
    return "CAST(CASE " + " ".join(arms) + " END AS INT)"


def header_sql() -> str:
    return rf"""
WITH a AS (SELECT doc_id, source_amc, file_type, lower(header_text) AS t FROM ({S.DOCS}) d),
b AS (SELECT *, {S.case_regex('t', R.HEADER_AMC)} AS ramc, {_header_period('month')} AS m, {_header_period('year')} AS y, {_header_period('hit')} AS p,
  {S.case_regex('t', R.HEADER_DOC_TYPE)} AS dt FROM a WHERE file_type IN ('pdf', 'xlsx', 'xls') AND regexp_matches(t, '\S')),
c AS (SELECT *, CASE WHEN ramc IS NULL AND contains(t, string_split(lower(source_amc), ' ')[1]) THEN source_amc END AS samc FROM b),
n AS (SELECT *, CAST({_hits('ramc IS NOT NULL OR samc IS NOT NULL', 'p IS NOT NULL', 'p IS NOT NULL', 'dt IS NOT NULL')} AS INT) AS found FROM c),
k AS (SELECT *, least(1, CAST(found AS DOUBLE) / 5 * CAST(1.2 AS DOUBLE)) AS c0 FROM n),
l AS (SELECT *, CASE WHEN p IS NOT NULL THEN least(1, c0 + CAST(0.2 AS DOUBLE)) ELSE c0 END AS c1 FROM k)
SELECT doc_id, coalesce(ramc, samc) AS amc_name, CAST(NULL AS VARCHAR) AS scheme_name, m AS period_month, y AS period_year, CAST(NULL AS VARCHAR) AS scheme_category, dt AS doc_type,
 round(CASE WHEN ramc IS NOT NULL THEN least(1, c1 + CAST(0.1 AS DOUBLE)) ELSE c1 END, 6) AS confidence, found AS signals_found FROM l
UNION ALL SELECT doc_id, NULL, NULL, NULL, NULL, NULL, NULL, CASE WHEN file_type IN ('pdf', 'xlsx', 'xls') THEN 0.1 ELSE 0.0 END, 0 FROM a
 WHERE NOT (file_type IN ('pdf', 'xlsx', 'xls') AND regexp_matches(t, '\S'))"""


@query("signal_filename", filename_sql())
def signal_filename(spark, sf):
    return _flat(G.with_filename_signal(docs(spark, sf), fuzzy=False), "filename_signal")


@query("signal_filename_spaced", filename_sql(space=True))
def signal_filename_spaced(spark, sf):
    return _flat(G.with_filename_signal(docs(spark, sf), fuzzy=False, separators="space"), "filename_signal")


@query("signal_url", url_sql())
def signal_url(spark, sf):
    return _flat(G.with_url_signal(docs(spark, sf)), "url_signal")


@query("signal_page_context", page_sql())
def signal_page_context(spark, sf):
    return _flat(G.with_page_context_signal(docs(spark, sf), fuzzy=False), "page_context_signal")


@query("signal_doc_header", header_sql())
def signal_doc_header(spark, sf):
    return _flat(G.with_doc_header_signal(docs(spark, sf), fuzzy=False), "doc_header_signal")


# ---------------------------------------------------------------------------
# Fuzzy lookups
# ---------------------------------------------------------------------------
def _candidate_rows() -> str:
    rows = ", ".join(f"({i}, {p}, {S.q(c)})" for i, (c, p) in enumerate(Z.candidate_names()))
    return f"(VALUES {rows}) v(ord, pos, cand)"


def _scheme_rows() -> str:
    rows = ", ".join(f"({i}, {S.q(s.scheme_name)}, {S.q(s.category)})" for i, s in enumerate(R.SCHEME_MASTER))
    return f"(VALUES {rows}) v(pos, scheme_name, scheme_category)"


def _masks(cand: str, text: str) -> str:
    """Per sign of ``text`` the bit mask of its places in ``cand``."""
    bits = f"list_sum(list_transform(range(1, len({cand}) + 1), lambda j: CASE WHEN {cand}[j] = ch THEN CAST(1 AS BIGINT) << (j - 1) ELSE 0 END))"
    return f"list_transform(string_split({text}, ''), lambda ch: CAST({bits} AS BIGINT))"


def _lcs(mask_list: str, cand: str) -> str:
    full = f"((CAST(1 AS BIGINT) << len({cand})) - 1)"
    return (
        f"len({cand}) - bit_count(CAST(list_reduce({mask_list}, lambda s, k: "
        f"(((s + (s & k)) | (s - (s & k))) & {full}), {full}) AS BIGINT) & {full})"
    )


@query("fuzzy_filename", rf"""
WITH a AS (SELECT doc_id, lower(regexp_replace(filename, '\.[^.]+$', '')) AS low FROM ({S.DOCS}) d),
n AS (SELECT DISTINCT low, array_to_string(list_sort(list_filter(regexp_split_to_array(low, '\s+'), lambda x: x <> '')), ' ') AS tok FROM a),
c AS (SELECT ord, pos, array_to_string(list_sort(list_filter(regexp_split_to_array(cand, '\s+'), lambda x: x <> '')), ' ') AS ctok FROM {_candidate_rows()}),
s AS (SELECT low, ord, pos, CAST(200.0 AS DOUBLE) * ({_lcs(_masks('ctok', 'tok'), 'ctok')}) / (len(tok) + len(ctok)) AS score FROM n, c
  WHERE 200.0 * least(len(tok), len(ctok)) / (len(tok) + len(ctok)) > {R.FUZZY_FILENAME_CUT}),
b AS (SELECT low, arg_min(pos, ord) AS pos, max(score) AS score FROM (SELECT *, max(score) OVER (PARTITION BY low) AS top FROM s WHERE score > {R.FUZZY_FILENAME_CUT}) t WHERE score = top GROUP BY low)
SELECT a.doc_id, m.scheme_name, m.scheme_category, round(b.score, 6) AS score FROM a JOIN b ON a.low = b.low JOIN {_scheme_rows().replace(') v(', ') m(')} ON m.pos = b.pos""")
def fuzzy_filename(spark, sf):
    from holdsift.functions.urls import file_stem

    d = docs(spark, sf).select(
        "doc_id", Z.scheme_by_name(F.lower(file_stem(F.col("filename"))), R.FUZZY_FILENAME_CUT).alias("f")
    )
    return d.filter(F.col("f.scheme_name").isNotNull()).select(
        "doc_id", "f.scheme_name", "f.scheme_category", F.round("f.score", 6).alias("score")
    )


@query("fuzzy_text")
def fuzzy_text(spark, sf):
    """Whole document texts against every scheme name (the header cut)."""
    t = I.table(spark, sf, "documents", spread=True)
    d = t.select("doc_id", Z.scheme_in_text(F.lower("text"), R.FUZZY_HEADER_CUT).alias("f"))
    return d.select("doc_id", "f.scheme_name", "f.scheme_category", F.round("f.score", 6).alias("score"))


@query("fuzzy_page_header")
def fuzzy_page_header(spark, sf):
    d = docs(spark, sf).select(
        "doc_id",
        Z.scheme_in_text(F.lower(G.page_text(F.col("page_context"))), R.FUZZY_PAGE_CUT).alias("p"),
        Z.scheme_in_text(F.lower("header_text"), R.FUZZY_HEADER_CUT).alias("h"),
    )
    return d.select(
        "doc_id", F.col("p.scheme_name").alias("page_scheme"), F.round("p.score", 6).alias("page_score"),
        F.col("h.scheme_name").alias("header_scheme"), F.round("h.score", 6).alias("header_score"),
    )


def _partial_sql() -> str:
    """Best window score of every (sheet, candidate) pair; the shorter text is the needle, both when equally long."""
    win = "substr(hay, CAST(greatest(st, 1) AS INT), CAST(least(st + len(needle), len(hay) + 1) - greatest(st, 1) AS INT))"
    return rf"""
x AS (SELECT sheet, ord, pos, CASE WHEN len(sheet) < len(cand) THEN sheet ELSE cand END AS needle, CASE WHEN len(sheet) < len(cand) THEN cand ELSE sheet END AS hay FROM sh, {_candidate_rows()}
 UNION ALL SELECT sheet, ord, pos, sheet, cand FROM sh, {_candidate_rows()} WHERE len(sheet) = len(cand)),
w AS (SELECT sheet, ord, pos, needle, {win} AS win FROM (SELECT *, unnest(range(2 - len(needle), len(hay) + 1)) AS st FROM x) t),
s AS (SELECT sheet, ord, pos, max(CAST(200.0 AS DOUBLE) * ({_lcs(_masks('needle', 'win'), 'needle')}) / (len(needle) + len(win))) AS score FROM (SELECT DISTINCT * FROM w WHERE win <> '') w GROUP BY sheet, ord, pos)"""


@query("fuzzy_sheet", rf"""
WITH d AS (SELECT doc_id, unnest([sheet1, sheet2]) AS name, unnest([0, 1]) AS si FROM ({S.DOCS}) x),
sh AS (SELECT DISTINCT lower(name) AS sheet FROM d), {_partial_sql()},
g AS (SELECT DISTINCT sheet, pos FROM s WHERE score > {R.FUZZY_SHEET_CUT}),
j AS (SELECT doc_id, arg_max(pos, si * 1000 + pos) AS pos, count(*) AS hits FROM d JOIN g ON lower(d.name) = g.sheet GROUP BY doc_id)
SELECT j.doc_id, m.scheme_name, m.scheme_category, CAST(hits AS INT) AS hits FROM j JOIN {_scheme_rows().replace(') v(', ') m(')} ON m.pos = j.pos""")
def fuzzy_sheet(spark, sf):
    d = docs(spark, sf).select("doc_id", Z.scheme_by_sheets(F.col("sheet_names"), R.FUZZY_SHEET_CUT).alias("f"))
    return d.filter(F.col("f.hits") > 0).select("doc_id", "f.scheme_name", "f.scheme_category", "f.hits")


# ---------------------------------------------------------------------------
# Fusion
# ---------------------------------------------------------------------------
_CH = [("dh", "doc_header"), ("pc", "page_context"), ("fn", "filename"), ("ur", "url")]


def _fused_ctes() -> str:
    def best(field):
        items = ", ".join(
            f"{{'s': CAST({R.WEIGHTS[name]} AS DOUBLE) * {a}.confidence, 'p': {-i}, 'v': {a}.{field}}}" for i, (a, name) in enumerate(_CH)
        )
        return f"list_sort(list_filter([{items}], lambda z: z.v IS NOT NULL), 'DESC')[1].v AS {field}"

    w = " + ".join(f"CAST({R.WEIGHTS[name]} AS DOUBLE) * {a}.confidence" for a, name in _CH)
    amcs = "list_filter([" + ", ".join(f"trim(lower({a}.amc_name))" for a, _ in _CH) + "], lambda z: z <> '')"
    pers = "list_filter([" + ", ".join(f"CAST({a}.period_month AS VARCHAR) || '-' || CAST({a}.period_year AS VARCHAR)" for a, _ in _CH) + "], lambda z: z IS NOT NULL)"
    mons = "list_filter([" + ", ".join(f"{a}.period_month" for a, _ in _CH) + "], lambda z: z IS NOT NULL)"
    return f"""
dh AS ({header_sql()}), pc AS ({page_sql()}), fn AS ({filename_sql()}), ur AS ({url_sql()}), src AS (SELECT doc_id, source_amc FROM ({S.DOCS}) d),
f0 AS (SELECT src.doc_id, src.source_amc, {", ".join(best(f) for f in FIELDS)}, {w} AS weighted, {amcs} AS amcs, {pers} AS pers, {mons} AS mons
 FROM src JOIN dh ON src.doc_id = dh.doc_id JOIN pc ON src.doc_id = pc.doc_id JOIN fn ON src.doc_id = fn.doc_id JOIN ur ON src.doc_id = ur.doc_id),
f1 AS (SELECT * REPLACE (coalesce(amc_name, source_amc) AS amc_name),
 CASE WHEN coalesce(list_max(list_transform(amcs, lambda z: len(list_filter(amcs, lambda y: y = z)))), 0) >= 3 THEN CAST(0.05 AS DOUBLE)
  WHEN len(amcs) = 2 AND len(list_distinct(amcs)) = 1 THEN CAST(0.025 AS DOUBLE) ELSE 0 END +
 CASE WHEN len(pers) >= 3 AND len(list_distinct(pers)) = 1 THEN CAST(0.05 AS DOUBLE) WHEN len(pers) = 2 AND len(list_distinct(pers)) = 1 THEN CAST(0.025 AS DOUBLE) ELSE 0 END AS bonus,
 len(list_distinct(amcs)) > 1 AS amc_conflict, lower(source_amc) <> lower(coalesce(amc_name, source_amc)) AS amc_mismatch, len(list_distinct(mons)) > 1 AS month_conflict FROM f0),
f2 AS (SELECT *, CASE WHEN amc_conflict THEN CAST(0.15 AS DOUBLE) ELSE 0 END + CASE WHEN amc_mismatch THEN CAST(0.075 AS DOUBLE) ELSE 0 END + CASE WHEN month_conflict THEN CAST(0.075 AS DOUBLE) ELSE 0 END AS penalty,
  CAST(date_diff('day', make_date(period_year, period_month, 1), DATE '{AS_OF}') AS DOUBLE) / 30 AS age FROM f1),
f3 AS (SELECT *, greatest(0, least(1, weighted + bonus - penalty)) AS score FROM f2),
f4 AS (SELECT *, CASE WHEN score >= CAST(0.85 AS DOUBLE) THEN 'AUTO_ACCEPT' WHEN score >= CAST(0.7 AS DOUBLE) THEN 'ACCEPT_WITH_FLAG' WHEN score >= CAST(0.5 AS DOUBLE) THEN 'QUARANTINE' ELSE 'REJECT' END AS tier,
  period_month IS NULL OR period_year IS NULL AS no_period, coalesce(age > 6, false) AS stale FROM f3),
f5 AS (SELECT *, CASE WHEN amc_name IS NULL THEN 'QUARANTINE' WHEN stale AND tier IN ('AUTO_ACCEPT', 'ACCEPT_WITH_FLAG') THEN 'QUARANTINE'
  WHEN no_period AND tier = 'AUTO_ACCEPT' THEN 'ACCEPT_WITH_FLAG' ELSE tier END AS decision FROM f4)"""


def _fused(spark, sf):
    s = with_signals(docs(spark, sf), fuzzy=False)
    # the plain-SQL twin reads channel confidences rounded to six places
    for c in ("filename_signal", "url_signal", "page_context_signal", "doc_header_signal"):
        s = s.withColumn(c, F.col(c).withField("confidence", F.round(F.col(c)["confidence"], 6)))
    return fuse(s, as_of=AS_OF)


@query("fusion_confidence", f"""
WITH {_fused_ctes()} SELECT doc_id, {", ".join(FIELDS)}, round(weighted, 6) AS weighted_score, round(bonus, 6) AS agreement_bonus, round(penalty, 6) AS disagreement_penalty,
 round(score, 6) AS confidence_score, CAST(round(score * 100) AS INT) AS confidence_pct FROM f5""")
def fusion_confidence(spark, sf):
    return _fused(spark, sf).select(
        "doc_id", *FIELDS, *[F.round(c, 6).alias(c) for c in
                             ("weighted_score", "agreement_bonus", "disagreement_penalty", "confidence_score")],
        percent_label(F.col("confidence_score")).alias("confidence_pct"),
    )


_LABEL = "CASE period_month " + " ".join(f"WHEN {i + 1} THEN '{m}'" for i, m in enumerate(R.MONTH_LABELS)) + " END || ' ' || CAST(period_year AS VARCHAR)"


@query("fusion_decision", f"""
WITH {_fused_ctes()} SELECT doc_id, decision, decision IN ('QUARANTINE', 'REJECT') AS is_quarantined, {_LABEL} AS period_label,
 period_month IS NULL OR period_month BETWEEN 1 AND 12 AS month_ok FROM f5""")
def fusion_decision(spark, sf):
    return _fused(spark, sf).select(
        "doc_id", "decision", "is_quarantined", "period_label",
        month_in_range(F.col("period_month")).alias("month_ok"),
    )


@query("quarantine_reason", f"""
WITH {_fused_ctes()},
g AS (SELECT *, array_to_string(list_filter([CASE WHEN amc_conflict THEN 'AMC_CONFLICT' END, CASE WHEN amc_mismatch THEN 'AMC_MISMATCH' END, CASE WHEN month_conflict THEN 'PERIOD_CONFLICT' END,
  CASE WHEN tier = 'QUARANTINE' THEN 'BELOW_ACCEPT' END, CASE WHEN tier = 'REJECT' THEN 'BELOW_QUARANTINE' END, CASE WHEN amc_name IS NULL THEN 'NO_AMC' END,
  CASE WHEN no_period THEN 'NO_PERIOD' END, CASE WHEN stale THEN 'STALE' END], lambda z: z IS NOT NULL), ',') AS codes FROM f5)
SELECT quarantine_reason, quarantine_reason_compat, codes, count(*) AS documents FROM (SELECT codes,
 CASE WHEN decision = 'REJECT' THEN 'LOW_CONFIDENCE' WHEN amc_conflict OR month_conflict THEN 'CLASSIFICATION_CONFLICT' WHEN stale THEN 'STALE_PERIOD' WHEN scheme_name IS NULL THEN 'UNKNOWN_SCHEME' ELSE 'LOW_CONFIDENCE' END AS quarantine_reason,
 CASE WHEN decision = 'REJECT' THEN 'LOW_CONFIDENCE' WHEN amc_conflict OR month_conflict THEN 'CLASSIFICATION_CONFLICT' WHEN stale OR tier IN ('QUARANTINE', 'REJECT') THEN 'STALE_PERIOD' ELSE 'LOW_CONFIDENCE' END AS quarantine_reason_compat
 FROM g WHERE decision IN ('QUARANTINE', 'REJECT')) t GROUP BY quarantine_reason, quarantine_reason_compat, codes""")
def quarantine_reason(spark, sf):
    return _fused(spark, sf).filter("is_quarantined").groupBy(
        "quarantine_reason", "quarantine_reason_compat", F.array_join("reason_codes", ",").alias("codes")
    ).agg(F.count(F.lit(1)).alias("documents"))


@query("extra_triggers", f"""
WITH {_fused_ctes()}, h AS (SELECT f5.*, dh.amc_name AS hamc, sha256(CAST(f5.doc_id % 400 AS VARCHAR)) AS ch FROM f5 JOIN dh ON f5.doc_id = dh.doc_id),
s AS (SELECT ch, min(scheme_name) <> max(scheme_name) AS dup FROM h GROUP BY ch)
SELECT doc_id, coalesce(age > 3, false) AS stale_strict, scheme_name IS NULL AS unknown_scheme, coalesce(lower(hamc) <> lower(source_amc), false) AS header_amc_mismatch,
 coalesce(dup, false) AS duplicate_content FROM h JOIN s ON h.ch = s.ch""")
def extra_triggers_query(spark, sf):
    f = extra_triggers(_fused(spark, sf), AS_OF).withColumn("content_hash", F.sha2((F.col("doc_id") % 400).cast("string"), 256))
    return shared_content(f).select("doc_id", "stale_strict", "unknown_scheme", "header_amc_mismatch", "duplicate_content")


@query("classify_documents")
def classify_documents(spark, sf):
    """Everything on, fuzzy lookups included."""
    c = classify(docs(spark, sf), AS_OF, keep=("doc_id", "source_id"))
    return c.select(
        "doc_id", "source_id", *FIELDS, "period_label", F.round("confidence_score", 6).alias("confidence_score"),
        "decision", "is_quarantined", "quarantine_reason",
    )
