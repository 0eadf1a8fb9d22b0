"""Queries over URLs, pages and responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import html as H
from holdsift.functions import urls as U
from holdsift.operators import links as L
from holdsift.plans import inputs as I
from holdsift.plans import sqltext as S
from holdsift.plans.registry import query
from holdsift.sources import registry as SR

LINKS_SQL = (
    "SELECT 'page' AS src, page_id AS id, url FROM pages UNION ALL "
    f"SELECT 'doc' AS src, doc_id AS id, url FROM ({S.DOCS}) d"
)


def _all_urls(spark, sf):
    pages = I.table(spark, sf, "pages", spread=True).select(F.lit("page").alias("src"), F.col("page_id").alias("id"), "url")
    docs = I.derive(spark, sf, I.DOCS, spread=True).select(F.lit("doc").alias("src"), F.col("doc_id").alias("id"), "url")
    return pages.unionByName(docs)


def _query_text(drop):
    return (
        "SELECT src, id, string_agg(k || '=' || v, '&' ORDER BY k) AS qs FROM qp "
        f"WHERE lower(k) NOT IN {S.in_list(drop)} GROUP BY src, id"
    )


@query("url_normalize", f"""
WITH b AS ({LINKS_SQL}), {S.url_ctes('b', 'src, id')},
n AS ({_query_text(R.VOLATILE_PARAMS)})
SELECT u.src, u.id, scheme || '://' || host || path || CASE WHEN qs IS NULL THEN '' ELSE '?' || qs END AS normalized
FROM u LEFT JOIN n ON u.src = n.src AND u.id = n.id""")
def url_normalize(spark, sf):
    return _all_urls(spark, sf).select("src", "id", U.normalize_url(F.col("url")).alias("normalized"))


@query("url_fingerprint", f"""
WITH b AS ({LINKS_SQL}), {S.url_ctes('b', 'src, id')},
n AS ({_query_text(R.VOLATILE_PARAMS)}),
f AS (SELECT u.src, u.id, sha256(scheme || '://' || host || path || CASE WHEN qs IS NULL THEN '' ELSE '?' || qs END) AS fp
 FROM u LEFT JOIN n ON u.src = n.src AND u.id = n.id)
SELECT fp AS url_fingerprint, count(*) AS urls, min(src) AS first_src, min(id) AS first_id FROM f GROUP BY fp""")
def url_fingerprint(spark, sf):
    fp = _all_urls(spark, sf).withColumn("url_fingerprint", U.url_fingerprint(F.col("url")))
    return fp.groupBy("url_fingerprint").agg(
        F.count(F.lit(1)).alias("urls"), F.min("src").alias("first_src"), F.min("id").alias("first_id")
    )


_EXT_PATH = "regexp_replace(path, '/{2,}', '/', 'g')"


@query("url_extended", f"""
WITH b AS ({LINKS_SQL}), {S.url_ctes('b', 'src, id')},
n AS ({_query_text(R.VOLATILE_PARAMS + R.TRACKING_PARAMS)}),
e AS (SELECT u.src, u.id, scheme, qs, CASE scheme WHEN 'http' THEN regexp_replace(lower(host), ':80$', '')
  WHEN 'https' THEN regexp_replace(lower(host), ':443$', '') ELSE lower(host) END AS h, {_EXT_PATH} AS p
 FROM u LEFT JOIN n ON u.src = n.src AND u.id = n.id)
SELECT src, id, scheme || '://' || h || lower(regexp_replace({S.fold_dots('p')}, '/+$', '')) ||
 CASE WHEN qs IS NULL THEN '' ELSE '?' || qs END AS normalized FROM e""")
def url_extended(spark, sf):
    return _all_urls(spark, sf).select(
        "src", "id", U.normalize_url(F.col("url"), "extended", lower_path=True).alias("normalized")
    )


@query("url_parts", f"""
WITH b AS ({LINKS_SQL}), {S.url_ctes('b', 'src, id')},
m AS (SELECT src, id, string_agg(k || '=' || v, '|' ORDER BY i) AS params, count(*) AS n_params FROM qp GROUP BY src, id)
SELECT u.src, u.id, lower(host) AS domain, array_to_string(list_filter(string_split(lower(path), '/'), lambda s: s <> ''), '|') AS segments,
 coalesce(params, '') AS params, coalesce(n_params, 0) AS n_params
FROM u LEFT JOIN m ON u.src = m.src AND u.id = m.id""")
def url_parts(spark, sf):
    q = _all_urls(spark, sf).select(
        "src", "id", U.source_domain(F.col("url")).alias("domain"),
        F.array_join(U.path_segments(F.col("url")), "|").alias("segments"),
        U.query_map(F.col("url")).alias("m"),
    )
    firsts = F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"][0]))
    return q.select(
        "src", "id", "domain", "segments",
        F.array_join(firsts, "|").alias("params"), F.size("m").cast("bigint").alias("n_params"),
    )


@query("file_name_type", rf"""
WITH b AS (SELECT doc_id, url, filename, CASE doc_id % 6 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/vnd.ms-excel'
  WHEN 2 THEN 'text/csv; charset=utf-8' WHEN 3 THEN 'application/zip' WHEN 4 THEN 'text/html' ELSE NULL END AS content_type FROM ({S.DOCS}) d),
u AS (SELECT *, {S.URL_PARTS} FROM b),
f AS (SELECT *, {S.FILENAME.format(n=S.last_segment('path'))} AS url_name FROM u)
SELECT doc_id, url_name,
 coalesce(CASE WHEN {S.extension('url_name')} IN {S.in_list(R.DOCUMENT_EXTENSIONS)} THEN {S.extension('url_name')} END,
  {S.case_contains('lower(content_type)', R.CONTENT_TYPE_RULES)}) AS file_type,
 lower(regexp_replace(filename, '\.[^.]+$', '')) AS stem,
 array_to_string(regexp_split_to_array(lower(regexp_replace(filename, '\.[^.]+$', '')), '[_\-\s.]+'), '|') AS tokens
FROM f""")
def file_name_type(spark, sf):
    ct = F.expr(
        "CASE doc_id % 6 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'application/vnd.ms-excel' "
        "WHEN 2 THEN 'text/csv; charset=utf-8' WHEN 3 THEN 'application/zip' WHEN 4 THEN 'text/html' ELSE NULL END"
    )
    d = I.derive(spark, sf, I.DOCS).withColumn("content_type", ct)
    return d.select(
        "doc_id", U.filename_from_url(F.col("url")).alias("url_name"),
        U.file_type(F.col("url"), F.col("content_type")).alias("file_type"),
        F.lower(U.file_stem(F.col("filename"))).alias("stem"),
        F.array_join(U.stem_tokens(F.col("filename")), "|").alias("tokens"),
    )


_NOISE = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_ENT = "replace(replace(replace(replace(replace(replace({x}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&nbsp;', chr(160)), '&amp;', '&')"
# Links of the given pages are site-relative words, so a short word list stands in for the document words.
LINK_WORDS = r"the|on|de|la|en"

PAGE_LINK_CTES = rf"""
t AS (SELECT page_id, url AS page_url, unnest(regexp_extract_all(regexp_replace(html, {S.q(_NOISE)}, '', 'g'), '(?is)<a\s[^>]*>')) AS tag,
  generate_subscripts(regexp_extract_all(regexp_replace(html, {S.q(_NOISE)}, '', 'g'), '(?is)<a\s[^>]*>'), 1) - 1 AS seq FROM pages),
h AS (SELECT page_id, page_url, CAST(seq AS INT) AS seq, {_ENT.format(x="regexp_extract(tag, '(?is)\\shref\\s*=\\s*\"([^\"]*)\"', 1)")} AS href FROM t),
r AS (SELECT page_id, seq, page_url, href, regexp_extract(page_url, '^([a-z]+://[^/?#]*)', 1) || CASE WHEN starts_with(href, '/') THEN href ELSE '/' || href END AS url FROM h WHERE href <> '')
"""


@query("page_links", rf"""
WITH {PAGE_LINK_CTES},
u AS (SELECT page_id, seq, page_url, href, url, {S.URL_PARTS} FROM r)
SELECT page_id, seq, url, {S.FILENAME.format(n=S.last_segment('path'))} AS filename FROM u
WHERE regexp_matches(lower(path), '\.(xlsx|pdf|zip)$') OR (regexp_matches(lower(url), {S.q(LINK_WORDS)})
 AND NOT {S.any_contains('lower(url)', R.NAVIGATION_MARKS)})""")
def page_links(spark, sf):
    links = L.page_links(I.table(spark, sf, "pages", spread=True), words=LINK_WORDS, keep=["page_id"])
    return links.select("page_id", F.col("seq").cast("int").alias("seq"), "url", "filename")


_TOK = rf"""
c AS (SELECT page_id, regexp_replace(html, {S.q(_NOISE)}, '', 'g') AS h FROM pages)
"""
_VOID = S.in_list(R.VOID_TAGS)


@query("page_structure_hash", rf"""
WITH {_TOK},
b AS (SELECT page_id, regexp_extract(h, '(?is)(<body\b.*?)(?:</body\s*>|$)', 1) AS body FROM c),
x AS (SELECT page_id, unnest(regexp_extract_all(body, '(?s)</?[A-Za-z][^>]*>')) AS tag,
  generate_subscripts(regexp_extract_all(body, '(?s)</?[A-Za-z][^>]*>'), 1) AS i FROM b),
n AS (SELECT *, lower(regexp_extract(tag, '^</?([A-Za-z][A-Za-z0-9\-]*)', 1)) AS name, starts_with(tag, '</') AS closing FROM x),
d AS (SELECT *, coalesce(sum(CASE WHEN closing AND name NOT IN {_VOID} THEN -1 WHEN name IN {_VOID} THEN 0 ELSE 1 END)
  OVER (PARTITION BY page_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS depth FROM n),
k AS (SELECT page_id, i, CASE WHEN depth <= {R.STRUCTURE_DEPTH} THEN name || '.' || substr(trim(regexp_extract(tag, '(?i)\sclass\s*=\s*"([^"]*)"', 1)), 1, 50)
   || '#' || regexp_extract(tag, '(?i)\sid\s*=\s*"([^"]*)"', 1) ELSE '' END AS node FROM d WHERE NOT closing AND depth <= {R.STRUCTURE_DEPTH + 1})
SELECT page_id, substr(sha256(string_agg(node, '>' ORDER BY i)), 1, 16) AS page_structure_hash, string_agg(node, '>' ORDER BY i) AS structure
FROM k GROUP BY page_id""")
def page_structure_hash(spark, sf):
    p = I.table(spark, sf, "pages", spread=True)
    s = p.select("page_id", H.structure_sequence(F.col("html")).alias("structure"))
    return s.select("page_id", F.substring(F.sha2("structure", 256), 1, 16).alias("page_structure_hash"), "structure")


@query("link_context", rf"""
WITH {_TOK},
x AS (SELECT page_id, unnest(regexp_extract_all(h, '(?s)<[^>]*>|[^<]+')) AS raw, generate_subscripts(regexp_extract_all(h, '(?s)<[^>]*>|[^<]+'), 1) AS i FROM c),
n AS (SELECT *, lower(regexp_extract(raw, '^</?([A-Za-z][A-Za-z0-9\-]*)', 1)) AS name,
  CASE WHEN NOT starts_with(raw, '<') THEN 'text' WHEN NOT regexp_matches(raw, '^</?[A-Za-z]') THEN 'other'
   WHEN lower(regexp_extract(raw, '^</?([A-Za-z][A-Za-z0-9\-]*)', 1)) IN {_VOID} THEN 'void' WHEN starts_with(raw, '</') THEN 'close' ELSE 'open' END AS kind FROM x),
d AS (SELECT *, sum(CASE kind WHEN 'open' THEN 1 WHEN 'close' THEN -1 ELSE 0 END) OVER (PARTITION BY page_id ORDER BY i) - CASE WHEN kind = 'open' THEN 1 ELSE 0 END AS depth FROM n),
a AS (SELECT page_id, i, depth, raw, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS link_idx FROM d WHERE kind = 'open' AND name = 'a'
  AND regexp_extract(raw, '(?is)\shref\s*=\s*"([^"]*)"', 1) <> ''),
p AS (SELECT a.page_id, a.i, a.link_idx, a.depth, a.raw, (SELECT max(d.i) FROM d WHERE d.page_id = a.page_id AND d.kind = 'open' AND d.i < a.i AND d.depth = a.depth - 1) AS p_at,
  (SELECT max(d.i) FROM d WHERE d.page_id = a.page_id AND d.kind = 'open' AND d.i < a.i AND d.depth = a.depth - 2) AS g_at,
  (SELECT min(d.i) FROM d WHERE d.page_id = a.page_id AND d.kind = 'close' AND d.i > a.i AND d.depth = a.depth) AS a_end FROM a),
e AS (SELECT p.*, (SELECT min(d.i) FROM d WHERE d.page_id = p.page_id AND d.kind = 'close' AND d.i > p.p_at AND d.depth = p.depth - 1) AS p_end,
  (SELECT min(d.i) FROM d WHERE d.page_id = p.page_id AND d.kind = 'close' AND d.i > p.g_at AND d.depth = p.depth - 2) AS g_end FROM p),
s AS (SELECT page_id, len(regexp_extract_all(h, '(?is)<select\b.*?</select\s*>')) AS n_dropdowns FROM c)
SELECT e.page_id, CAST(e.link_idx AS INT) AS link_idx,
 substr(trim({_ENT.format(x="coalesce((SELECT string_agg(d.raw, '' ORDER BY d.i) FROM d WHERE d.page_id = e.page_id AND d.kind = 'text' AND d.i > e.i AND d.i < e.a_end), '')")}), 1, 200) AS link_text,
 substr(trim({_ENT.format(x="coalesce((SELECT string_agg(d.raw, '' ORDER BY d.i) FROM d WHERE d.page_id = e.page_id AND d.kind = 'text' AND d.i > e.p_at AND d.i < e.p_end), '')")}), 1, 500) AS parent_text,
 substr(trim({_ENT.format(x="coalesce((SELECT string_agg(d.raw, '' ORDER BY d.i) FROM d WHERE d.page_id = e.page_id AND d.kind = 'text' AND d.i > e.g_at AND d.i < e.g_end), '')")}), 1, 500) AS grandparent_text,
 {_ENT.format(x="regexp_extract(e.raw, '(?is)\\stitle\\s*=\\s*\"([^\"]*)\"', 1)")} AS title,
 {_ENT.format(x="regexp_extract(e.raw, '(?is)\\saria-label\\s*=\\s*\"([^\"]*)\"', 1)")} AS aria_label,
 coalesce(array_to_string(list_transform(regexp_extract_all(e.raw, '(?is)\s(data-[^\s=/>]+\s*=\s*"[^"]*")', 1),
  lambda x: lower(regexp_extract(x, '^[^\s=]+')) || '=' || regexp_extract(x, '(?s)"([^"]*)"', 1)), '|'), '') AS data_attrs,
 CAST(s.n_dropdowns AS INT) AS n_dropdowns
FROM e JOIN s ON s.page_id = e.page_id""")
def link_context(spark, sf):
    pages = I.table(spark, sf, "pages", spread=True)
    p = pages.select("page_id", H.dropdowns(F.col("html")).alias("drop"), F.explode(H.anchors(F.col("html"))).alias("a"))
    listed = lambda pairs: F.array_join(F.transform(pairs, lambda x: F.concat(x["k"], F.lit("="), x["v"])), "|")
    return p.select(
        "page_id", "a.link_idx", "a.link_text", "a.parent_text", "a.grandparent_text", "a.title", "a.aria_label",
        listed(F.col("a.data_attrs")).alias("data_attrs"), F.size("drop").alias("n_dropdowns"))


_CTYPE = (
    "CASE {k} % 7 WHEN 0 THEN 'application/pdf' WHEN 1 THEN 'text/html' WHEN 2 THEN 'APPLICATION/ZIP; q=1' "
    "WHEN 3 THEN 'application/json' WHEN 4 THEN 'application/vnd.ms-excel' ELSE '' END"
)
PATTERNS = ["/docs/*/doc_1*", "/portfolio/20?4/*"]


@query("response_select", rf"""
WITH d AS (SELECT *, {_CTYPE.format(k='doc_id')} AS content_type FROM ({S.DOCS}) x),
k AS (SELECT source_id, 0 AS origin, doc_id AS seq, url, content_type FROM d
  WHERE {S.any_contains('lower(content_type)', R.DOCUMENT_MIME_TYPES)}
   OR {" OR ".join(f"regexp_matches(url, {S.q(U.glob_regex(p))})" for p in PATTERNS)}
  UNION ALL SELECT source_id, 1, doc_id, url, '' FROM d WHERE (regexp_matches(lower(regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')), '\.(xlsx|pdf|zip)$')
   OR (regexp_matches(lower(url), {S.q(R.DOCUMENT_URL_WORDS)}) AND NOT {S.any_contains('lower(url)', R.NAVIGATION_MARKS)}))),
f AS (SELECT *, row_number() OVER (PARTITION BY source_id, url ORDER BY origin, seq) AS rn FROM k)
SELECT source_id, url, CAST(origin AS INT) AS origin, seq, content_type FROM f WHERE rn = 1""")
def response_select(spark, sf):
    d = I.derive(spark, sf, I.DOCS).withColumn("content_type", F.expr(_CTYPE.format(k="doc_id")))
    responses = d.select("source_id", F.col("doc_id").alias("seq"), "url", "content_type")
    links = d.filter(U.is_document_url(F.col("url"))).select(
        "source_id", F.col("doc_id").alias("seq"), "url"
    )
    got = L.response_documents(responses, links, PATTERNS, ["source_id"])
    return got.select("source_id", "url", "origin", "seq", "content_type")


@query("discover_dispatch", rf"""
WITH {PAGE_LINK_CTES},
l AS (SELECT ['sbi_mf', 'hdfc_mf', 'nippon_india'][CAST(page_id % 3 AS INT) + 1] AS source_key, page_id, url FROM r
  WHERE regexp_matches(href, '\.(xlsx|xls|pdf)') OR (page_id % 3 = 1 AND regexp_matches(href, 'portfolio|download'))),
o AS (SELECT source_key, url, lower(regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), ';[^/]*$', '')) AS p FROM l),
w AS (SELECT source_key, url FROM o WHERE regexp_matches(p, '\.(xlsx|xls|pdf)$') OR (regexp_matches(lower(url), {S.q(R.DOCUMENT_URL_WORDS)}) AND NOT {S.any_contains('lower(url)', R.NAVIGATION_MARKS)})),
s AS (SELECT ['sbi_mf', 'hdfc_mf', 'nippon_india'][source_id + 1] AS source_key, url, {_CTYPE.format(k='doc_id')} AS ct FROM ({S.DOCS}) x),
n AS (SELECT source_key, url FROM s WHERE source_key <> 'nippon_india' AND ({S.any_contains('lower(ct)', R.DOCUMENT_MIME_TYPES)}
  OR (source_key = 'sbi_mf' AND ({" OR ".join(f"regexp_matches(url, {S.q(U.glob_regex(p))})" for p in R.SOURCES[0]["api_patterns"])})))
  UNION ALL SELECT source_key, url FROM w WHERE source_key <> 'nippon_india'),
z AS (SELECT DISTINCT source_key, url FROM n UNION ALL SELECT source_key, url FROM w WHERE source_key = 'nippon_india')
SELECT source_key, url, count(*) AS found FROM z GROUP BY source_key, url""")
def discover_dispatch(spark, sf):
    keys = F.array(*[F.lit(s["source_key"]) for s in R.SOURCES])
    pages = I.table(spark, sf, "pages", spread=True).withColumn("source_key", F.get(keys, (F.col("page_id") % 3).cast("int")))
    resp = I.derive(spark, sf, I.DOCS).select(
        F.get(keys, F.col("source_id")).alias("source_key"), F.col("doc_id").alias("seq"), "url",
        F.expr(_CTYPE.format(k="doc_id")).alias("content_type"),
    )
    found = L.discover(pages, resp, SR.sources(spark), run_id="run-1")
    return found.groupBy("source_key", "url").agg(F.count(F.lit(1)).alias("found"))
