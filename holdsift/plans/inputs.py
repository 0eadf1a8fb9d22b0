"""Inputs for the registered queries, derived from the given tables.

Each is one SQL text that Spark and a plain SQL engine both run; ``{orders}`` and the
like stand for the table.  Sizes follow the tables: every order is a document, every
line a holding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from holdsift.session import ship

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]

_MONTH3 = "substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(3*month(o_orderdate)-2 AS INT), 3)"
_MONTH_FULL = (
    "CASE month(o_orderdate) WHEN 1 THEN 'January' WHEN 2 THEN 'February' WHEN 3 THEN 'March' WHEN 4 THEN 'April' "
    "WHEN 5 THEN 'May' WHEN 6 THEN 'June' WHEN 7 THEN 'July' WHEN 8 THEN 'August' WHEN 9 THEN 'September' "
    "WHEN 10 THEN 'October' WHEN 11 THEN 'November' ELSE 'December' END"
)
_YEAR = "CAST(year(o_orderdate) + 25 AS STRING)"
_YEAR2 = "substr(CAST(year(o_orderdate) + 25 AS STRING), 3, 2)"
_SCHEME = (
    "CASE o_custkey % 11 WHEN 0 THEN 'SBI Bluechip' WHEN 1 THEN 'SBI Small Cap Fund' WHEN 2 THEN 'SBI Magnum Medium' "
    "WHEN 3 THEN 'HDFC Top 100 Fund' WHEN 4 THEN 'HDFC Liquid' WHEN 5 THEN 'HDFC Balanced Advantage' "
    "WHEN 6 THEN 'Nippon Growth' WHEN 7 THEN 'Nippon India Arbitrage Fund' WHEN 8 THEN 'Axis Gilt' "
    "WHEN 9 THEN 'Quarterly Letter' ELSE 'Holdings Annex' END"
)
_AMC = (
    "CASE o_custkey % 3 WHEN 0 THEN 'SBI Mutual Fund' WHEN 1 THEN 'HDFC Mutual Fund' ELSE 'Nippon India Mutual Fund' END"
)

# One document per order: link, filename, page context, header text, sheets, bytes hash stand-in.
DOCS = f"""
SELECT o_orderkey AS doc_id, CAST(o_custkey % 3 AS INT) AS source_id, {_AMC} AS source_amc,
 concat(CASE o_custkey % 3 WHEN 0 THEN 'https://www.SBIMF.com' WHEN 1 THEN 'https://www.hdfcfund.com' ELSE 'HTTPS://cdn.example.org:443' END,
  CASE o_orderkey % 7 WHEN 0 THEN '/portfolio/' WHEN 1 THEN '/downloads/' WHEN 2 THEN '/Factsheet/' WHEN 3 THEN '/docs//x/../'
   WHEN 4 THEN '/statutory-disclosure/' ELSE '/docs/' END,
  CASE o_orderkey % 4 WHEN 3 THEN concat({_MONTH3}, '-', {_YEAR2}) ELSE concat({_YEAR}, '/', lower({_MONTH3})) END,
  '/doc_', CAST(o_orderkey % 5000 AS STRING), CASE o_orderkey % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.XLSX' ELSE '.html' END,
  CASE o_orderkey % 9 WHEN 0 THEN '?t=1&b=2&a=1' WHEN 1 THEN '?month=06&year=26' WHEN 2 THEN '#top'
   WHEN 3 THEN '?Fund=SBI%20Liquid+Fund&type=Debt&cb=7&b=' WHEN 4 THEN '?m=April&yr=2024&m=5&utm_source=x' WHEN 5 THEN ';v=2?y=1999&mon=13' ELSE '' END) AS url,
 concat(replace({_SCHEME}, ' ', CASE o_orderkey % 2 WHEN 0 THEN '_' ELSE ' ' END),
  CASE o_orderkey % 5 WHEN 0 THEN concat('_', {_MONTH3}, '_', {_YEAR}) WHEN 1 THEN concat(' ', {_MONTH_FULL}, ' ', {_YEAR})
   WHEN 2 THEN concat('-', {_MONTH3}, '-', {_YEAR2}) WHEN 3 THEN concat(' portfolio ', {_YEAR2}) ELSE '-monthly' END,
  CASE o_orderkey % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.xlsx' ELSE '.zip' END) AS filename,
 CASE o_orderkey % 3 WHEN 0 THEN 'pdf' WHEN 1 THEN 'xlsx' ELSE 'zip' END AS file_type,
 concat(CASE o_orderkey % 4 WHEN 0 THEN 'Monthly Portfolio ' WHEN 1 THEN 'Factsheet ' WHEN 2 THEN 'Half-yearly report ' ELSE 'Download ' END, {_SCHEME}) AS link_text,
 concat(CASE o_orderkey % 6 WHEN 0 THEN 'Equity scheme portfolio for ' WHEN 1 THEN 'Mid Cap list, ' WHEN 2 THEN 'Debt and gilt, as of ' ELSE 'Files ' END,
  CASE o_orderkey % 5 WHEN 0 THEN concat({_MONTH_FULL}, ' ', {_YEAR}) WHEN 1 THEN concat({_MONTH3}, '-', {_YEAR2}) WHEN 2 THEN concat({_YEAR}, ' / ', {_MONTH_FULL}) ELSE 'all periods' END) AS parent_text,
 CASE o_orderkey % 8 WHEN 0 THEN {_SCHEME} ELSE '' END AS title,
 CASE o_orderkey % 10 WHEN 0 THEN concat('as on ', CAST(day(o_orderdate) AS STRING), ' ', {_MONTH_FULL}) ELSE '' END AS aria_label,
 CASE o_orderkey % 6 WHEN 1 THEN 'ddlMonth' WHEN 2 THEN 'report_period' WHEN 3 THEN 'lang' ELSE 'Fund list' END AS drop1_name,
 CASE o_orderkey % 6 WHEN 1 THEN {_MONTH_FULL} WHEN 2 THEN concat({_MONTH3}, ' ', {_YEAR}) WHEN 3 THEN 'en' ELSE CASE o_orderkey % 4 WHEN 1 THEN {_SCHEME} ELSE '' END END AS drop1_value,
 CASE o_orderkey % 5 WHEN 1 THEN 'Year' WHEN 2 THEN 'yr_sel' ELSE 'sort' END AS drop2_name,
 CASE o_orderkey % 5 WHEN 1 THEN {_YEAR} WHEN 2 THEN {_YEAR2} ELSE 'asc' END AS drop2_value,
 CASE o_orderkey % 7 WHEN 1 THEN 'data-scheme' WHEN 2 THEN 'data-month' ELSE 'data-id' END AS attr_name,
 CASE o_orderkey % 7 WHEN 1 THEN {_SCHEME} WHEN 2 THEN concat({_MONTH_FULL}, ' ', {_YEAR}) ELSE CAST(o_orderkey AS STRING) END AS attr_value,
 concat(CASE o_orderkey % 9 WHEN 0 THEN '' WHEN 1 THEN 'HDFC Mutual Fund ' WHEN 2 THEN 'Nippon India MF ' ELSE concat({_AMC}, ' ') END,
  CASE o_orderkey % 4 WHEN 0 THEN 'Monthly Portfolio Statement ' WHEN 1 THEN 'Fact sheet ' WHEN 2 THEN 'Half yearly ' ELSE '' END,
  CASE o_orderkey % 8 WHEN 0 THEN concat('as on ', CAST(day(o_orderdate) AS STRING), 'th ', {_MONTH_FULL}, ', ', {_YEAR})
   WHEN 1 THEN concat('As on ', {_MONTH_FULL}, ' ', CAST(day(o_orderdate) AS STRING), ', ', {_YEAR2})
   WHEN 2 THEN concat('as on ', CAST(day(o_orderdate) AS STRING), '/', CAST(day(o_orderdate) % 14 AS STRING), '/', {_YEAR})
   WHEN 3 THEN concat('Portfolio as of ', CAST(day(o_orderdate) AS STRING), ' ', {_MONTH3}, ' ', {_YEAR})
   WHEN 4 THEN concat('for the month of ', {_MONTH_FULL}, ' ', {_YEAR})
   WHEN 5 THEN concat('month ending ', {_MONTH_FULL}, ', ', {_YEAR2}) ELSE 'no date' END,
  CASE o_orderkey % 3 WHEN 0 THEN concat(' ', {_SCHEME}) ELSE '' END) AS header_text,
 concat('Sheet', CAST(o_orderkey % 4 AS STRING)) AS sheet1, {_SCHEME} AS sheet2,
 CAST(o_orderkey * 37 % 4000000 AS BIGINT) AS file_size_bytes,
 o_orderdate AS discovered_at,
 CASE o_orderstatus WHEN 'F' THEN 'PUBLISHED' WHEN 'O' THEN 'QUARANTINED' ELSE 'FAILED' END AS old_status
FROM {{orders}}
"""

# One holding per line: text numbers with brackets, blanks, commas and null markers; blank ISINs; missing names.
HOLDINGS = """
SELECT doc_id, row_idx, isin, instrument_name,
  CASE row_idx % 5 WHEN 0 THEN concat('(', q, ')') WHEN 1 THEN 'N/A' WHEN 2 THEN concat(' ', q, ' ') ELSE q END AS quantity,
  CASE row_idx % 7 WHEN 0 THEN '-' WHEN 3 THEN concat('1,', lpad(mv, 12, '0')) WHEN 5 THEN 'nil' ELSE mv END AS market_value,
  pct AS pct_to_net_assets, rating
FROM (SELECT l_orderkey AS doc_id,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS INT) AS row_idx,
  CASE WHEN l_partkey % 11 = 0 THEN '' ELSE concat('INE', lpad(CAST(l_partkey AS STRING), 9, '0')) END AS isin,
  CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE concat('Instrument ', CAST(l_partkey AS STRING)) END AS instrument_name,
  CAST(CAST(l_quantity AS DECIMAL(18,2)) AS STRING) AS q,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING) AS mv,
  CAST(CAST(100 * l_extendedprice / SUM(l_extendedprice) OVER (PARTITION BY l_orderkey) AS DECIMAL(8,4)) AS STRING) AS pct,
  CASE WHEN l_returnflag = 'A' THEN 'AAA' WHEN l_returnflag = 'N' THEN 'AA+' ELSE NULL END AS rating
 FROM {lineitem}) t
"""

#: Texts with this window need an order's lines in one place.
_PER_ORDER = "PARTITION BY l_orderkey"

# One run per source and day.
RUNS = """
SELECT concat(CAST(user_id % 7 AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS run_id,
 CAST(user_id % 7 AS INT) AS source_id, min(ts) AS started_at, max(ts) AS completed_at,
 CASE WHEN sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) % 5 = 1 THEN 'FAILED'
  WHEN sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) % 9 = 2 THEN 'RUNNING' ELSE 'COMPLETED' END AS status,
 CAST(count(*) AS BIGINT) AS documents_discovered,
 CAST(sum(CASE WHEN event_type <> 'view' THEN 1 ELSE 0 END) AS BIGINT) AS documents_novel,
 CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS documents_classified,
 CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS documents_quarantined,
 CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) % 11 AS BIGINT) AS documents_published,
 CAST(NULL AS STRING) AS errors
FROM {events} GROUP BY user_id % 7, CAST(ts AS DATE)
"""

# Staged-table metadata: one table per order, layout depends on customer and month.
STAGED = """
SELECT CAST(o_orderkey AS STRING) AS document_id, CAST(o_custkey % 5 AS INT) AS source_id,
 sha2(concat('layout ', CAST(o_custkey % 5 AS STRING), '-', CAST(year(o_orderdate) % 3 AS STRING), '-',
  CASE WHEN o_orderkey % 97 = 0 THEN 'odd' ELSE '' END), 256) AS header_hash,
 concat('isin,name,qty', CASE WHEN o_orderkey % 97 = 0 THEN ',extra,more,last,one' WHEN o_orderkey % 5 = 0 THEN ',pct' ELSE '' END) AS columns_csv,
 o_orderdate AS created_at, CASE WHEN year(o_orderdate) < 2000 THEN 1 ELSE 0 END AS is_old
FROM {orders}
"""

# Crawl log: one page observation per event of a source.
CRAWLS = """
SELECT CAST(user_id % 7 AS INT) AS source_id, event_id, ts AS crawled_at,
 substr(sha2(concat(CAST(user_id % 7 AS STRING), ':', CAST(CAST(floor(event_id / 400) AS BIGINT) AS STRING)), 256), 1, 16) AS page_structure_hash
FROM {events}
"""


def duck(sql: str) -> str:
    """The same text with table names in place, for a plain SQL engine."""
    return sql.format(**{t: t for t in TABLES}).replace("sha2(", "sha256(").replace(", 256)", ")")


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; ``spread`` is for queries whose work per row is heavy.

    Where the session asks for it (``PARTS``), such a table's rows are dealt out to so many tasks
    first. That is for a small table that is a single row group; nothing depends on its size here.
    """
    df = ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")
    parts = spark.conf.get(PARTS, None) if spread else None
    return df.repartition(int(parts)) if parts else df


PARTS = "spark.holdsift.inputPartitions"


def derive(spark: SparkSession, sf_dir: str, sql: str, spread: bool = False) -> DataFrame:
    names = [t for t in TABLES if "{" + t + "}" in sql]
    given = {t: table(spark, sf_dir, t, spread) for t in names}
    if _PER_ORDER in sql:  # the lines meet their order as they are stored, and are spelled out after that
        given["lineitem"] = given["lineitem"].repartition("l_orderkey")
    return spark.sql(sql, **given)
