"""Rule lists, lookup tables, weights and thresholds.

Everything here is plain data that has to equal the published behaviour for
results to be right.  Order matters: every list is read "first match wins".
All of it can be replaced by passing another list to the functions.
"""

from __future__ import annotations

from typing import NamedTuple

# --------------------------------------------------------------------------
# months
# --------------------------------------------------------------------------
MONTH_LABELS = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]

MONTH_WORDS = [
    ("january", 1), ("february", 2), ("march", 3), ("april", 4),
    ("may", 5), ("june", 6), ("july", 7), ("august", 8),
    ("september", 9), ("october", 10), ("november", 11), ("december", 12),
    ("jan", 1), ("feb", 2), ("mar", 3), ("apr", 4),
    ("jun", 6), ("jul", 7), ("aug", 8), ("sep", 9),
    ("oct", 10), ("nov", 11), ("dec", 12),
]

FILENAME_MONTHS = [
    (r"\b(jan(?:uary)?)\b", 1),
    (r"\b(feb(?:ruary)?)\b", 2),
    (r"\b(mar(?:ch)?)\b", 3),
    (r"\b(apr(?:il)?)\b", 4),
    (r"\b(may)\b", 5),
    (r"\b(jun(?:e)?)\b", 6),
    (r"\b(jul(?:y)?)\b", 7),
    (r"\b(aug(?:ust)?)\b", 8),
    (r"\b(sep(?:t(?:ember)?)?)\b", 9),
    (r"\b(oct(?:ober)?)\b", 10),
    (r"\b(nov(?:ember)?)\b", 11),
    (r"\b(dec(?:ember)?)\b", 12),
]

YEAR_4 = r"\b(20[0-9]{2})\b"
MONTH_THEN_YEAR_2 = (
    r"\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*(?:[_\-\s]+)?([2-3][0-9])\b"
)

# --------------------------------------------------------------------------
# Filename channel (substring rules)
# --------------------------------------------------------------------------
FILENAME_AMC = [
    ("sbi", "SBI Mutual Fund"),
    ("sbimf", "SBI Mutual Fund"),
    ("hdfc", "HDFC Mutual Fund"),
    ("hdfcfund", "HDFC Mutual Fund"),
    ("icici", "ICICI Prudential Mutual Fund"),
    ("icicipru", "ICICI Prudential Mutual Fund"),
    ("nippon", "Nippon India Mutual Fund"),
    ("uti", "UTI Mutual Fund"),
    ("kotak", "Kotak Mahindra Mutual Fund"),
    ("axis", "Axis Mutual Fund"),
    ("birla", "Aditya Birla Sun Life Mutual Fund"),
    ("absl", "Aditya Birla Sun Life Mutual Fund"),
    ("dsp", "DSP Mutual Fund"),
    ("mirae", "Mirae Asset Mutual Fund"),
]

FILENAME_DOC_TYPE = [
    ("portfolio", "portfolio_disclosure"),
    ("factsheet", "factsheet"),
    ("disclosure", "portfolio_disclosure"),
    ("monthly", "portfolio_disclosure"),
    ("fortnightly", "fortnightly_disclosure"),
    ("halfyearly", "half_yearly_report"),
    ("half_yearly", "half_yearly_report"),
    ("annual", "annual_report"),
]

FILENAME_CATEGORY = [
    ("equity", "equity"), ("debt", "debt"), ("hybrid", "hybrid"), ("liquid", "debt"),
    ("balanced", "hybrid"), ("flexi", "equity"), ("bluechip", "equity"), ("midcap", "equity"),
    ("smallcap", "equity"), ("largecap", "equity"), ("gilt", "debt"), ("bond", "debt"),
    ("elss", "equity"), ("arbitrage", "hybrid"), ("overnight", "debt"), ("index", "other"),
    ("etf", "other"),
]

# --------------------------------------------------------------------------
# URL channel
# --------------------------------------------------------------------------
URL_AMC = [
    (r"sbimf\.com", "SBI Mutual Fund"),
    (r"sbi.*mf", "SBI Mutual Fund"),
    (r"hdfcfund\.com", "HDFC Mutual Fund"),
    (r"hdfc.*fund", "HDFC Mutual Fund"),
    (r"icicipruamc\.com", "ICICI Prudential Mutual Fund"),
    (r"icici.*pru", "ICICI Prudential Mutual Fund"),
    (r"nipponindiaim\.com", "Nippon India Mutual Fund"),
    (r"utimf\.com", "UTI Mutual Fund"),
    (r"kotakmf\.com", "Kotak Mahindra Mutual Fund"),
    (r"axismf\.com", "Axis Mutual Fund"),
    (r"adityabirlacapital\.com", "Aditya Birla Sun Life Mutual Fund"),
    (r"dspim\.com", "DSP Mutual Fund"),
    (r"miraeassetmf", "Mirae Asset Mutual Fund"),
]

URL_DOC_TYPE = [
    ("portfolio", "portfolio_disclosure"),
    ("portfolios", "portfolio_disclosure"),
    ("factsheet", "factsheet"),
    ("fact-sheet", "factsheet"),
    ("disclosure", "portfolio_disclosure"),
    ("statutory-disclosure", "portfolio_disclosure"),
    ("statutory-disclosures", "portfolio_disclosure"),
    ("monthly-portfolio", "portfolio_disclosure"),
    ("monthly-portfolio-disclosures", "portfolio_disclosure"),
    ("downloads", "portfolio_disclosure"),
    ("annual-report", "annual_report"),
]

QUERY_MONTH_KEYS = ["month", "mon", "m"]
QUERY_YEAR_KEYS = ["year", "yr", "y"]
QUERY_SCHEME_KEYS = ["scheme", "fund", "schemename"]
QUERY_CATEGORY_KEYS = ["category", "cat", "type"]

# --------------------------------------------------------------------------
# Page-context channel
# --------------------------------------------------------------------------
PAGE_DOC_TYPE = [
    (r"monthly\s+portfolio", "portfolio_disclosure"),
    (r"portfolio\s+disclosure", "portfolio_disclosure"),
    (r"scheme\s+portfolio", "portfolio_disclosure"),
    (r"factsheet", "factsheet"),
    (r"fact\s+sheet", "factsheet"),
    (r"half[\s-]?yearly", "half_yearly_report"),
    (r"fortnightly", "fortnightly_disclosure"),
    (r"annual\s+report", "annual_report"),
]

PAGE_CATEGORY = [
    (r"\bequity\b", "equity"),
    (r"\bdebt\b", "debt"),
    (r"\bhybrid\b", "hybrid"),
    (r"\bliquid\b", "debt"),
    (r"\bbalanced\b", "hybrid"),
    (r"\bflexi[\s-]?cap\b", "equity"),
    (r"\blarge[\s-]?cap\b", "equity"),
    (r"\bmid[\s-]?cap\b", "equity"),
    (r"\bsmall[\s-]?cap\b", "equity"),
    (r"\bgilt\b", "debt"),
    (r"\belss\b", "equity"),
]

DROPDOWN_PERIOD_KEYS = ["month", "period", "mon"]
DROPDOWN_YEAR_KEYS = ["year", "yr"]
DROPDOWN_SCHEME_KEYS = ["scheme", "fund", "category"]
DATA_SCHEME_KEYS = ["scheme", "fund"]
DATA_PERIOD_KEYS = ["month", "period"]

# --------------------------------------------------------------------------
# Document-header channel
# --------------------------------------------------------------------------
HEADER_AMC = [
    (r"sbi\s+(?:mutual\s+fund|funds?\s+management|mf)", "SBI Mutual Fund"),
    (r"hdfc\s+(?:mutual\s+fund|asset\s+management|mf)", "HDFC Mutual Fund"),
    (r"icici\s+prudential\s+(?:mutual\s+fund|asset\s+management|mf)", "ICICI Prudential Mutual Fund"),
    (r"nippon\s+india\s+(?:mutual\s+fund|mf)", "Nippon India Mutual Fund"),
    (r"uti\s+(?:mutual\s+fund|mf|asset\s+management)", "UTI Mutual Fund"),
    (r"kotak\s+(?:mahindra\s+)?(?:mutual\s+fund|mf|asset)", "Kotak Mahindra Mutual Fund"),
    (r"axis\s+(?:mutual\s+fund|mf|asset)", "Axis Mutual Fund"),
    (r"aditya\s+birla\s+(?:sun\s+life\s+)?(?:mutual\s+fund|mf)", "Aditya Birla Sun Life Mutual Fund"),
    (r"dsp\s+(?:mutual\s+fund|mf|investment)", "DSP Mutual Fund"),
    (r"mirae\s+asset\s+(?:mutual\s+fund|mf)", "Mirae Asset Mutual Fund"),
]

_LONG = "january|february|march|april|may|june|july|august|september|october|november|december"
_SHORT = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_DAY = r"(\d{1,2})"
_ORDINAL = r"\s*(?:st|nd|rd|th)?"
_YEAR = r"(20\d{2}|\d{2})\b"

# (pattern, group holding the month, group holding the year)
HEADER_PERIOD = [
    (rf"as\s+on\s+{_DAY}{_ORDINAL}\s*({_LONG})\s*,?\s*{_YEAR}", 2, 3),
    (rf"as\s+on\s*({_LONG})\s+{_DAY}{_ORDINAL}\s*,?\s*{_YEAR}", 1, 3),
    (rf"as\s+on\s+{_DAY}[/\-](\d{{1,2}})[/\-]{_YEAR}", 2, 3),
    (rf"portfolio\s+as\s+(?:on|of)\s+{_DAY}{_ORDINAL}\s*({_SHORT})\w*\s*,?\s*{_YEAR}", 2, 3),
    (rf"portfolio\s+as\s+(?:on|of)\s*({_SHORT})\w*\s+{_DAY}{_ORDINAL}\s*,?\s*{_YEAR}", 1, 3),
    (rf"month\s+(?:of|ending)\s*({_LONG})\s*,?\s*{_YEAR}", 1, 2),
    (rf"for\s+the\s+month\s+(?:of\s+)?({_LONG})\s*,?\s*{_YEAR}", 1, 2),
]

HEADER_DOC_TYPE = [
    (r"portfolio\s+(?:disclosure|statement)", "portfolio_disclosure"),
    (r"scheme\s+portfolio", "portfolio_disclosure"),
    (r"monthly\s+portfolio", "portfolio_disclosure"),
    (r"fact\s*sheet", "factsheet"),
    (r"half[\s-]?yearly", "half_yearly_report"),
]

HEADER_FILE_TYPES = ["pdf", "xlsx", "xls"]
HEADER_ROWS = 10
HEADER_SHEETS = 5

# --------------------------------------------------------------------------
# Fuzzy cut-offs (a score must be above the cut)
# --------------------------------------------------------------------------
FUZZY_FILENAME_CUT = 60.0
FUZZY_PAGE_CUT = 70.0
FUZZY_HEADER_CUT = 75.0
FUZZY_SHEET_CUT = 80.0

# --------------------------------------------------------------------------
# Score fusion
# --------------------------------------------------------------------------
CHANNELS = ["doc_header", "page_context", "filename", "url"]
WEIGHTS = {"doc_header": 0.40, "page_context": 0.25, "filename": 0.20, "url": 0.15}
AGREEMENT_BONUS = 0.10
DISAGREEMENT_PENALTY = 0.15
STALE_MONTHS = 6
STALE_MONTHS_STRICT = 3


class Thresholds(NamedTuple):
    auto_accept: float = 0.85
    accept_flag: float = 0.70
    quarantine: float = 0.50


# --------------------------------------------------------------------------
# URLs and responses
# --------------------------------------------------------------------------
VOLATILE_PARAMS = ["t", "timestamp", "v", "ver", "cache", "_", "cb", "rand"]
TRACKING_PARAMS = ["utm_source", "utm_medium", "sessionid", "_t", "_ts", "cachebust"]
DOCUMENT_EXTENSIONS = ["pdf", "xlsx", "xls", "csv", "zip"]
DEFAULT_LINK_TYPES = ["xlsx", "pdf", "zip"]
DOCUMENT_URL_WORDS = r"download|binary|attachment|portfolio|factsheet|disclosure"
NAVIGATION_MARKS = ["javascript:", "mailto:", "#"]
DOCUMENT_MIME_TYPES = [
    "application/pdf",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "application/vnd.ms-excel",
    "application/octet-stream",
    "application/zip",
    "application/x-zip-compressed",
    "text/csv",
]
CONTENT_TYPE_RULES = [
    ("pdf", "pdf"), ("spreadsheet", "xlsx"), ("excel", "xlsx"), ("csv", "csv"), ("zip", "zip"),
]
VOID_TAGS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "source", "track", "wbr",
]
STRUCTURE_DEPTH = 5
LINK_TEXT_CHARS = 200
CONTEXT_TEXT_CHARS = 500

# --------------------------------------------------------------------------
# Table headers (field -> accepted spellings), two dialects
# --------------------------------------------------------------------------
HOLDING_FIELDS = [
    "isin", "instrument_name", "instrument_type", "quantity",
    "market_value", "pct_to_net_assets", "rating", "industry",
]
NUMERIC_FIELDS = ["quantity", "market_value", "pct_to_net_assets"]

EXCEL_HEADERS = [
    ("isin", ["isin", "isin code", "isin no", "isin number"]),
    ("instrument_name", ["name of the instrument", "instrument", "security", "stock name",
                         "name of instrument", "scrip name", "security name", "name"]),
    ("instrument_type", ["type", "instrument type", "asset type", "security type"]),
    ("quantity", ["quantity", "qty", "no. of shares", "units", "nos.", "no of shares"]),
    ("market_value", ["market value", "market/fair value", "value",
                      "market value (rs. in lakhs)", "market value in lakhs", "total"]),
    ("pct_to_net_assets", ["% to net assets", "% of net assets", "% to nav", "% of nav",
                           "% to total", "percentage to net assets"]),
    ("rating", ["rating", "credit rating"]),
    ("industry", ["industry", "sector"]),
]

PDF_HEADERS = [
    ("isin", ["isin", "isin code", "isin no"]),
    ("instrument_name", ["name of the instrument", "instrument", "security", "stock name",
                         "name of instrument", "scrip name", "security name"]),
    ("instrument_type", ["type", "instrument type", "asset type", "security type"]),
    ("quantity", ["quantity", "qty", "no. of shares", "units", "face value", "nos."]),
    ("market_value", ["market value", "market/fair value", "value",
                      "market value (rs. in lakhs)", "market value (in lakhs)", "total (rs.)"]),
    ("pct_to_net_assets", ["% to net assets", "% of net assets", "% to nav", "% of nav",
                           "% to total", "percentage to net assets", "% of total"]),
    ("rating", ["rating", "credit rating", "rating / industry"]),
    ("industry", ["industry", "industry / rating", "sector"]),
]

HEADER_SCAN_ROWS = {"excel": 15, "pdf": 5}
MIN_MAPPED_COLUMNS = 2
# Markers named by the spreadsheet reader, then the ones its table library adds on its own.
NULL_MARKERS = ["-", "—", "N/A", "NA", "--", ""]
NULL_MARKERS_LIBRARY = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "NULL", "NaN", "None", "n/a", "nan", "null",
]
EMPTY_NUMBERS = {"excel": ["", "-", "—"], "pdf": ["", "-", "—", "N/A", "NA"]}
PCT_TOTAL_RANGE = (80.0, 102.0)
FLOAT_SHAPE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
ISIN_SHAPE = r"^[A-Z]{2}[A-Z0-9]{9}[0-9]$"

# --------------------------------------------------------------------------
# States, decisions, drift
# --------------------------------------------------------------------------
DOCUMENT_STATUSES = [
    "DISCOVERED", "DOWNLOADING", "DOWNLOADED", "CLASSIFYING", "CLASSIFIED", "EXTRACTING",
    "EXTRACTED", "STAGING", "STAGED", "VALIDATING", "VALIDATED", "PUBLISHED",
    "QUARANTINED", "REJECTED", "FAILED",
]
SETTLED_STATUSES = ["PUBLISHED", "VALIDATED", "QUARANTINED", "REJECTED"]
PROCESSED_STATUSES = ["PUBLISHED", "VALIDATED"]
RETRY_STATUSES = ["FAILED", "QUARANTINED"]
REVIEW_DECISIONS = ["ACCEPTED", "REJECTED", "RECLASSIFIED"]
APPLYING_DECISIONS = ["ACCEPTED", "RECLASSIFIED"]
HEADER_BASELINES = 5
FAILURE_THRESHOLD = 0.10
FAILURE_CRITICAL = 0.50
COLUMN_COUNT_WARNING = 2
DRIFT_SEVERITY = {"page_structure": "WARNING", "table_header": "CRITICAL"}
QUARANTINE_ALERT_RATE = 0.30
DURATION_ALERT_FACTOR = 2.0
SIZE_UNITS = ["Bytes", "KB", "MB", "GB"]
UNKNOWN_AMC = "Unknown AMC"
UNKNOWN_SCHEME = "Unknown Scheme"

# --------------------------------------------------------------------------
# Source registry and scheme master
# --------------------------------------------------------------------------
SOURCES = [
    {
        "source_key": "sbi_mf",
        "amc_name": "SBI Mutual Fund",
        "base_url": "https://www.sbimf.com/en-us/portfolios",
        "page_type": "JS_SPA",
        "strategy": "network_intercept",
        "api_patterns": ["/api/am/binary/*", "/api/*/portfolio*", "/ajaxcall/CMS/GetSchemaPortfolioSheets*"],
        "download_selectors": ["a[href*='.xlsx']", "a[href*='.xls']", "a[href*='.pdf']", "a[download]", "button:has-text('Download')"],
        "file_types": ["xlsx", "xls", "pdf"],
        "enabled": True,
    },
    {
        "source_key": "hdfc_mf",
        "amc_name": "HDFC Mutual Fund",
        "base_url": "https://www.hdfcfund.com/statutory-disclosure/portfolio/monthly-portfolio",
        "page_type": "JS_SPA",
        "strategy": "network_intercept",
        "api_patterns": [],
        "download_selectors": ["a[href*='.xlsx']", "a[href*='.xls']", "a[href*='.pdf']", "a[href*='portfolio']", "a[href*='download']"],
        "file_types": ["xlsx", "xls", "pdf"],
        "enabled": True,
    },
    {
        "source_key": "nippon_india",
        "amc_name": "Nippon India Mutual Fund",
        "base_url": "https://mf.nipponindiaim.com/investor-service/downloads/factsheet-portfolio-and-other-disclosures",
        "page_type": "STATIC",
        "strategy": "link_extraction",
        "api_patterns": [],
        "download_selectors": ["a[href*='.pdf']", "a[href*='.xlsx']", "a[href*='.xls']"],
        "file_types": ["pdf", "xls", "xlsx"],
        "enabled": False,
    },
]


class Scheme(NamedTuple):
    amc_key: str
    amc_name: str
    scheme_name: str
    category: str
    aliases: tuple[str, ...]


def _schemes(amc_key, amc_name, rows):
    return [Scheme(amc_key, amc_name, name, cat, tuple(al)) for name, cat, al in rows]


SCHEME_MASTER = (
    _schemes("sbi_mf", "SBI Mutual Fund", [
        ("SBI Blue Chip Fund", "equity", ["SBI Bluechip", "SBI Blue Chip"]),
        ("SBI Equity Hybrid Fund", "hybrid", ["SBI Equity Hybrid"]),
        ("SBI Magnum Medium Duration Fund", "debt", ["SBI Medium Duration", "SBI Magnum Medium"]),
        ("SBI Focused Equity Fund", "equity", ["SBI Focused"]),
        ("SBI Large & Midcap Fund", "equity", ["SBI Large and Midcap", "SBI Large Midcap"]),
        ("SBI Liquid Fund", "debt", ["SBI Liquid"]),
        ("SBI Small Cap Fund", "equity", ["SBI Smallcap", "SBI Small Cap"]),
        ("SBI Flexi Cap Fund", "equity", ["SBI Flexicap"]),
    ])
    + _schemes("hdfc_mf", "HDFC Mutual Fund", [
        ("HDFC Flexi Cap Fund", "equity", ["HDFC Flexicap", "HDFC Flexi Cap"]),
        ("HDFC Mid-Cap Opportunities Fund", "equity", ["HDFC Midcap Opportunities", "HDFC Mid Cap"]),
        ("HDFC Top 100 Fund", "equity", ["HDFC Top100", "HDFC Top 100"]),
        ("HDFC Balanced Advantage Fund", "hybrid", ["HDFC BAF", "HDFC Balanced"]),
        ("HDFC Short Term Debt Fund", "debt", ["HDFC Short Term", "HDFC STD"]),
        ("HDFC Liquid Fund", "debt", ["HDFC Liquid"]),
        ("HDFC Small Cap Fund", "equity", ["HDFC Smallcap", "HDFC Small Cap"]),
    ])
    + _schemes("nippon_india", "Nippon India Mutual Fund", [
        ("Nippon India Small Cap Fund", "equity", ["Nippon Small Cap", "Nippon India Smallcap", "NIMF Small Cap"]),
        ("Nippon India Growth Fund", "equity", ["Nippon Growth Fund", "Nippon Growth"]),
        ("Nippon India Multi Cap Fund", "equity", ["Nippon Multi Cap", "NIMF Multi Cap"]),
        ("Nippon India Liquid Fund", "debt", ["Nippon Liquid", "NIMF Liquid"]),
        ("Nippon India Arbitrage Fund", "hybrid", ["Nippon Arbitrage"]),
    ])
)

AMC_ALIASES = {
    "sbi_mf": ["SBI MF", "SBI Mutual Fund", "SBIMF", "SBI Funds Management"],
    "hdfc_mf": ["HDFC MF", "HDFC Mutual Fund", "HDFC Asset Management", "HDFC AMC"],
    "nippon_india": ["Nippon India MF", "Nippon MF", "Nippon India", "NIMF", "Reliance Mutual Fund"],
}

CATEGORY_TAXONOMY = {
    "equity": ["large_cap", "mid_cap", "small_cap", "multi_cap", "flexi_cap", "large_mid_cap", "focused",
               "elss", "value", "contra", "dividend_yield", "sectoral", "thematic"],
    "debt": ["overnight", "liquid", "ultra_short", "low_duration", "money_market", "short_duration",
             "medium_duration", "medium_long", "long_duration", "dynamic_bond", "corporate_bond",
             "credit_risk", "banking_psu", "gilt", "gilt_10yr", "floater"],
    "hybrid": ["conservative", "balanced", "aggressive", "dynamic_asset_allocation", "multi_asset",
               "arbitrage", "equity_savings"],
    "solution_oriented": ["retirement", "children"],
    "other": ["index", "etf", "fof"],
}
