"""Plain-SQL spellings of the shared rule lists, used to check the Spark queries against another engine."""

from __future__ import annotations

from holdsift import rules as R
from holdsift.plans import inputs as I


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lit(v) -> str:
    return q(v) if isinstance(v, str) else str(v)


def case_contains(expr: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN contains({expr}, {q(k)}) THEN {lit(v)}" for k, v in rules) + " END"


def case_regex(expr: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({expr}, {q(k)}) THEN {lit(v)}" for k, v in rules) + " END"


def case_equals(expr: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {q(k)} THEN {lit(v)}" for k, v in rules) + " END"


def any_contains(expr: str, words) -> str:
    return "(" + " OR ".join(f"contains({expr}, {q(w)})" for w in words) + ")"


def in_list(words) -> str:
    return "(" + ", ".join(lit(w) for w in words) + ")"


def year_of(text: str) -> str:
    return f"CASE WHEN TRY_CAST({text} AS INT) < 100 THEN TRY_CAST({text} AS INT) + 2000 ELSE TRY_CAST({text} AS INT) END"


def beside(word: str) -> str:
    return rf"\b{word}\b\s*(?:[_\-\s]+)?\b(20[0-9]{{2}}|[2-3][0-9])\b"


def period_month(low: str) -> str:
    near = " ".join(f"WHEN regexp_matches({low}, {q(beside(w))}) THEN {n}" for w, n in R.MONTH_WORDS)
    lone = " ".join(f"WHEN regexp_matches({low}, {q(chr(92) + 'b' + w + chr(92) + 'b')}) THEN {n}" for w, n in R.MONTH_WORDS)
    return f"CAST(CASE {near} {lone} END AS INT)"


def period_year(low: str) -> str:
    near = " ".join(
        f"WHEN regexp_matches({low}, {q(beside(w))}) THEN {year_of(f'regexp_extract({low}, {q(beside(w))}, 1)')}"
        for w, _ in R.MONTH_WORDS
    )
    tok = r"(?:^|[_\-\s.,/])(2[0-9]|30)(?:$|[_\-\s.,/])"
    return (
        f"CAST(CASE {near} WHEN regexp_matches({low}, {q(R.YEAR_4)}) THEN TRY_CAST(regexp_extract({low}, {q(R.YEAR_4)}, 1) AS INT) "
        f"WHEN regexp_matches({low}, {q(tok)}) THEN 2000 + TRY_CAST(regexp_extract({low}, {q(tok)}, 1) AS INT) END AS INT)"
    )


def plausible_year(v: str) -> str:
    n = f"TRY_CAST(CASE WHEN regexp_matches(trim({v}), '^[+-]?[0-9]{{1,9}}$') THEN trim({v}) END AS INT)"
    return f"CASE WHEN {n} BETWEEN 20 AND 30 THEN 2000 + {n} WHEN {n} BETWEEN 2020 AND 2030 THEN {n} END"


def number(v: str) -> str:
    return f"TRY_CAST(CASE WHEN regexp_matches({v}, {q(R.FLOAT_SHAPE)}) THEN {v} END AS DOUBLE)"


def clean_number(v: str) -> str:
    return rf"replace(replace(regexp_replace(trim({v}), '[,\s]', '', 'g'), '(', '-'), ')', '')"


DOCS = I.duck(I.DOCS)
HOLDINGS = I.duck(I.HOLDINGS)
RUNS = I.duck(I.RUNS)
STAGED = I.duck(I.STAGED)
CRAWLS = I.duck(I.CRAWLS)

URL_PARTS = r"""
 lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.\-]*):', 1)) AS scheme,
 regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) AS host,
 regexp_replace(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1), ';[^/]*$', '') AS path,
 regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query
"""


def url_ctes(source: str, key: str) -> str:
    """CTEs ``u`` (url parts) and ``qp`` (first value per decoded query key, with its position)."""
    return f"""
u AS (SELECT *, {URL_PARTS} FROM {source}),
qx AS (SELECT {key}, p, i FROM (SELECT {key}, string_split(query, '&') AS ps FROM u) t,
  LATERAL (SELECT unnest(ps) AS p, unnest(range(len(ps))) AS i) x WHERE regexp_matches(p, '^[^=]*=.')),
qp AS (SELECT {key}, k, arg_min(v, i) AS v, min(i) AS i FROM (
  SELECT {key}, i, url_decode(replace(regexp_extract(p, '^([^=]*)=', 1), '+', ' ')) AS k,
   url_decode(replace(regexp_extract(p, '^[^=]*=(.*)$', 1), '+', ' ')) AS v FROM qx) t GROUP BY {key}, k)"""


FILENAME = "CASE WHEN contains({n}, '.') THEN {n} END"


def last_segment(path: str) -> str:
    return f"list_extract(string_split(regexp_replace({path}, '/+$', ''), '/'), -1)"


def extension(name: str) -> str:
    return rf"lower(regexp_extract({name}, '^.+\.([^.]+)$', 1))"


def fold_dots(path: str) -> str:
    parts = f"string_split({path}, '/')"
    kept = (
        f"list_reduce({parts}, lambda acc, s: CASE WHEN s = '.' THEN acc WHEN s = '..' THEN acc[1:len(acc)-1] "
        f"ELSE list_append(acc, s) END, CAST([] AS VARCHAR[]))"
    )
    return (
        f"CASE WHEN regexp_matches({path}, '(^|/)\\.\\.?(/|$)') THEN array_to_string({kept}, '/') || "
        f"CASE WHEN {parts}[-1] IN ('.', '..') THEN '/' ELSE '' END ELSE {path} END"
    )
