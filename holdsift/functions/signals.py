"""The four signal channels.

Each function adds one struct column
``(channel, amc_name, scheme_name, period_month, period_year, scheme_category,
doc_type, confidence, signals_found, evidence)``.  Everything but the fuzzy
scheme lookup is built-in expressions, so classifying a document is a projection:
no join, no shuffle, one Python stage for the lookups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import fuzzy as Z
from holdsift.functions import urls as U
from holdsift.functions.periods import full_year, month_inside, period_from_text
from holdsift.functions.text import (
    cap1, contains_any, filled, first_containing, first_match, first_matching, hit, let, parse_int, settle,
)

# Blanks beyond ASCII that text matching treats as a space.
_WIDE_BLANKS = "\x1c\x1d\x1e\x1f\x85                 　"


def plain_blanks(text: Column) -> Column:
    return F.translate(text, _WIDE_BLANKS, " " * len(_WIDE_BLANKS))


def _signal(channel: str, present: Column, *, amc, scheme, month, year, category, doc_type,
            confidence, found, evidence: dict[str, Column], absent_confidence: Column | None = None) -> Column:
    def only(c, t):
        return F.when(present, c).cast(t)

    seen = F.array_compact(F.array(*[F.when(present & c, F.lit(k)) for k, c in evidence.items()]))
    return settle(F.struct(
        F.lit(channel).alias("channel"),
        only(amc, "string").alias("amc_name"),
        only(scheme, "string").alias("scheme_name"),
        only(month, "int").alias("period_month"),
        only(year, "int").alias("period_year"),
        only(category, "string").alias("scheme_category"),
        only(doc_type, "string").alias("doc_type"),
        F.when(present, confidence).otherwise(
            F.lit(0.0) if absent_confidence is None else absent_confidence
        ).alias("confidence"),
        F.when(present, found).otherwise(F.lit(0)).cast("int").alias("signals_found"),
        seen.alias("evidence"),
    ))


def _last(arr: Column) -> Column:
    return F.try_element_at(arr, F.lit(-1))


def _first(arr: Column) -> Column:
    return F.get(arr, F.lit(0))


def _parts(arr: Column, field: str) -> Column:
    """Non-null values of one struct field, in order."""
    return F.array_compact(F.transform(arr, lambda x: x[field]))


def _no_match() -> Column:
    return F.lit(None).cast(Z.MATCH)


# ---------------------------------------------------------------------------
# Filename
# ---------------------------------------------------------------------------
def filename_match_text(name: Column, separators: str = "literal") -> Column:
    """Lower-cased stem; ``space`` turns ``_ - .`` into blanks so word borders break there."""
    low = F.lower(U.file_stem(name))
    if separators == "space":
        return F.regexp_replace(low, r"[_\-.]", " ")
    if separators != "literal":
        raise ValueError(f"unknown separators {separators!r}")
    return low


def filename_year(text: Column, tokens: Column) -> Column:
    four = F.regexp_extract(text, R.YEAR_4, 1).try_cast("int")
    last = F.element_at(tokens, -1)
    return (
        F.when(text.rlike(R.YEAR_4), F.when(four.between(2020, 2030), four))
        .when(
            text.rlike(R.MONTH_THEN_YEAR_2),
            F.regexp_extract(text, R.MONTH_THEN_YEAR_2, 1).try_cast("int") + 2000,
        )
        .when(last.rlike(r"^(2[0-9]|30)$"), last.try_cast("int") + 2000)
    )


def with_filename_signal(df: DataFrame, filename: str = "filename", source_amc: str = "source_amc",
                         out: str = "filename_signal", separators: str = "literal",
                         master: Sequence[R.Scheme] = R.SCHEME_MASTER, fuzzy: bool = True) -> DataFrame:
    name, amc_src = F.col(filename), filled(F.col(source_amc))
    low, text = F.col("_low"), F.col("_text")
    staged = df.withColumns(
        {
            "_low": F.lower(U.file_stem(name)),
            "_text": filename_match_text(name, separators),
            "_tokens": U.stem_tokens(name),
        }
    )
    staged = staged.withColumn("_fz", Z.scheme_by_name(text, R.FUZZY_FILENAME_CUT, master) if fuzzy else _no_match())
    staged = staged.withColumns(
        {
            "_amc": first_containing(low, R.FILENAME_AMC),
            "_month": first_matching(text, R.FILENAME_MONTHS),
            "_year": filename_year(text, F.col("_tokens")),
            "_doc_type": first_containing(low, R.FILENAME_DOC_TYPE),
            "_category": first_containing(low, R.FILENAME_CATEGORY),
        }
    )
    p = {k: F.col(f"_{k}") for k in ("amc", "month", "year", "doc_type", "category")}
    scheme = F.col("_fz.scheme_name")
    amc = F.coalesce(p["amc"], amc_src)
    found = sum((hit(c.isNotNull()) for c in [*p.values(), scheme]), F.lit(0))
    base = cap1(found / F.lit(5) * F.lit(1.2))
    trio = amc.isNotNull() & p["month"].isNotNull() & p["year"].isNotNull()
    signal = _signal(
        "filename", name.isNotNull() & (name != ""),
        amc=amc, scheme=scheme, month=p["month"], year=p["year"],
        category=F.coalesce(F.col("_fz.scheme_category"), p["category"]), doc_type=p["doc_type"],
        confidence=F.when(trio, cap1(base + F.lit(0.15))).otherwise(base), found=found,
        evidence={
            "amc_indicator": p["amc"].isNotNull(),
            "amc_source": p["amc"].isNull() & amc_src.isNotNull(),
            "month_match": p["month"].isNotNull(),
            "year_match": p["year"].isNotNull(),
            "doc_type_indicator": p["doc_type"].isNotNull(),
            "category_indicator": p["category"].isNotNull(),
            "scheme_fuzzy_match": scheme.isNotNull(),
        },
    )
    return staged.withColumn(out, signal).drop(
        "_low", "_text", "_tokens", "_fz", "_amc", "_month", "_year", "_doc_type", "_category"
    )


# ---------------------------------------------------------------------------
# URL
# ---------------------------------------------------------------------------
def _segment_period(seg: Column) -> Column:
    """Month and year read from one lower-cased path segment."""
    year = (
        F.when(seg.rlike(R.YEAR_4), F.regexp_extract(seg, R.YEAR_4, 1).try_cast("int"))
        .when(seg.rlike(R.MONTH_THEN_YEAR_2), F.regexp_extract(seg, R.MONTH_THEN_YEAR_2, 1).try_cast("int") + 2000)
        .when(seg.rlike(r"^[2-3][0-9]$"), seg.try_cast("int") + 2000)
    )
    return F.struct(month_inside(F.translate(seg, "-_", "")).alias("month"), year.alias("year"))


def plausible_year(text: Column) -> Column:
    """20..30 or 2020..2030 as a year, else null."""
    y = parse_int(text)
    return F.when(y.between(20, 30), y + 2000).when(y.between(2020, 2030), y)


def _param_facts(pair: Column) -> Column:
    key, value = F.lower(pair["k"]), pair["v"]
    low = F.lower(value)
    word = F.when(key.isin(R.QUERY_MONTH_KEYS), month_inside(low))
    number = F.when(key.isin(R.QUERY_MONTH_KEYS), parse_int(value))
    number = F.when(number.between(1, 12), number)
    return F.struct(
        F.coalesce(number, word).alias("month"),
        (hit(number.isNotNull()) + hit(word.isNotNull())).alias("month_hits"),
        F.when(key.isin(R.QUERY_YEAR_KEYS), plausible_year(value)).alias("year"),
        F.when(key.isin(R.QUERY_SCHEME_KEYS), value).alias("scheme"),
        F.when(key.isin(R.QUERY_CATEGORY_KEYS), low).alias("category"),
    )


def with_url_signal(df: DataFrame, url: str = "url", source_amc: str = "source_amc",
                    out: str = "url_signal") -> DataFrame:
    u, amc_src = F.col(url), filled(F.col(source_amc))
    staged = df.withColumns(
        {"_domain": U.source_domain(u), "_segs": U.path_segments(u), "_query": U.query_of(u)}
    ).withColumns(
        {
            "_domain_amc": first_matching(F.col("_domain"), R.URL_AMC),
            "_doc_seg": _first(F.filter(F.col("_segs"), lambda s: s.isin([k for k, _ in R.URL_DOC_TYPE]))),
            "_path": F.transform(F.col("_segs"), _segment_period),
            "_params": F.when(F.col("_query") != "", F.transform(U.query_pairs(F.col("_query")), _param_facts)),
        }
    ).withColumns(
        {
            "_pm": _parts(F.col("_path"), "month"), "_py": _parts(F.col("_path"), "year"),
            "_qm": _parts(F.col("_params"), "month"), "_qy": _parts(F.col("_params"), "year"),
            "_qs": _parts(F.col("_params"), "scheme"), "_qc": _parts(F.col("_params"), "category"),
            "_month_hits": F.coalesce(
                F.aggregate(F.col("_params"), F.lit(0), lambda a, x: a + x["month_hits"]), F.lit(0)
            ),
        }
    )
    domain_amc, w = F.col("_domain_amc"), lambda k: F.col(f"_{k}")
    n = lambda k: F.coalesce(F.size(w(k)), F.lit(0))
    doc_type = first_match(lambda k: F.col("_doc_seg") == k, R.URL_DOC_TYPE)
    amc = F.coalesce(domain_amc, amc_src)
    found = (
        hit(amc.isNotNull()) + hit(doc_type.isNotNull()) + n("pm") + n("py")
        + w("month_hits") + n("qy") + n("qs") + n("qc")
    )
    base = cap1(found / F.lit(4) * F.lit(1.1))
    signal = _signal(
        "url", u.isNotNull() & (u != ""),
        amc=amc, scheme=_last(w("qs")), month=F.coalesce(_last(w("qm")), _last(w("pm"))),
        year=F.coalesce(_last(w("qy")), _last(w("py"))), category=_last(w("qc")), doc_type=doc_type,
        confidence=F.when(domain_amc.isNotNull(), F.greatest(base, F.lit(0.5))).otherwise(base), found=found,
        evidence={
            "amc_domain_match": domain_amc.isNotNull(),
            "amc_source": domain_amc.isNull() & amc_src.isNotNull(),
            "doc_type_segment": doc_type.isNotNull(),
            "month_segment": n("pm") > 0, "year_segment": n("py") > 0,
            "month_param": n("qm") > 0, "year_param": n("qy") > 0,
            "scheme_param": n("qs") > 0, "category_param": n("qc") > 0,
        },
    )
    return staged.withColumn(out, signal).drop(
        "_domain", "_segs", "_query", "_domain_amc", "_doc_seg", "_path", "_params",
        "_pm", "_py", "_qm", "_qy", "_qs", "_qc", "_month_hits",
    )


# ---------------------------------------------------------------------------
# Page context
# ---------------------------------------------------------------------------
def page_text(ctx: Column) -> Column:
    """Link, parent, title and label text; the grandparent's text is kept but not read."""
    empty = F.lit("")
    return plain_blanks(
        F.concat_ws(
            " ",
            *[F.coalesce(ctx[k], empty) for k in ("link_text", "parent_text", "title", "aria_label")],
        )
    )


def _dropdown_facts(d: Column) -> Column:
    key, value = F.lower(d["k"]), F.coalesce(d["v"], F.lit(""))
    is_period = contains_any(key, R.DROPDOWN_PERIOD_KEYS)
    is_year = ~is_period & contains_any(key, R.DROPDOWN_YEAR_KEYS)
    is_scheme = ~is_period & ~is_year & contains_any(key, R.DROPDOWN_SCHEME_KEYS)
    return let(
        F.when(is_period, period_from_text(value)),
        lambda p: F.struct(
            p["month"].alias("month"),
            F.coalesce(p["year"], F.when(is_year, plausible_year(value))).alias("year"),
            F.when(is_scheme, value).alias("scheme"),
        ),
    )


def _attr_facts(a: Column) -> Column:
    key, value = F.lower(a["k"]), F.coalesce(a["v"], F.lit(""))
    is_scheme = contains_any(key, R.DATA_SCHEME_KEYS)
    is_period = ~is_scheme & contains_any(key, R.DATA_PERIOD_KEYS)
    return let(
        F.when(is_period, period_from_text(value)),
        lambda p: F.struct(
            F.when(is_scheme, value).alias("scheme"), p["month"].alias("month"), p["year"].alias("year")
        ),
    )


def with_page_context_signal(df: DataFrame, context: str = "page_context", source_amc: str = "source_amc",
                             out: str = "page_context_signal",
                             master: Sequence[R.Scheme] = R.SCHEME_MASTER, fuzzy: bool = True) -> DataFrame:
    ctx, amc = F.col(context), filled(F.col(source_amc))
    present = ctx.isNotNull()
    text = F.col("_text")
    staged = df.withColumns(
        {
            "_text": F.lower(page_text(ctx)),
            "_drop": F.transform(ctx["active_dropdowns"], _dropdown_facts),
            "_attr": F.transform(ctx["data_attrs"], _attr_facts),
        }
    ).withColumns(
        {
            "_dm": _parts(F.col("_drop"), "month"), "_dy": _parts(F.col("_drop"), "year"),
            "_ds": _parts(F.col("_drop"), "scheme"), "_as": _parts(F.col("_attr"), "scheme"),
            "_am": _first(_parts(F.col("_attr"), "month")), "_ay": _first(_parts(F.col("_attr"), "year")),
            "_tp": period_from_text(text),
            "_doc_type": first_matching(text, R.PAGE_DOC_TYPE), "_category": first_matching(text, R.PAGE_CATEGORY),
        }
    )
    q = lambda k: F.col(f"_{k}")
    n = lambda k: F.coalesce(F.size(q(k)), F.lit(0))
    drop_scheme = _last(q("ds"))
    attr_scheme = _first(F.filter(q("as"), lambda s: s != ""))
    scheme0 = F.coalesce(filled(drop_scheme), attr_scheme, drop_scheme, _first(q("as")))
    staged = staged.withColumn("_s0", scheme0)
    open_ = F.col("_s0").isNull() | (F.col("_s0") == "")
    staged = staged.withColumn(
        "_fz",
        Z.scheme_in_text(F.when(present & open_, text), R.FUZZY_PAGE_CUT, master)
        if fuzzy else _no_match(),
    )
    d_month, d_year = _last(q("dm")), _last(q("dy"))
    t_month, t_year = q("tp")["month"], q("tp")["year"]
    month, year = F.coalesce(d_month, t_month, q("am")), F.coalesce(d_year, t_year, q("ay"))
    fz_name = F.col("_fz.scheme_name")
    found = (
        hit(amc.isNotNull()) + n("dm") + n("dy") + n("ds")
        + hit(d_month.isNull() & month.isNotNull()) + hit(d_year.isNull() & year.isNotNull())
        + hit(q("doc_type").isNotNull()) + hit(q("category").isNotNull())
        + n("as") + hit(fz_name.isNotNull())
    )
    base = cap1(found / F.lit(5) * F.lit(1.1))
    picked = (n("dm") > 0) | (n("ds") > 0)
    signal = _signal(
        "page_context", present,
        amc=amc, scheme=F.coalesce(fz_name, F.col("_s0")), month=month, year=year,
        category=F.coalesce(F.col("_fz.scheme_category"), q("category")), doc_type=q("doc_type"),
        confidence=F.when(picked, cap1(base + F.lit(0.15))).otherwise(base), found=found,
        evidence={
            "amc_source": amc.isNotNull(), "month_dropdown": n("dm") > 0, "year_dropdown": n("dy") > 0,
            "scheme_dropdown": n("ds") > 0, "month_from_text": d_month.isNull() & t_month.isNotNull(),
            "year_from_text": d_year.isNull() & t_year.isNotNull(),
            "doc_type_text_match": q("doc_type").isNotNull(), "category_text_match": q("category").isNotNull(),
            "scheme_data_attr": n("as") > 0, "scheme_fuzzy_from_text": fz_name.isNotNull(),
        },
    )
    return staged.withColumn(out, signal).drop(
        "_text", "_drop", "_attr", "_dm", "_dy", "_ds", "_as", "_am", "_ay", "_tp", "_doc_type", "_category", "_s0", "_fz"
    )


# ---------------------------------------------------------------------------
# Document header
# ---------------------------------------------------------------------------
def _month_number(text: Column) -> Column:
    by_word = first_match(lambda m: F.substring(text, 1, 3) == m[:3].lower(), [
        (m, i + 1) for i, m in enumerate(R.MONTH_LABELS)
    ])
    number = text.try_cast("int")
    return F.when(text.rlike(r"^\d+$"), F.when(number.between(1, 12), number)).otherwise(by_word)


def header_period(text: Column) -> Column:
    """struct(month, year) of the first "as on" pattern that occurs, else null; the month may be null."""
    chain = None
    for pat, g_month, g_year in R.HEADER_PERIOD:
        value = F.struct(
            _month_number(F.regexp_extract(text, pat, g_month)).alias("month"),
            full_year(F.regexp_extract(text, pat, g_year)).alias("year"),
        )
        chain = F.when(text.rlike(pat), value) if chain is None else chain.when(text.rlike(pat), value)
    return chain


def with_doc_header_signal(df: DataFrame, header_text: str = "header_text", sheet_names: str = "sheet_names",
                           file_type: str = "file_type", has_file: str | None = None,
                           source_amc: str = "source_amc", out: str = "doc_header_signal",
                           master: Sequence[R.Scheme] = R.SCHEME_MASTER, fuzzy: bool = True) -> DataFrame:
    amc_src, kind = filled(F.col(source_amc)), F.col(file_type)
    there = F.col(header_text).isNotNull() if has_file is None else F.coalesce(F.col(has_file), F.lit(False))
    supported = there & F.coalesce(kind.isin(R.HEADER_FILE_TYPES), F.lit(False))
    low = F.lower(plain_blanks(F.coalesce(F.col(header_text), F.lit(""))))
    filled_text = supported & low.rlike(r"\S")
    staged = df.withColumns({"_text": F.when(filled_text, low), "_supported": supported})
    text = F.col("_text")
    present = text.isNotNull()
    sheets = F.when(present & kind.isin("xlsx", "xls"), F.col(sheet_names))
    staged = staged.withColumn(
        "_fz", Z.scheme_in_text(text, R.FUZZY_HEADER_CUT, master) if fuzzy else _no_match()
    ).withColumn(
        "_fs",
        Z.scheme_by_sheets(F.when(F.col("_fz.scheme_name").isNull(), sheets), R.FUZZY_SHEET_CUT, master)
        if fuzzy else F.lit(None).cast(Z.SHEET_MATCH),
    ).withColumns(
        {
            "_amc": first_matching(text, R.HEADER_AMC),
            "_period": header_period(text),
            "_doc_type": first_matching(text, R.HEADER_DOC_TYPE),
        }
    )
    rule_amc = F.col("_amc")
    first_word = F.get(F.split(F.trim(F.lower(amc_src)), r"\s+"), F.lit(0))
    src_amc = F.when(rule_amc.isNull() & F.contains(text, first_word), amc_src)
    amc = F.coalesce(rule_amc, src_amc)
    period = F.col("_period")
    fz, fs = F.col("_fz.scheme_name"), F.col("_fs.scheme_name")
    found = (
        hit(amc.isNotNull()) + F.lit(2) * hit(period.isNotNull()) + hit(fz.isNotNull())
        + F.coalesce(F.col("_fs.hits"), F.lit(0)) + hit(F.col("_doc_type").isNotNull())
    )
    c0 = cap1(found / F.lit(5) * F.lit(1.2))
    c1 = F.when(period.isNotNull(), cap1(c0 + F.lit(0.2))).otherwise(c0)
    c2 = F.when(rule_amc.isNotNull(), cap1(c1 + F.lit(0.1))).otherwise(c1)
    signal = _signal(
        "doc_header", present,
        amc=amc, scheme=F.coalesce(fz, fs), month=period["month"], year=period["year"],
        category=F.when(fz.isNotNull(), F.col("_fz.scheme_category")).otherwise(F.col("_fs.scheme_category")),
        doc_type=F.col("_doc_type"), confidence=c2, found=found,
        absent_confidence=F.when(F.col("_supported"), F.lit(0.1)).otherwise(F.lit(0.0)),
        evidence={
            "amc_header_match": rule_amc.isNotNull(), "amc_source_confirmed": src_amc.isNotNull(),
            "period_as_on": period.isNotNull(), "scheme_fuzzy_match": fz.isNotNull(),
            "scheme_from_sheet": fs.isNotNull(), "doc_type_header": F.col("_doc_type").isNotNull(),
        },
    )
    return staged.withColumn(out, signal).drop("_text", "_supported", "_amc", "_period", "_doc_type", "_fz", "_fs")
