"""Header and cell expressions for raw table grids."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions.text import any_of, first_match, let, parse_number

HEADERS = {"excel": R.EXCEL_HEADERS, "pdf": R.PDF_HEADERS}


#: ASCII signs that ``normalize_header`` drops.
_DROPPED = "".join(c for c in map(chr, range(128)) if not re.match(r"[a-z0-9 \t\n\x0b\f\r%.]", c))


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def normalize_header(cell: Column) -> Column:
    low = F.lower(cell)
    # plain ASCII, nearly every cell, needs no pattern
    return F.trim(F.when(_ascii(low), F.translate(low, _DROPPED, "")).otherwise(F.regexp_replace(low, r"[^a-z0-9\s%.]", "")))


def _any_spelling(variants) -> str:
    """Pattern that occurs wherever one of the spellings does."""
    words = {v for _, vs in variants for v in vs}
    words = sorted(w for w in words if not any(o != w and o in w for o in words))
    any_of_them = "|".join(re.escape(w) for w in words)
    # a look at the next sign spares trying every spelling at every place
    return f"(?=[{''.join(sorted({re.escape(w[0]) for w in words}))}])(?:{any_of_them})" if all(words) else any_of_them


def header_field(cell: Column, dialect: str, headers=None) -> Column:
    """Standard field of a header cell: first field, in list order, one of whose spellings it contains."""
    usable = cell != ""

    def chain(norm):
        def spelled(variants):
            whole = [v for v in variants if dialect == "excel" and v == "name"]
            inside = [v for v in variants if v not in whole]
            # a longer spelling that contains a shorter one adds nothing to "contains"
            inside = [v for v in inside if not any(o != v and o in v for o in inside)]
            return any_of([norm == v for v in whole] + [norm.contains(v) for v in inside])

        table = headers or HEADERS[dialect]
        # one pass tells most data cells apart from headers before the rules are tried
        rules = F.when(norm.rlike(_any_spelling(table)), first_match(spelled, [(v, f) for f, v in table]))
        return F.when(~norm.contains("unnamed"), rules) if dialect == "excel" else rules

    return let(F.when(usable, normalize_header(cell)), chain)


def row_text(cells: Column) -> Column:
    """A row as lower-cased text, each cell on lines of its own."""
    return F.lower(F.array_join(cells, "\n"))


def may_be_header(text: Column, dialect: str, min_mapped: int, headers=None) -> Column:
    """False only where fewer than ``min_mapped`` cells of a row (``row_text``) can have a ``header_field``.

    One pass counts the spellings in the row; none reaches from cell to cell. Rows with signs beyond ASCII are left to
    the full test.
    """
    table = headers or HEADERS[dialect]
    if any("\n" in v for _, vs in table for v in vs):
        return F.lit(True)
    spelled = F.regexp_count(F.translate(text, _DROPPED, ""), F.lit(_any_spelling(table)))
    return ~_ascii(text) | (spelled >= min_mapped)


def null_markers(cell: Column, markers=None, trim: bool = False) -> Column:
    """Null for the empty and not-available spellings."""
    if markers is None:
        markers = R.NULL_MARKERS + R.NULL_MARKERS_LIBRARY
    probe = F.trim(cell) if trim else cell
    return F.when(~probe.isin(list(markers)), cell)


def clean_number_text(value: Column) -> Column:
    """Drop commas and blanks; brackets mean minus."""
    t = F.regexp_replace(value, r"[,\s]", "")
    return F.replace(F.replace(t, F.lit("("), F.lit("-")), F.lit(")"), F.lit(""))


def number_cell(value: Column, dialect: str) -> Column:
    """struct(num, txt): text that is no number stays as text, empty markers give neither."""

    def read(v):
        def parse(t):
            empty = t.isin(R.EMPTY_NUMBERS[dialect])
            return let(
                F.when(~empty, parse_number(t)),
                lambda n: F.struct(n.alias("num"), F.when(~empty & n.isNull(), v).alias("txt")),
            )

        return let(clean_number_text(v), parse)

    return let(F.trim(value), read)


def publish_number(value: Column) -> Column:
    """Number at publish time: commas and outer blanks dropped, anything else is null."""
    return parse_number(F.trim(F.replace(value, F.lit(","), F.lit(""))))


def clean_isin(value: Column) -> Column:
    return F.upper(F.trim(value))


def isin_length_ok(value: Column) -> Column:
    return value.isNull() | (F.length(value) == 12)


def isin_shape_ok(value: Column) -> Column:
    return value.rlike(R.ISIN_SHAPE)


def header_hash(headers: Column, dialect: str) -> Column:
    """Order-insensitive hash of the normalised header names."""
    kept = F.filter(headers, lambda h: h.isNotNull() & (h != "")) if dialect == "pdf" else headers
    return F.substring(
        F.sha2(F.array_join(F.sort_array(F.transform(kept, normalize_header)), "|"), 256), 1, 16
    )


def excel_column_names(cells: Column) -> Column:
    """Column names a spreadsheet reader gives: ``Unnamed: k`` for blanks, ``.1`` ``.2`` on repeats."""
    named = F.transform(
        cells,
        lambda c, i: F.when(c.isNull() | (c == ""), F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(c),
    )

    def numbered(all_names):
        before = lambda c, i: F.size(F.filter(F.slice(all_names, F.lit(1), i), lambda x: x == c))
        return F.transform(
            all_names,
            lambda c, i: F.when(before(c, i) > 0, F.concat(c, F.lit("."), before(c, i).cast("string"))).otherwise(c),
        )

    return let(named, lambda n: F.when(F.size(F.array_distinct(n)) == F.size(n), n).otherwise(numbered(n)))
