"""Period (month, year) expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions.text import let

_WORDS = [w for w, _ in R.MONTH_WORDS]
_NUMBERS = [n for _, n in R.MONTH_WORDS]
_ANY = "|".join(_WORDS)
_WIDTH = max(map(len, _WORDS)) + 2
_LAID = "".join(f"|{w} ".ljust(_WIDTH) for w in _WORDS)
_LONE = rf"\b({_ANY})\b"
_BESIDE = rf"\b(?:{_ANY})\b\s*(?:[_\-\s]+)?\b(?:20[0-9]{{2}}|[2-3][0-9])\b"
# zero-width, so that words sharing a letter are all seen
_INSIDE = rf"(?=({_ANY}))"
_SHORT_YEAR_TOKEN = r"(?:^|[_\-\s.,/])(2[0-9]|30)(?:$|[_\-\s.,/])"


def full_year(text: Column) -> Column:
    """Two or four digits to a year."""
    # no text, the common case, is not tried: a cast that fails costs an exception
    return let(F.when(text != "", text.try_cast("int")), lambda y: F.when(y < 100, y + 2000).otherwise(y))


def _rank(word: Column) -> Column:
    """Place of a month word in the rule order (1-based), found by one search of the list laid out in equal pieces."""
    at = F.instr(F.lit(_LAID), F.concat(F.lit("|"), word, F.lit(" ")))
    return F.floor((at + _WIDTH - 1) / _WIDTH).cast("int")


def _number(rank: Column) -> Column:
    return F.get(F.lit(_NUMBERS), rank - 1)


def _first_in_order(text: Column, pattern: str) -> Column:
    """Month of the matched word that comes first in the rule order, wherever it stands."""
    return _number(F.array_min(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), _rank)))


def month_inside(text: Column) -> Column:
    """Month whose name occurs anywhere in the text, even inside another word."""
    return _first_in_order(text, _INSIDE)


def period_from_text(text: Column) -> Column:
    """struct(month, year) from free text; either part may be null.

    A month word followed by a year decides when present; otherwise the first
    four-digit year (or a lone two-digit token 20..30) and the first month word
    are taken independently.
    """

    def read(low):
        pairs = F.transform(
            F.regexp_extract_all(low, F.lit(_BESIDE), F.lit(0)),
            lambda m, i: F.struct(
                _rank(F.regexp_extract(m, "^[a-z]+", 0)).alias("rank"), i.alias("at"),
                F.regexp_extract(m, "([0-9]+)$", 1).alias("year"),
            ),
        )
        four = F.regexp_extract(low, R.YEAR_4, 1)
        lone_year = F.when(four != "", four.try_cast("int")).otherwise(
            full_year(F.regexp_extract(low, _SHORT_YEAR_TOKEN, 1))
        )
        return let(
            F.array_min(pairs),
            lambda b: F.when(
                b.isNotNull(), F.struct(_number(b["rank"]).alias("month"), full_year(b["year"]).alias("year"))
            ).otherwise(F.struct(_first_in_order(low, _LONE).alias("month"), lone_year.alias("year"))),
        )

    return let(F.lower(text), read)


def period_label(month: Column, year: Column) -> Column:
    """``June 2026``; null unless both parts are usable."""
    names = F.array(*[F.lit(m) for m in R.MONTH_LABELS])
    return F.when(
        month.between(1, 12) & year.isNotNull() & (year != 0),
        F.concat_ws(" ", F.get(names, month - 1), year.cast("string")),
    )


def month_in_range(month: Column) -> Column:
    return month.isNull() | month.between(1, 12)


def months_old(month: Column, year: Column, as_of: Column) -> Column:
    """Age in 30-day months at ``as_of``; null when the parts are no date."""
    ok = month.between(1, 12) & year.between(1, 9999)
    first = F.when(ok, F.make_date(year, month, F.lit(1)))
    return F.datediff(as_of, first) / F.lit(30)
