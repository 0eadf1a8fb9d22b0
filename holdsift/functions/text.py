"""Small column builders used by several operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdsift.rules import FLOAT_SHAPE


def first_match(test, rules: Iterable[tuple[str, object]]) -> Column:
    """CASE WHEN over ordered (key, value) rules; ``test(key)`` gives the condition."""
    chain = None
    for key, value in rules:
        v = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(test(key), v) if chain is None else chain.when(test(key), v)
    return chain


def first_containing(text: Column, rules) -> Column:
    return first_match(lambda k: text.contains(k), rules)


def first_matching(text: Column, rules) -> Column:
    return first_match(lambda p: text.rlike(p), rules)


def contains_any(text: Column, words: Sequence[str]) -> Column:
    cond = text.contains(words[0])
    for w in words[1:]:
        cond = cond | text.contains(w)
    return cond


def any_of(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def filled(col: Column) -> Column:
    """Null for null or empty text, else the text."""
    return F.when(col != "", col)


def hit(cond: Column) -> Column:
    """1 where the condition holds, 0 where it is false or null."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def parse_number(col: Column) -> Column:
    """Text to double; null unless the whole text has the shape of a float."""
    return F.when(col.rlike(FLOAT_SHAPE), col.try_cast("double"))


def parse_int(col: Column) -> Column:
    """Text to int the way a plain integer parse does: blanks around and one sign are fine."""
    t = F.trim(col)
    return F.when(t.rlike(r"^[+-]?\d{1,9}$"), t.try_cast("int"))


def clamp01(col: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), col))


def cap1(col: Column) -> Column:
    return F.least(F.lit(1.0), col)


def let(value: Column, body) -> Column:
    """Bind ``value`` once for ``body``: an expression used inside a lambda is otherwise run per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settle(col: Column) -> Column:
    """The same value, but computed once, where it is defined.

    Filters on a derived column are pushed down by copying its definition into the
    filter, stage by stage; for a deep chain of rules that copy grows out of hand and
    Python stages run twice.  A term the optimizer must not move stops that here.
    """
    return F.when(F.spark_partition_id() >= 0, col)
