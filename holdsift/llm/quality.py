"""Quality by weak supervision: rules vote or abstain, expectation-maximisation weighs them, a posterior decides.

Each rule looks at a document and votes good, bad or nothing. How accurate the rules are is not assumed: the votes of
all documents are counted by pattern (a bounded table, at most three values to the power of the rules), and EM fits a
two-class model in which rules err independently given the class. A document is kept on its posterior probability of
being good, so one failed rule no longer settles the matter and several weak ones can.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift.llm import textkernel as tk
from holdsift.llm.common import columns, cut, table

WINDOW = 8
KEEP_AT = 0.5
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"
SHOUT = "!"

_COUNTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters",
            "n_digits", "n_shouts", "n_marked")
_SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in _COUNTED)


def _member(chars: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[ord(c) for c in chars]] = True
    return table


_IS_SYMBOL, _IS_SHOUT = _member(SYMBOLS), _member(SHOUT)
_UPPER, _LOWER, _DIGIT = _member("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _member("abcdefghijklmnopqrstuvwxyz"), _member("0123456789")
_CONTINUES = (np.arange(256) & 0xC0) == 0x80


def counts(data: np.ndarray, offsets: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """One row of ``_COUNTED`` per document of a stretch."""
    words = tk.Words(data, offsets)
    docs = len(offsets) - 1
    per_doc = lambda flags, at=offsets: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])
    n_words = np.diff(words.first)
    # repeated windows: equal hashes of one document stand side by side after sorting
    hashes, first = words.windows(width)
    doc_of = np.repeat(np.arange(docs), np.diff(first))
    keyed = hashes ^ tk.mix64(doc_of.astype(np.uint64) + np.uint64(1 << 40))
    order = np.argsort(keyed)
    same = keyed[order][1:] == keyed[order][:-1]
    repeated = np.zeros(len(hashes), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    at = np.flatnonzero(repeated)
    begins = words.first[doc_of[at]] + at - first[doc_of[at]]
    cover = np.zeros(len(words.hash) + 1, np.int64)
    np.add.at(cover, begins, 1)
    np.add.at(cover, begins + width, -1)
    covered = np.cumsum(cover)[:-1] > 0
    # lines with a word that equal an earlier line of the document
    n = len(data)
    breaks = np.flatnonzero(data == 10)
    begin = np.concatenate([offsets[:-1], breaks + 1])
    line_doc = np.concatenate([np.arange(docs), np.searchsorted(offsets, breaks, "right") - 1])
    sort = np.lexsort((begin, line_doc))
    begin, line_doc = begin[sort], line_doc[sort]
    last = np.append(line_doc[1:] != line_doc[:-1], True) if len(begin) else np.zeros(0, bool)
    end = np.where(last, offsets[line_doc + 1], np.append(begin[1:], n + 1) - 1)
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, begin)
    up, down = tk._POWERS.upto(max(n, 1))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tk._VALUE[data] * up[:n], dtype=np.uint64)])
    line = tk.mix64((total[end] - total[begin]) * down[np.minimum(begin, max(n - 1, 0))] + (end - begin).astype(np.uint64))
    line = (line ^ tk.mix64(line_doc.astype(np.uint64)))[has_word]
    uniques = np.unique(line, return_index=True)[1]
    duplicate = np.ones(len(line), bool)
    duplicate[uniques] = False
    lined = line_doc[has_word]
    symbol = _IS_SYMBOL[data]
    marked = np.zeros(len(words.hash), bool)
    if len(words.end):
        tail = data[words.end - 1]
        marked = _IS_SYMBOL[tail] | _IS_SHOUT[tail]
    upper = _UPPER[data]
    return np.stack([
        n_words, per_doc(~words.blank & ~_CONTINUES[data]), per_doc(symbol), np.bincount(lined[duplicate], minlength=docs),
        per_doc(covered, words.first), np.bincount(lined, minlength=docs), per_doc(upper), per_doc(upper | _LOWER[data]),
        per_doc(_DIGIT[data]), per_doc(_IS_SHOUT[data]), per_doc(marked, words.first),
    ], axis=1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [counts(data, offsets) for _, _, data, offsets in tk.stretches(batch.column(1))]
        table = np.concatenate(found) if found else np.zeros((0, len(_COUNTED)), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pc.cast(batch.column(0), pa.int64()), *(pa.array(np.ascontiguousarray(c), pa.int64()) for c in table.T)],
            ["doc_id", *_COUNTED])


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of every whole text; a null text counts as empty."""
    return columns(docs, doc_id=id_col, text=text_col).mapInArrow(_count, _SCHEMA)


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``bad`` holds, else good where ``good`` holds, else abstains. ``trust``: EM's first guess of how often a bad
    vote is right; a bad document need trip few of the rules."""

    name: str
    bad: str
    good: str
    trust: float = 0.8


#: Thresholds in percent, written as products so that a text without words needs no division.
RULES: tuple[Rule, ...] = (
    Rule("length", "n_words < 20", "n_words >= 50", 0.5),
    Rule("word_length", "word_chars < 3 * n_words or word_chars > 10 * n_words", "word_chars between 4 * n_words and 8 * n_words", 0.6),
    Rule("symbols", "100 * n_symbols > 10 * n_words", "100 * n_symbols < 2 * n_words", 0.9),
    Rule("repeats", "100 * n_repeat_words > 30 * n_words", "100 * n_repeat_words < 10 * n_words", 0.9),
    Rule("lines", "100 * n_dup_lines > 30 * n_lines", "100 * n_dup_lines < 10 * n_lines", 0.8),
    Rule("capitals", "100 * n_upper > 40 * n_letters", "100 * n_upper < 15 * n_letters", 0.9),
    Rule("digits", "100 * n_digits > 15 * word_chars", "100 * n_digits < 5 * word_chars", 0.6),
    Rule("marks", "100 * n_marked > 20 * n_words", "100 * n_marked < 5 * n_words", 0.9),
)


def votes(rules: Sequence[Rule] = RULES) -> Column:
    """The pattern of a document's votes as a string of b, g and - in the order of the rules."""
    return F.concat(*(F.expr(f"CASE WHEN {r.bad} THEN 'b' WHEN {r.good} THEN 'g' ELSE '-' END") for r in rules))


def fit(patterns: dict[str, int], rules: Sequence[Rule] = RULES, rounds: int = 200, prior: float = 0.7,
        strength: float = 20.0) -> dict[str, float]:
    """Posterior probability of good for each vote pattern, by EM over their counts.

    Each rule has its own chances of voting good, bad or nothing in each class; ``trust`` seeds them and stays in as
    ``strength`` imagined documents, which keeps the classes from trading places and small corpora from extremes.
    """
    if not patterns:
        return {}
    names = sorted(patterns)
    weight = np.array([patterns[p] for p in names], float)
    code = np.array([["gb-".index(c) for c in p] for p in names])
    seen = np.stack([(code == v).astype(float) for v in range(3)], axis=2)  # pattern, rule, vote
    share = np.einsum("p,prv->rv", weight, seen) / weight.sum()
    trust = np.array([r.trust for r in rules])
    bad_vote, silent = np.maximum(share[:, 1], 1e-4), share[:, 2]
    first = np.empty((2, len(rules), 3))  # class (good, bad), rule, vote
    for c, part in enumerate(((1 - trust) * bad_vote / prior, trust * bad_vote / (1 - prior))):
        part = np.minimum(part, 0.9 * (1 - silent))
        first[c] = np.stack([1 - part - silent, part, silent], axis=1)
    chance, good = first.copy(), prior
    for _ in range(rounds):
        log = np.einsum("prv,crv->pc", seen, np.log(chance + 1e-12)) + np.log([good, 1 - good])
        post = 1 / (1 + np.exp(np.clip(log[:, 1] - log[:, 0], -60, 60)))
        mass = np.stack([post * weight, (1 - post) * weight], axis=1)
        chance = np.einsum("pc,prv->crv", mass, seen) + strength * first
        chance /= chance.sum(axis=2, keepdims=True)
        good = float((mass[:, 0].sum() + strength * prior) / (weight.sum() + strength))
    return dict(zip(names, post.tolist()))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES,
            keep_at: float = KEEP_AT) -> DataFrame:
    """Counts, votes, posterior ``p_good``, base_failed and kept of every document.

    Defined results: a null, empty or wordless text has zero counts and fails the base rules; repeated rows are judged
    alike and each counts; null ids pass through; an empty table gives no rows.
    """
    measured = cut(measure(docs, id_col, text_col).withColumn("votes", votes(rules)))
    patterns = {r["votes"]: r["count"] for r in measured.groupBy("votes").count().collect()}  # at most 3**len(rules)
    posterior = fit(patterns, rules)
    spark = docs.sparkSession
    table = spark.createDataFrame(sorted(posterior.items()), "votes string, p_good double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return (
        measured.join(F.broadcast(table), "votes")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("p_good") >= keep_at))
    )


def op9_quality(spark, sf_dir):
    return quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "votes",
        F.round("p_good", 6).alias("p_good"))
