"""Phrase collocations per language by best-first branch-and-bound growth of prefixes.

A phrase of two to five words that stands ``a`` times among a language's ``n`` words is scored by its lowest cut into a
first part (``l`` times) and a rest (``r`` times): ``floor(1000 * a * n / (l * r))``. Since ``r >= a``, no phrase that
grows from a first word standing ``f`` times can score above ``floor(1000 * n / f)``: the count of the prefix bounds all
its growth. The frontier is therefore expanded from the best bound on, that is from the rarest frequent words:

1. Words are counted. The frontier is every word that stands ``least`` times or more.
2. Its best part is expanded: phrases are grown from those words, first by one word, then, where every pair in them is
   frequent, up to five. A round is two passes over the texts.
3. Scores of what was found give a floor for the language's ``top``-th surviving score (a count that is not known yet is
   taken at its upper bound). Words whose bound reaches the floor are the next round's; none left settles the language,
   ties included. A floor never falls, so two rounds do, or one.
4. Rests that start with a word never expanded are counted by themselves, only where a found phrase needs them.

A phrase is contained in a longer one of the same count if, and only if, all its occurrences have the same word before
them, or after them, in their piece; so each count carries the least and the greatest neighbour on both sides.

Words travel as 64-bit hashes, and a run whose hashes do not tell its frequent words from all others starts anew with
another seed; phrases are told apart by all their words. Sets that prune the passes are bitmaps of fixed size: they let
too much through rather than too little, and what got through is joined with the exact tables afterwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdsift.llm import textkernel as tk
from holdsift.llm.common import columns, cut, table

LEAST, LONGEST, TOP = 100, 5, 2000
#: Expanded first: words that stand up to so many times ``least``.
PROBE = 8
#: Bits of a pruning bitmap, as a power of two (8 MB, whatever the size of the texts).
BITS = 26
#: Rows a task gathers before it combines them, and words it counts before it hands them on.
GATHERED = 1 << 20
COUNTED = 1 << 18

_SLOTS = [f"w{i + 1}" for i in range(LONGEST)]
_SIDES = ["before_lo", "before_hi", "after_lo", "after_hi"]
_WORD, _BLANK, _BREAK = 0, 1, 2
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK
_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _salt(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.sha256(f"{seed}:{lang}".encode()).digest()[:8], "little")


class Stretch:
    """Words of a stretch of texts: byte bounds, hash (of language and word, never 0), and whether the next word follows
    in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, salts: np.ndarray) -> None:
        n = len(data)
        kind = _KIND[data]
        word = kind == _WORD
        edge = np.ones(n + 1, bool)
        edge[1:] = ~word
        edge[offsets] = True
        self.start = np.flatnonzero(word & edge[:n])
        edge = np.ones(n + 1, bool)
        edge[:n] = ~word
        edge[offsets] = True
        self.end = np.flatnonzero(word & edge[1:]) + 1
        up, down = tk._POWERS.upto(max(n, 1))
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(tk._LOWER[data] * up[:n], out=total[1:])
        self.doc = np.searchsorted(offsets, self.start, "right") - 1
        length = (self.end - self.start).astype(np.uint64)
        own = tk.mix64((total[self.end] - total[self.start]) * down[self.start] + length)
        own = tk.mix64(own ^ salts[self.doc])
        self.hash = np.where(own == 0, np.uint64(1), own)
        piece = np.cumsum(kind == _BREAK)[self.start] + self.doc if n else np.zeros(0, np.int64)
        self.runs_on = np.zeros(len(self.start), bool)
        self.runs_on[:-1] = piece[1:] == piece[:-1]


def _stretches(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[Stretch, np.ndarray, list[str]]]:
    """Over batches (text, lang): stretch, its bytes, language of each of its texts."""
    for batch in batches:
        langs = batch.column(1).to_pylist()
        known = {x: np.uint64(_salt(x, seed)) for x in set(langs)}
        salts = np.array([known[x] for x in langs], np.uint64)
        for row, end, data, offsets in tk.stretches(batch.column(0)):
            yield Stretch(data, offsets, salts[row:end]), data, langs[row:end]


def _mixed(columns_: list[np.ndarray]) -> np.ndarray:
    acc = np.zeros(len(columns_[0]), np.uint64)
    for c in columns_:
        acc = tk.mix64(acc * np.uint64(0xD1342543DE82EF95) + c)
    return acc


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the places of all hashes (one long column), built by an aggregate; its size does not depend on theirs."""
    place = F.shiftrightunsigned(F.col(hashes.columns[0]), 64 - BITS)
    rows = (
        hashes.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    )
    out = np.zeros(1 << (BITS - 6), np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _words_counted(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(lang, hash, word, n), and per language one row without a word, with all its words' number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        names: dict[int, tuple[str, str]] = {}
        totals: dict[str, int] = {}

        def flush() -> pa.RecordBatch:
            rows = [(*names[h], h, n) for h, n in counts.items()] + [(lang, None, 0, n) for lang, n in totals.items()]
            lang, word, own, n = zip(*rows) if rows else ((), (), (), ())
            counts.clear(), names.clear(), totals.clear()
            own = pa.array(np.array(own, np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), own, pa.array(word, pa.string()), pa.array(n, pa.int64())],
                                              ["lang", "hash", "word", "n"])

        for stretch, data, langs in _stretches(batches, seed):
            for d, n in zip(*(x.tolist() for x in np.unique(stretch.doc, return_counts=True))):
                totals[langs[d]] = totals.get(langs[d], 0) + n
            raw = data.tobytes().translate(_FOLD)
            for h, i, n in zip(*(x.tolist() for x in np.unique(stretch.hash, return_index=True, return_counts=True))):
                if h in counts:
                    counts[h] += n
                else:
                    counts[h] = n
                    names[h] = langs[stretch.doc[i]], raw[stretch.start[i]: stretch.end[i]].decode("utf-8", "surrogatepass")
            if len(counts) > COUNTED:
                yield flush()
        yield flush()

    return run


def count_words(texts: DataFrame, least: int, seed: int) -> DataFrame:
    """(lang, hash, word, n, same) of frequent words and totals (word null); ``same``: words that share the hash."""
    counted = (
        texts.mapInArrow(_words_counted(seed), "lang string, hash long, word string, n long")
        .repartition("hash").groupBy("lang", "hash", "word").agg(F.sum("n").alias("n"))  # tasks have added up already
    )
    return cut(counted.withColumn("same", F.count("word").over(Window.partitionBy("hash"))).filter(
        (F.col("n") >= least) | F.col("word").isNull()))


class _Gather:
    """Rows of longs under keys, combined exactly when there are many of them."""

    def __init__(self, keys: int, names: list[str]) -> None:
        self.keys, self.names, self.parts, self.rows = keys, names, [], 0

    def add(self, rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(rows[0]):
            self.parts.append(rows)
            self.rows += len(rows[0])
        if self.rows > GATHERED:
            kept = self._combined()
            if len(kept[0]) > GATHERED // 2:
                yield self._batch(kept)
                self.parts, self.rows = [], 0
            else:
                self.parts, self.rows = [kept], len(kept[0])

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield self._batch(self._combined())

    def _combined(self) -> list[np.ndarray]:
        rows = [np.concatenate(c) for c in zip(*self.parts)]
        order = np.argsort(_mixed([k.view(np.uint64) for k in rows[: self.keys]]))
        rows = [c[order] for c in rows]
        new = np.ones(len(order), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in rows[: self.keys]], axis=0)  # all words, not their mixed hash
        at = np.flatnonzero(new)
        return [c[at] if i < self.keys else (np.add if n == "n" else np.minimum if n.endswith("lo") else np.maximum).reduceat(c, at)
                for i, (c, n) in enumerate(zip(rows, self.names))]

    def _batch(self, rows: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], self.names)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _pairs(seed: int, frequent, fresh):
    """(pair, n): hashes of two neighbouring frequent words of which the first is expanded in this round."""

    def run(batches):
        gather = _Gather(1, ["pair", "n"])
        for s, _, _ in _stretches(batches, seed):
            known = _has(frequent.value, s.hash)
            i = np.flatnonzero(s.runs_on[:-1] & known[:-1] & known[1:] & _has(fresh.value, s.hash[:-1])) if len(s.hash) else s.start
            yield from gather.add([_signed(_mixed([s.hash[i], s.hash[i + 1]])) if len(i) else i, np.ones(len(i), np.int64)])
        yield from gather.rest()

    return run


def _chains(s: Stretch, frequent: np.ndarray, expanded: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word how many further words a phrase from it could take, and whether the word has been expanded."""
    known, grown = _has(frequent, s.hash), _has(expanded, s.hash)
    joins = np.zeros(len(s.hash), bool)
    joins[:-1] = s.runs_on[:-1] & known[:-1] & known[1:]
    at = np.flatnonzero(joins & grown)
    if len(at):
        joins[at] = _has(pairs, _mixed([s.hash[at], s.hash[at + 1]]))
    reach = joins.astype(np.int64)
    for _ in range(LONGEST - 2):
        reach[:-1] = np.where(joins[:-1], 1 + reach[1:], 0)
    return np.minimum(reach, LONGEST - 1), grown & known


def _phrases(seed: int, frequent, expanded, fresh, pairs):
    """(w1 ... w5, n, least and greatest neighbour on both sides) of phrases from words expanded in this round."""

    def run(batches):
        gather = _Gather(LONGEST, [*_SLOTS, "n", *_SIDES])
        for s, _, _ in _stretches(batches, seed):
            if not len(s.hash):
                continue
            reach, _ = _chains(s, frequent.value, expanded.value, pairs.value)
            reach[~_has(fresh.value, s.hash)] = 0
            before = np.zeros(len(s.hash), np.uint64)
            before[1:] = np.where(s.runs_on[:-1], s.hash[:-1], np.uint64(0))
            after = np.zeros(len(s.hash), np.uint64)
            after[:-1] = np.where(s.runs_on[:-1], s.hash[1:], np.uint64(0))
            for m in range(2, LONGEST + 1):
                i = np.flatnonzero(reach >= m - 1)
                words = [_signed(s.hash[i + k]) if k < m else np.zeros(len(i), np.int64) for k in range(LONGEST)]
                left, right = _signed(before[i]), _signed(after[i + m - 1])
                yield from gather.add([*words, np.ones(len(i), np.int64), left, left, right, right])
        yield from gather.rest()

    return run


def _rests(seed: int, frequent, expanded, pairs, wanted):
    """(w1 ... w5, n) of wanted phrases that start with a word never expanded."""

    def run(batches):
        gather = _Gather(LONGEST, [*_SLOTS, "n"])
        for s, _, _ in _stretches(batches, seed):
            if not len(s.hash):
                continue
            reach, grown = _chains(s, frequent.value, expanded.value, pairs.value)
            reach[grown] = 0
            for m in range(2, LONGEST):
                i = np.flatnonzero(reach >= m - 1)
                words = [s.hash[i + k] for k in range(m)]
                there = np.flatnonzero(_has(wanted.value, _mixed(words))) if len(i) else i
                gone = np.zeros(len(there), np.int64)
                yield from gather.add([*(_signed(w[there]) for w in words), *[gone] * (LONGEST - m), np.ones(len(there), np.int64)])
        yield from gather.rest()

    return run


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mixed hash of each phrase (ws) of two to four words, as ``_rests`` forms it."""
    for batch in batches:
        out = [int(_mixed([np.array([w], np.int64).view(np.uint64) for w in ws])[0].view(np.int64)) for ws in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["hash"])


_LONGS = ", ".join(f"{c} long" for c in [*_SLOTS, "n"])
_WS = f"filter(array({', '.join(_SLOTS)}), w -> w != 0)"


def _exact(a: Column) -> Column:
    return a.cast("decimal(19,0)")


def _scored(found: DataFrame, totals: DataFrame, counts: DataFrame) -> DataFrame:
    """``found`` (ws, lang, words, fs, a, contained) with n, score, l, r of the lowest cut; a rest that ``counts`` lacks
    is taken at its rarest word's count, which can only lower the score."""
    cuts = (
        found.join(totals, "lang").withColumn("k", F.explode(F.sequence(F.lit(1), F.size("ws") - 1)))
        .withColumn("left", F.expr("slice(ws, 1, k)")).withColumn("right", F.expr("slice(ws, k + 1, size(ws) - k)"))
        .withColumn("most", F.array_min(F.expr("slice(fs, k + 1, size(ws) - k)")))
    )
    known = counts.select("ws", "n")
    both = (
        cuts.join(known.select(F.col("ws").alias("left"), F.col("n").alias("l")), "left", "left")
        .join(known.select(F.col("ws").alias("right"), F.col("n").alias("r")), "right", "left")
        .withColumn("l", F.when(F.col("k") == 1, F.col("fs")[0]).otherwise(F.col("l")))
        .withColumn("r", F.when(F.col("k") == F.size("ws") - 1, F.element_at("fs", -1)).otherwise(F.coalesce("r", "most")))
        .withColumn("x", F.lit(1000).cast("decimal(4,0)") * (_exact(F.col("a")) * _exact(F.col("n"))))
        .withColumn("y", _exact(F.col("l")) * _exact(F.col("r")))
        .withColumn("score", F.expr("x div y"))
    )
    lowest = F.min(F.struct("score", "k", "l", "r"))
    return (
        both.groupBy("ws", "lang").agg(F.first("words").alias("words"), F.first("a").alias("a"), F.first("n").alias("n"),
                                       F.first("contained").alias("contained"), lowest.alias("low"))
        .select("lang", F.array_join("words", " ").alias("phrase"), "a", "low.l", "low.r", "n", "low.score", "contained")
    )


def _best(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return scored.filter("not contained").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                 probe: int = PROBE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases that no longer one contains.

    Order: score, then ``a``, both descending, then the phrase by its UTF-8 bytes. Defined results: null texts count as
    empty, a null language as ``und``; repeated rows count as often as they stand; a language with fewer phrases gives
    those it has, one without any gives none; an empty table gives no rows. Scores must be below 2**63.
    """
    spark = docs.sparkSession
    send = spark.sparkContext.broadcast
    texts = columns(docs, text=text_col, lang=lang_col).select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    seed = 0
    while True:
        counted = count_words(texts, least, seed)
        if counted.filter("word is not null and same > 1").isEmpty():
            break
        seed += 1
    totals = counted.filter("word is null").select("lang", "n")
    words = counted.filter("word is not null").select("lang", "hash", "word", "n")
    frequent = send(bitmap(words.select("hash")))
    singles = words.select(F.array("hash").alias("ws"), "n")
    nothing = np.zeros(1 << (BITS - 6), np.uint64)
    expanded_bits, pair_bits = nothing, nothing
    limits = totals.select("lang", F.lit(0).cast("long").alias("done"), F.lit(probe * least).cast("long").alias("limit"))
    found = None
    while True:
        # the frontier's best part: a language's words above those done, up to the round's limit
        fresh = words.join(limits, "lang").filter("n > done and n <= limit").select("hash")
        if found is not None and fresh.isEmpty():
            break
        fresh_bits = bitmap(fresh)
        expanded_bits = expanded_bits | fresh_bits
        now, expanded = send(fresh_bits), send(expanded_bits)
        pairs = (
            texts.mapInArrow(_pairs(seed, frequent, now), "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("pair")
        )
        pair_bits = pair_bits | bitmap(pairs)
        paired = send(pair_bits)
        grown = (
            texts.mapInArrow(_phrases(seed, frequent, expanded, now, paired), _LONGS + "".join(f", {c} long" for c in _SIDES))
            .groupBy(*_SLOTS).agg(F.sum("n").alias("a"), *((F.min if c.endswith("lo") else F.max)(c).alias(c) for c in _SIDES))
            .filter(F.col("a") >= least).join(fresh.withColumnRenamed("hash", "w1"), "w1", "left_semi")
        )
        same = lambda side: (F.col(f"{side}_lo") == F.col(f"{side}_hi")) & (F.col(f"{side}_lo") != 0)
        grown = grown.select(F.expr(_WS).alias("ws"), "a", ((F.expr(f"size({_WS})") < LONGEST) & (same("before") | same("after"))).alias("contained"))
        spelt = (
            grown.select("ws", "a", "contained", F.posexplode("ws").alias("i", "hash")).join(words, "hash")
            .groupBy("ws", "a", "contained")
            .agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("i", "word", "n"))).alias("each"))
            .filter(F.size("each") == F.size("ws"))
            .select("ws", "lang", "a", "contained", F.col("each.word").alias("words"), F.col("each.n").alias("fs"))
        )
        found = cut(spelt if found is None else found.unionByName(spelt))
        floor = _best(_scored(found, totals, found.select("ws", F.col("a").alias("n"))), top).filter(F.col("rank") == top)
        reached = F.expr("cast(least((cast(1000 as decimal(4,0)) * cast(n as decimal(19,0))) div greatest(score, 1), n) as long)")
        limits = cut(
            limits.join(totals, "lang").join(floor.select("lang", "score"), "lang", "left")
            .select("lang", F.col("limit").alias("done"), F.greatest("limit", F.when(F.col("score").isNull(), F.col("n")).otherwise(reached)).alias("limit"))
        )
    counts = singles.unionByName(found.select("ws", F.col("a").alias("n")))
    wanted = cut(
        found.withColumn("k", F.explode(F.expr("filter(sequence(2, size(ws)), k -> k < size(ws))")))
        .select(F.expr("slice(ws, k, size(ws) - k + 1)").alias("ws")).distinct()
        .join(counts.select("ws"), "ws", "left_anti")
    )
    if not wanted.isEmpty():
        sought = send(bitmap(wanted.mapInArrow(_hash_rows, "hash long")))
        rests = (
            texts.mapInArrow(_rests(seed, frequent, expanded, paired, sought), _LONGS)
            .groupBy(*_SLOTS).agg(F.sum("n").alias("n")).select(F.expr(_WS).alias("ws"), "n").join(wanted, "ws", "left_semi")
        )
        counts = counts.unionByName(cut(rests))
    return _best(_scored(found, totals, counts), top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents
), grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m
), counts AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE m = 1 GROUP BY lang
), candidates AS (
  SELECT * FROM counts WHERE m > 1 AND f >= 100
), cuts AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, k, array_to_string(string_split(c.phrase, ' ')[1:k], ' ') AS first,
         array_to_string(string_split(c.phrase, ' ')[k + 1:], ' ') AS rest
  FROM candidates c, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE k < c.m
), scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, p.f AS l, q.f AS r, t.n,
         (1000::HUGEINT * c.a * t.n // (p.f::HUGEINT * q.f))::BIGINT AS score
  FROM cuts c JOIN totals t ON t.lang = c.lang JOIN counts p ON p.lang = c.lang AND p.m = c.k AND p.phrase = c.first
  JOIN counts q ON q.lang = c.lang AND q.m = c.m - c.k AND q.phrase = c.rest
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), surviving AS (
  SELECT * FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = s.lang AND c.m > s.m AND 100 * c.f >= 100 * s.a
      AND contains(' ' || c.phrase || ' ', ' ' || s.phrase || ' '))
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM surviving QUALIFY rank <= 2000
"""
