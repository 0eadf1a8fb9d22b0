"""Fuzzy line dedup (native): MinHash over character shingles, exact check, union-find, one line per component.

Lines are compared trimmed and lower-cased, as sets of all their overlapping character shingles (``SHINGLE`` signs from
every sign on). A line's signature is one-permutation MinHash: every shingle has one 64-bit hash, which falls into one of
33 bins, and each bin keeps its least, taken by an aggregate that combines on the map side, so a line that stands a
million times is one row before the shuffle. A bin without a shingle takes the value of the first filled bin in a fixed
random order of its own. Eleven bands of three bins give high recall; candidates are confirmed by the exact Jaccard
similarity of their whole shingle sets and joined into components by ``links.similar_components``. Of each component the
first line stays: least document id, then place.

Only DataFrame functions run, on all lines and whole texts.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift.functions.text import settle
from holdsift.llm.common import BLANKS, columns, cut, table
from holdsift.llm.links import similar_components

#: Signs in a shingle, and the shortest line (trimmed) that is compared by shingles; shorter ones are by equality alone.
SHINGLE = 8
MIN_CHARS = 20
PERCENT = 80
#: At 80 % similarity a pair misses all buckets with probability (1 - 0.8**3)**11 = 0.0004; bins that share a shingle make
#: it differ a little with the length of the lines (a test measures it).
BANDS, ROWS = 11, 3
#: Bins that an empty bin asks one after the other before it takes the least value of all.
ASKED = 6

#: Bytes of a sign in the encoding in which shingles are cut: all signs have the same length there.
_WIDE, _SIGN = "UTF-32", 4


def _norm(line: Column) -> Column:
    return F.trim(F.lower(line))


def _starts(norm: Column) -> Column:
    """The 1-based byte places, in the wide encoding, at which a shingle starts."""
    last = F.greatest(F.char_length(norm) - SHINGLE, F.lit(0)) * _SIGN + 1
    return F.sequence(F.lit(1), last, F.lit(_SIGN))


def _shingle(wide: Column, start: Column) -> Column:
    return F.xxhash64(F.substring(wide, start, F.lit(SHINGLE * _SIGN)))


def _shingles(norm: Column) -> Column:
    """Hashes of the overlapping shingles; a line shorter than one is its own only shingle."""
    return F.element_at(F.transform(F.array(F.encode(norm, _WIDE)), lambda wide: F.transform(
        _starts(norm), lambda start: _shingle(wide, start))), 1)


def _items(norm: Column) -> Column:
    return F.array_distinct(_shingles(norm))


def _least(bins: int) -> list[Column]:
    """Per ``bin`` the least hash ``h`` that falls into it, null for none: a shingle changes one bin only."""
    return [F.expr(f"min(h) FILTER (WHERE bin = {i})").alias(f"b{i}") for i in range(bins)]


def _filled(bins: int) -> list[Column]:
    """The bins ``b0`` ... without gaps; ``least`` is the least of all."""
    rng, out = random.Random(11), []
    for i in range(bins):
        others = rng.sample([j for j in range(bins) if j != i], ASKED)
        out.append(F.coalesce(*(f"b{j}" for j in (i, *others)), "least").alias(f"m{i}"))
    return out


def lines_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pos, norm, line_id) of the lines that hold a word."""
    return (
        columns(docs, doc_id=id_col, text=text_col).filter("doc_id is not null")
        .select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
        .filter(F.btrim("line", F.lit(BLANKS)) != "")
        .select("doc_id", "pos", settle(_norm(F.col("line"))).alias("norm"))
        .withColumn("line_id", F.xxhash64("norm"))
    )


def _buckets(lines: DataFrame) -> DataFrame:
    k = BANDS * ROWS
    hashed = (
        lines.select("line_id", "norm", F.encode("norm", _WIDE).alias("wide"))
        .select("line_id", "wide", F.explode(_starts(F.col("norm"))).alias("start"))
        .select("line_id", _shingle(F.col("wide"), F.col("start")).alias("h"))
        .select("line_id", F.shiftright("h", 32).alias("h"), F.pmod("h", F.lit(k)).alias("bin"))
    )
    binned = hashed.groupBy("line_id").agg(*_least(k))
    filled = binned.withColumn("least", F.least(*(f"b{i}" for i in range(k)))).select("line_id", *_filled(k))
    bands = [F.xxhash64(F.lit(b), *(f"m{b * ROWS + r}" for r in range(ROWS))) for b in range(BANDS)]
    signed = cut(filled.select(F.col("line_id").alias("id"), F.array(*bands).alias("bands")))
    return signed.select("id", F.explode("bands").alias("bucket"))


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                  min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, pos, line_id) of every line that goes, because one like it stands earlier."""
    lines = lines_of(docs, id_col, text_col)
    placed = cut(lines.select("doc_id", "pos", "line_id"))
    firsts = cut(
        placed.groupBy("line_id", "doc_id").agg(F.min("pos").alias("pos"), F.count("*").alias("n"))
        .groupBy("line_id").agg(F.min("doc_id").alias("doc_id"), F.min_by("pos", "doc_id").alias("pos"), F.sum("n").alias("n"))
    )

    def sets_of(ids: DataFrame) -> DataFrame:
        wanted = firsts.join(ids.withColumnRenamed("id", "line_id"), "line_id").select("doc_id", "pos", "line_id")
        texts = lines.join(wanted, ["doc_id", "pos", "line_id"], "left_semi")
        return texts.select(F.col("line_id").alias("id"), F.col("norm").alias("items"))

    components = cut(similar_components(_buckets(lines.filter(F.char_length("norm") >= min_chars)), sets_of, percent, items_of=_items))
    # a line that stands once and is like no other takes no further part
    grouped = firsts.join(components.withColumnRenamed("id", "line_id"), "line_id", "left").filter(
        "n > 1 or component is not null").withColumn("component", F.coalesce("component", "line_id"))
    owners = (
        grouped.groupBy("component", "doc_id").agg(F.min("pos").alias("pos"), F.sum("n").alias("n"))
        .groupBy("component")
        .agg(F.min("doc_id").alias("owner_doc"), F.min_by("pos", "doc_id").alias("owner_pos"), F.sum("n").alias("n"))
        .filter("n > 1")
    )
    repeated = cut(grouped.select("line_id", "component").join(cut(owners), "component").select("line_id", "owner_doc", "owner_pos"))
    return (
        placed.join(repeated, "line_id")
        .filter((F.col("doc_id") != F.col("owner_doc")) | (F.col("pos") != F.col("owner_pos")))
        .select("doc_id", "pos", "line_id")
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and two new columns ``lines_before``, ``lines_dropped``.

    Defined results: a null text stays null with no lines; lines without a word stay; lines under
    ``min_chars`` signs go only where an equal one stands earlier; a document whose id is null takes no part and stays as
    it is; of equal lines the one with the least document id, then the first place, stays; rows that share an id share its lines, and a line goes from each row that has it at
    the dropped place; a document all of whose lines go has an empty text. An empty table gives no rows.
    """
    mark = lambda pos, line_id: F.xxhash64(pos.cast("int"), line_id)
    gone = (
        dropped_lines(docs, id_col, text_col, percent, min_chars)
        .groupBy("doc_id").agg(F.collect_set(mark(F.col("pos"), F.col("line_id"))).alias("__gone"))
        .withColumnRenamed("doc_id", "__doc")
    )
    split = F.split(F.col(text_col), "\n")
    kept = F.filter(split, lambda line, i: ~F.array_contains(F.col("__gone"), mark(i, F.xxhash64(_norm(line)))))
    return (
        docs.join(gone, docs[id_col] == gone["__doc"], "left")
        .withColumn("__kept", F.when(F.col("__gone").isNotNull(), kept))
        .withColumn("lines_before", F.when(F.col(text_col).isNull(), 0).otherwise(F.size(split)).cast("long"))
        .withColumn("lines_dropped", F.when(F.col("__kept").isNull(), 0)
                    .otherwise(F.col("lines_before") - F.size("__kept")).cast("long"))
        .withColumn(text_col, F.when(F.col("__kept").isNull(), F.col(text_col)).otherwise(F.array_join("__kept", "\n")))
        .select(*docs.columns, "lines_before", "lines_dropped")
    )


def op10_line_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select(
        "doc_id", F.col("lines_before").alias("n_lines"), F.col("lines_dropped").alias("n_dropped"),
        F.char_length("text").cast("long").alias("n_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
