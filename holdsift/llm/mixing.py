"""Mixing sources to target weights by systematic sampling (native).

Every document of a source is expected ``target / source size`` times. Those expectations are prefix-summed
within the source, one random offset is added, and a document is emitted once per integer boundary its stretch
crosses. The documents stand in order of size class, so each stretch of neighbours is alike and the words taken
come within about one document of each size class of the target.

No task ever holds a source: the prefix sum has three levels (size class of the source, slice of the class,
document of the slice). A slice is one of 256 by the digest of the document's id, so even a source of equal sizes
is spread; only counts per class and slice go from level to level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdsift.llm.common import columns, cut, hex_number, table, word_count

WEIGHTS = (5, 2, 1)
SHARE_PERCENT = 150
CAP = 2
SEED = "mix"


def size_class(size: F.Column) -> F.Column:
    """Class of a size, ascending with it: sizes to 15 alone, above that eight classes for each doubling."""
    drop = F.length(F.bin(size)) - 4
    return F.when(size < 16, size).otherwise(drop * 8 + F.expr("shiftright(size, length(bin(size)) - 4)").cast("long"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT,
            cap: int = CAP) -> DataFrame:
    """Word target of each source. ``sizes``: one row per source (source, source_size); adds ``target``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share_percent`` of all sizes. A target
    stops at ``cap`` times its source's size and the excess goes to the others by weight, until none is above: in
    ascending order of cap per weight the full sources form a prefix, the first source that is not full fixes the
    level. The one table sorted in one task here has a row per source.
    """
    everything = Window.partitionBy()
    listed = Window.orderBy(F.col("source").isNull(), "source")
    by_level = Window.orderBy("level", "turn")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*(F.lit(int(w)) for w in weights)), ((F.col("turn") - 1) % len(weights) + 1).cast("int"))
    return (
        sizes.withColumn("turn", F.row_number().over(listed)).withColumn("weight", weight.cast("long"))
        .withColumn("most", F.lit(int(cap)) * F.col("source_size"))
        .withColumn("level", F.col("most") / F.col("weight"))
        .withColumn("pool", F.sum("source_size").over(everything) * F.lit(share_percent) / F.lit(100.0))
        .withColumn("rate", (F.col("pool") - F.coalesce(F.sum("most").over(before), F.lit(0)))
                    / F.sum("weight").over(onward))
        .withColumn("full", F.col("rate") >= F.col("level"))
        .withColumn("final", F.min_by(F.when(~F.col("full"), F.col("rate")),
                                      F.when(~F.col("full"), F.struct("level", "turn"))).over(everything))
        .select("source", "source_size",
                F.when(F.col("full"), F.col("most").cast("double"))
                .otherwise(F.col("final") * F.col("weight")).alias("target"))
    )


def mix_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
               weights: Sequence[int] = WEIGHTS, share_percent: int = SHARE_PERCENT, cap: int = CAP,
               seed: str = SEED) -> DataFrame:
    """How often each document is taken: doc_id, size, source_size, target, copies, taken.

    Defined results: a null or empty text has size 0 and takes no words; a null source is a source of its own, the
    last; a source without words has target 0 and no copies; repeated rows are separate documents; equal sizes go
    by id; an empty table gives no rows. A rerun gives the same counts, the offset being a digest of seed and source.
    """
    sized = cut(
        columns(docs, doc_id=id_col, text=text_col, source=source_col)
        .select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .withColumn("stratum", size_class(F.col("size")))
        .withColumn("slice", F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 2))
        .withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
    )
    slices = sized.groupBy("key", "source", "stratum", "slice").agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    strata = slices.groupBy("key", "source", "stratum").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    sources = targets(strata.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share_percent, cap)
    sources = (
        sources.withColumn("key", F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
        .withColumn("offset", hex_number(F.md5(F.concat(F.lit(seed), "key")), 1, 8) / F.lit(float(2**32)))
        .drop("source")
    )
    ahead = lambda *order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    strata = strata.withColumn("start", F.coalesce(F.sum("n").over(ahead("stratum").partitionBy("key")), F.lit(0)))
    starts = (
        slices.withColumn("within", F.coalesce(F.sum("n").over(ahead("slice").partitionBy("key", "stratum")), F.lit(0)))
        .join(strata.select("key", "stratum", "start"), ["key", "stratum"])
        .join(sources, "key")
        .select("key", "stratum", "slice", (F.col("start") + F.col("within")).alias("start"),
                "source_size", "target", "rate", "offset")
    )
    rank = F.row_number().over(Window.partitionBy("key", "stratum", "slice").orderBy("size", "doc_id"))
    end = F.floor(F.col("place") * F.col("rate") + F.col("offset"))
    begin = F.floor((F.col("place") - 1) * F.col("rate") + F.col("offset"))
    return (
        sized.withColumn("rank", rank).join(starts, ["key", "stratum", "slice"])
        .withColumn("place", F.col("start") + F.col("rank"))
        .withColumn("copies", end - begin)
        .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )


def mix(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as ``mix_counts`` takes its document (its columns unchanged).

    Rows that share an id share their counts, added up over the rows and dealt out evenly; see ``mix_counts``.
    """
    counts = mix_counts(docs, id_col=id_col, **options)
    per_id = counts.groupBy(F.col("doc_id").alias("__id")).agg(F.sum("copies").alias("__sum"), F.count("*").alias("__rows"))
    taken = per_id.select("__id", F.ceil(F.col("__sum") / F.col("__rows")).cast("int").alias("__copies"))
    return (
        docs.join(taken, docs[id_col].eqNullSafe(taken["__id"]))
        .filter("__copies > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies")))
        .select(*docs.columns)
    )


def op2_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mix_counts(docs).select("doc_id", "size", "source_size", "target", "taken")


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), sliced AS (
  SELECT *, CASE WHEN size < 16 THEN size ELSE (length(bin(size)) - 4) * 8 + (size >> (length(bin(size)) - 4)) END AS stratum,
         substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 2) AS slice FROM sized
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS turn,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)] AS weight FROM totals
), levels AS (
  SELECT *, 2 * source_size AS most, (2 * source_size)::DOUBLE / weight AS level FROM weighed
), rates AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 150 / 100.0
             - coalesce(sum(most) OVER (ORDER BY level, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER (ORDER BY level, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS rate
  FROM levels
), fixed AS (
  SELECT *, CASE WHEN rate >= level THEN most::DOUBLE
                 ELSE (SELECT arg_min(rate, (level, turn)) FROM rates WHERE rate < level) * weight END AS target,
         ('0x' || substr(md5('mix' || coalesce('=' || source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM rates
), placed AS (
  SELECT s.doc_id, s.size, f.source_size, f.target, f.shift,
         CASE WHEN f.source_size > 0 THEN f.target / f.source_size::DOUBLE ELSE 0.0::DOUBLE END AS share,
         row_number() OVER (PARTITION BY s.source ORDER BY s.stratum, s.slice, s.size, s.doc_id) AS place
  FROM sliced s JOIN fixed f ON s.source IS NOT DISTINCT FROM f.source
)
SELECT doc_id, size, source_size, target,
       CAST(floor(place * share + shift) - floor((place - 1) * share + shift) AS BIGINT) * size AS taken
FROM placed
"""
