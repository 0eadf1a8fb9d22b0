"""Signatures of lines: a shingle counts for one bin only, gaps are filled alike, and similar lines meet in a bucket."""

import random

from pyspark.sql import functions as F

from holdsift.llm import linededup


def drawn(rng, n):
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n - 1)) + "."


def lines_of(spark, texts):
    return linededup.lines_of(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_each_bin_keeps_the_least_of_its_own_shingles(spark):
    rng, bins = random.Random(2), linededup.BANDS * linededup.ROWS
    lines = lines_of(spark, [drawn(rng, n) for n in (5, 20, 60, 400)] + ["-" * 300, "これは単語の間に空白を置かない文章の一行です" * 3])
    sets = lines.select("line_id", linededup._shingles(F.col("norm")).alias("s"))
    want = {r.line_id: [min((h >> 32 for h in r.s if h % bins == i), default=None) for i in range(bins)] for r in sets.collect()}
    hashed = sets.select("line_id", F.explode("s").alias("x")).select(
        "line_id", F.shiftright("x", 32).alias("h"), F.pmod("x", F.lit(bins)).alias("bin"))
    binned = hashed.groupBy("line_id").agg(*linededup._least(bins))
    assert {r.line_id: list(r)[1:] for r in binned.collect()} == want
    filled = binned.withColumn("least", F.least(*(f"b{i}" for i in range(bins)))).select("line_id", *linededup._filled(bins))
    for r in filled.collect():
        had = want[r.line_id]
        assert all(v is not None and (h is None and v in had or v == h) for h, v in zip(had, list(r)[1:], strict=True))


def test_lines_at_the_threshold_meet(spark):
    """800 pairs at exactly 80 %, of 18 to 72 shingles a line; in ten bands of three full orders 0.6 would be missed."""
    rng, texts = random.Random(4), []
    for i in range(800):
        e = 2 + i % 7
        base = drawn(rng, 8 * e + 7)
        texts += [base + drawn(rng, e), base + drawn(rng, e)]
    lines = lines_of(spark, texts)
    buckets = lines.select("doc_id", F.col("line_id").alias("id")).join(linededup._buckets(lines), "id")
    per_line = buckets.groupBy("doc_id").count().select("count").distinct().collect()
    assert [r[0] for r in per_line] == [linededup.BANDS]
    pairs = buckets.withColumn("pair", F.expr("doc_id div 2")).groupBy("pair", "bucket").agg(F.countDistinct("doc_id").alias("n"))
    assert pairs.filter("n = 2").select("pair").distinct().count() >= 797


def test_blank_lines_are_no_lines(spark):
    lines = lines_of(spark, ["\n \n\t\r\x0b\x0c \n  Word \n \n", "   ", ""])
    assert [(r.doc_id, r.pos, r.norm) for r in lines.orderBy("doc_id", "pos").collect()] == [(0, 3, "word"), (0, 4, " ")]
