"""Steps that must not move or hold more than their input asks for."""

import random

import numpy as np
from pyspark.sql import functions as F

from holdsift.functions import cells as C
from holdsift.functions import fuzzy as Z
from holdsift.functions import periods as P
from holdsift.operators import grid as G
from holdsift.operators import warehouse as W
from holdsift.plans import catalog
from holdsift.plans import inputs as I
from holdsift.plans import queries_tables as Q

AS_OF = "2026-07-01 00:00:00"
ROWS = ", ".join([W.KEY, *W.IDENTITY, *W.MEASURES])


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> list[str]:
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def holdings(spark, rows):
    """(key, order, document) rows with the other published columns filled in."""
    df = spark.createDataFrame(rows, f"{W.KEY} string, ord int, document_id string")
    filled = {c: F.lit(2026 if c.startswith("period") else "x") for c in W.IDENTITY if c != "document_id"}
    return df.withColumns({**filled, **{c: F.col("ord").cast("double") for c in W.MEASURES[:3]}, "rating": F.lit("AAA")})


def history_twice(spark, hot_rows):
    one = holdings(spark, [("a", 1, "d1"), ("a", 7, "d2"), ("b", None, "d3"), ("b", 4, "d4"), (None, 5, "d5")])
    two = holdings(spark, [("b", 9, "d6"), ("c", 1, "d7"), ("c", 1, "d7"), ("c", None, "d8"), ("b", 8, "d9")])
    bucket = F.floor(F.col("ord") / 5)
    h = W.publish_history(W.empty_published(spark), one, ["ord"], bucket, "2026-06-01", hot_rows)
    return W.publish_history(h, two, ["ord"], bucket, AS_OF, hot_rows)


def test_history_is_the_same_by_key_and_by_bucket(spark):
    by_key, by_bucket = (
        sorted(map(str, history_twice(spark, hot).collect())) for hot in (1000, 0))
    assert by_key == by_bucket
    got = {(r[W.KEY], r["document_id"], r["version"], r["is_current"], r["updated_at"].month)
           for r in history_twice(spark, 2).collect()}
    assert got == {
        ("a", "d1", 1, False, 6), ("a", "d2", 2, True, 6), ("b", "d3", 1, False, 6), ("b", "d4", 2, False, 7),
        ("b", "d9", 3, False, 7), ("b", "d6", 4, True, 7), ("c", "d8", 1, False, 7), ("c", "d7", 2, False, 7), ("c", "d7", 3, True, 7),
    }


def test_history_moves_its_rows_once(spark):
    one = holdings(spark, [("a", 1, "d1"), ("b", 2, "d2")])
    h = W.publish_history(W.empty_published(spark), one, ["ord"], F.floor(F.col("ord") / 5), AS_OF)
    assert executed(h).count("Exchange hashpartitioning") == 1


def test_words_are_counted_before_they_meet_the_lists(spark, sf):
    for name in ("category_words_seen", "month_words_seen", "scheme_names_seen"):
        plan = optimized(catalog.QUERIES[name](spark, sf))
        join = next(i for i, line in enumerate(plan) if "Join Inner" in line)
        assert any("Aggregate" in line for line in plan[join:]), name


CELLS = [
    ["Sr", "ISIN", "Instrument", "% to NAV"], ["I-S-I-N", "Q.t.y", "q'ty", ""], ["INE1", "Instrument 5", "7", None],
    ["is\nin", "rat\ning"], ["is\nin", "isin", "qty"], ["ＩＳＩＮ", "ısın", "Qüty", "qty"], ["Ksin", "is\u0000in", "ty\u0000pe"],
    ["name", "Name", "name of it"], ["isin isin", "x"], ["isin", "isin"], ["unnamed isin", "unnamed type"], [], None, [None, None],
    ["ISI", "N", "qt", "y"], ["rating\n", "\nsector"], ["İsin", "unİts"],
]


def test_the_cheap_header_test_drops_no_header(spark):
    rows = spark.createDataFrame(list(enumerate(CELLS)), "i int, cells array<string>")
    custom = [("a", ["x y", "z"]), ("b", ["q(r"])]
    for dialect, headers in (("excel", None), ("pdf", None), ("pdf", custom)):
        mapped = F.size(F.array_compact(F.transform("cells", lambda c: C.header_field(c, dialect, headers))))
        for least in (0, 1, 2):
            likely = C.may_be_header(C.row_text(F.col("cells")), dialect, least, headers)
            got = rows.select("i", (mapped >= least).alias("full"), likely.alias("likely")).collect()
            assert [r for r in got if r["full"] and not r["likely"]] == []
    likely = C.may_be_header(C.row_text(F.col("cells")), "excel", 2)
    assert not rows.filter("i = 2").select(likely).first()[0]  # a holding's own row is not mapped cell by cell


def test_header_cells_are_normalised_alike_in_and_beyond_ascii(spark):
    rows = spark.createDataFrame([(c,) for row in CELLS for c in row or []], "c string")
    plain = F.trim(F.regexp_replace(F.lower("c"), r"[^a-z0-9\s%.]", ""))
    assert rows.filter(~C.normalize_header(F.col("c")).eqNullSafe(plain)).collect() == []


def test_a_grid_reads_its_holdings_once_and_maps_names_once(spark, sf):
    head = G.header_rows(Q.grid(spark, sf))
    plan = head._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    assert plan.count("Unnamed: ") == 1


def test_lines_meet_their_order_as_they_are_stored(spark, sf):
    plan = executed(I.derive(spark, sf, I.HOLDINGS))
    assert plan.count("Exchange ") == 1
    assert "Instrument " not in plan[plan.index("Exchange "):]


def test_windows_are_ruled_out_side_by_side_without_a_loss():
    pick = random.Random(5)
    for signs in ("ab", "abc fund", "abcdefghilmnorstu "):
        texts = ["".join(pick.choices(signs, k=pick.randint(0, 90))) for _ in range(12)]
        for n in (1, 3, 4, 5, 17, 63):
            name = "".join(pick.choices(signs, k=n))
            pat = Z.Pattern(name)
            block = Z.Block(texts, pat.signs)
            for cut in (0.0, 50.0, 80.0):
                got = block.best(pat, np.full(len(texts), cut))
                for text, score in zip(texts, got):
                    plain = max((Z.indel_ratio(name, text[max(i, 0): i + n]) for i in range(1 - n, len(text))), default=0.0)
                    assert abs(score - (plain if plain > cut else 0.0)) < 1e-9


def test_few_windows_of_a_long_text_are_looked_at():
    text = "the quarterly letter to holders says that rates moved and that nothing else did. " * 300
    pat = Z.Pattern("sbi magnum gilt xz fund")
    block = Z.Block([text], pat.signs)
    need = np.full(64, 20, dtype=np.uint8)
    slots = list(zip((np.searchsorted(block.alphabet, pat.signs) + 1).tolist(), pat.counts.tolist()))
    assert block._near(slots, pat.m, need).size < len(text) / 20


def test_month_words_are_ranked_and_years_read_without_failing_casts(spark):
    words = [*P._WORDS, "ja", "", None, "y", "septem", "x"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(
        P._rank(F.col("w")).alias("rank"), F.array_position(F.lit(P._WORDS), F.col("w")).cast("int").alias("plain")).collect()
    assert [r["rank"] for r in got] == [r["plain"] for r in got]
    years = spark.createDataFrame([("",), ("26",), ("2026",), ("100",), ("0",), ("x",), (None,)], "y string")
    assert [r[0] for r in years.select(P.full_year(F.col("y"))).collect()] == [None, 2026, 2026, 100, 2000, None, None]
    assert "array_position" not in str(P._rank(F.col("w")))
