"""From buckets to components of similar sets, losing no link between sets that share a bucket (native).

Comparing all pairs of a bucket would grow with the square of a group of copies. Instead:

1. Star: a bucket's centre is the member whose buckets hold most, so a group of copies has one centre in all its buckets,
   and it is one of them. Every member is compared to the centre.
2. Rest: two members linked to the centre are in one component anyway, so of a link not yet known one end is not linked
   to the centre. Those members meet all that were compared with the same centre.

Before any two sets are compared, sizes and marks must allow the link. A set's mark has one bit for each of ``16 * 64``
residues of its elements: whether their number is odd. Common elements change a bit of both marks alike, so every bit in
which two marks differ takes an element that is not common, and sets of sizes ``n1`` and ``n2`` whose marks differ in ``d``
bits have at most ``(n1 + n2 - d) / 2`` elements in common. The bound is exact; only elements that are not common can hide
each other, so it leaves hardly more than the pairs that are linked while a mark has more bits than two linked sets have
such elements (at 80 % sets of about 2,000 elements; of far larger ones it rules out no pair). Whole sets are compared
only there.

Similarity is tested on whole element sets: ``100 * intersection >= percent * union``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift.llm.common import cut
from holdsift.llm.graph import connected

#: Longs of a mark.
WORDS = 16
_MARK = [f"m{i}" for i in range(WORDS)]


def marks(sets: DataFrame, items_of: Callable[[Column], Column]) -> DataFrame:
    """(id, part, n, m0 ... ) per set; ``part`` tells sets apart that share an id."""
    place = F.pmod(F.col("item"), F.lit(64 * WORDS))
    bits = (
        sets.select("id", "part", F.explode(items_of(F.col("items"))).alias("item"))
        .select("id", "part", F.shiftright(place, 6).cast("int").alias("word"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .withColumn("bit", F.expr("shiftleft(1L, bit)"))
    )
    # an element changes one long only
    return bits.groupBy("id", "part").agg(
        F.count("*").alias("n"), *(F.expr(f"coalesce(bit_xor(bit) FILTER (WHERE word = {i}), 0L)").alias(m) for i, m in enumerate(_MARK)))


def _reaches(one: str, two: str, percent: int) -> Column:
    """Whether two sets, with their size and mark under prefixes, could be similar enough."""
    n1, n2 = F.col(f"{one}n"), F.col(f"{two}n")
    apart = [F.bit_count(F.col(f"{one}{m}").bitwiseXOR(F.col(f"{two}{m}"))) for m in _MARK]
    # as n1 + n2 - d is even, nothing is lost where it is halved
    most = F.shiftright(n1 + n2 - sum(apart[1:], apart[0]), 1)
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (100 * most >= percent * (n1 + n2 - most))


def _under(table: DataFrame, prefix: str) -> DataFrame:
    return table.select(*(F.col(c).alias(f"{prefix}{c}") for c in table.columns))


def compared(pairs: DataFrame, sets: DataFrame, items_of: Callable[[Column], Column] = lambda items: items) -> DataFrame:
    """``pairs`` (a_id, a_part, a_n, b_id, b_part, b_n) with the number of their ``common`` items."""
    left, right = (_under(sets.select("id", "part", "items"), x) for x in ("a_", "b_"))
    common = F.size(F.array_intersect(items_of(F.col("a_items")), items_of(F.col("b_items")))).cast("long")
    return pairs.join(left, ["a_id", "a_part"]).join(right, ["b_id", "b_part"]).select(
        F.col("a_id").alias("a"), F.col("b_id").alias("b"), "a_n", "b_n", common.alias("common"))


def similar(table: DataFrame, percent: int) -> DataFrame:
    # 100 * common >= percent * union, with ``common`` named once: a filter counts it anew wherever it is named
    close = (100 + percent) * F.col("common") >= percent * (F.col("a_n") + F.col("b_n"))
    return table.filter(close).select("a", "b")


def similar_components(buckets: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int,
                       known: DataFrame | None = None,
                       items_of: Callable[[Column], Column] = lambda items: items) -> DataFrame:
    """(id, component) of the ids that have a similar set in some bucket of theirs.

    ``buckets``: (id, bucket), longs. ``sets_of`` takes (id) of the candidates and gives (id, items) with ``items`` an
    array of distinct longs, or what ``items_of`` makes such an array of where it is used: sets that are larger than
    their texts are stored and shuffled as texts. An id may have several sets; its links are those of all of them.
    ``known``: links (a, b) that hold anyway.
    """
    shared = cut(
        buckets.groupBy("bucket").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count("*").alias("k"))
        .filter("lo <> hi").select("bucket", "k")
    )
    members = cut(buckets.join(shared, "bucket").select("id", "bucket", "k").distinct())
    ids = members.groupBy("id").agg(F.sum("k").alias("weight"))
    sets = cut(sets_of(ids.select("id")).select("id", F.xxhash64("items").alias("part"), "items").dropDuplicates(["id", "part"]))
    marked = cut(marks(sets, items_of))
    centre = F.max_by("id", F.struct("weight", (-F.col("id")).alias("first")))
    centres = cut(members.join(cut(ids), "id").groupBy("bucket").agg(centre.alias("centre")))
    star = cut(members.join(centres, "bucket").filter("id <> centre").select("id", "centre").distinct())
    met = (
        star.join(_under(marked, "a_"), F.col("id") == F.col("a_id"))
        .join(_under(marked, "b_"), F.col("centre") == F.col("b_id")).filter(_reaches("a_", "b_", percent))
    )
    ends = ["a_id", "a_part", "a_n", "b_id", "b_part", "b_n"]
    links = cut(similar(compared(met.select(*ends), sets, items_of), percent).distinct())
    linked = links.select(F.col("a").alias("id"), F.col("b").alias("centre"), F.lit(True).alias("linked"))
    placed = cut(
        star.join(linked, ["id", "centre"], "left").select("id", "centre", F.coalesce("linked", F.lit(False)).alias("linked"))
    )
    whole = placed.join(marked, "id")
    outside = _under(whole.filter("not linked"), "a_").withColumnRenamed("a_centre", "centre").drop("a_linked")
    inside = _under(whole, "b_").withColumnRenamed("b_centre", "centre")
    rest = (
        outside.join(inside, "centre")
        .filter((F.col("a_id") != F.col("b_id")) & (F.col("b_linked") | (F.col("a_id") < F.col("b_id")))
                & _reaches("a_", "b_", percent))
        .select(*ends).distinct()
    )
    # counted once and stored, so that no filter counts the common items again
    more = similar(cut(compared(rest, sets, items_of)), percent)
    links = links.unionByName(known) if known is not None else links
    return connected(links.unionByName(more))
