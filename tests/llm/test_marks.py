"""The bound by marks that decides which sets are compared: it loses no similar pair, and holds for large sets too."""

import random

from holdsift.llm import links


def passed(spark, pairs, percent=80):
    rows = [(2 * i + k, 0, list(s)) for i, pair in enumerate(pairs) for k, s in enumerate(pair)]
    marked = links.marks(spark.createDataFrame(rows, "id long, part long, items array<long>"), lambda items: items)
    one, two = links._under(marked, "a_"), links._under(marked, "b_")
    met = one.join(two, (one.a_id % 2 == 0) & (two.b_id == one.a_id + 1)).filter(links._reaches("a_", "b_", percent))
    return {r.a_id // 2 for r in met.select("a_id").collect()}


def pair(rng, common, left, right):
    drawn = [rng.getrandbits(64) - (1 << 63) for _ in range(common + left + right)]
    return drawn[:common + left], drawn[:common] + drawn[common + left:]


def test_similar_pairs_pass_and_large_sets_far_apart_do_not(spark):
    rng = random.Random(5)
    # exactly at 80 %, and random ones of any likeness
    pairs = [pair(rng, 4 * k, k // 2, k - k // 2) for k in (1, 2, 5, 40, 300, 1500)]
    pairs += [pair(rng, rng.randrange(1, 60), rng.randrange(12), rng.randrange(12)) for _ in range(200)]
    alike = {i for i, (a, b) in enumerate(pairs) if 100 * len({*a} & {*b}) >= 80 * len({*a} | {*b})}
    assert alike >= set(range(6)) and alike <= passed(spark, pairs)
    # half alike: sets of 500 and 1,500 elements are told apart though a mark has 1,024 bits
    assert passed(spark, [pair(rng, n * 2 // 3, n // 3, n // 3) for n in (500, 1500) for _ in range(5)]) == set()
