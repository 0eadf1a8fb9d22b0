"""Mixing, near duplicates and components against plain readings of their definitions."""

import hashlib
import math
import random
import re

import duckdb
import pytest

from holdsift.llm import graph, mixing, neardup
from holdsift.llm import textkernel as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reach(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


# --- mixing


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    pool, full = sum(sizes.values()) * 1.5, set()
    while True:
        rest = [s for s in names if s not in full]
        left = pool - sum(2 * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] >= 2 * sizes[s]]
        if not over:
            return {s: 2.0 * sizes[s] if s in full else share[s] for s in names}
        full |= set(over)


def check_mix(spark, rows):
    df = spark.createDataFrame(rows, "source string, n long, text string, doc_id long, size string, key string")
    got = mixing.mix_counts(df).collect()
    sizes = {}
    for s, _, t, _, _, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(WORD.findall(t or ""))
    want = plain_targets(sizes)
    by_source = {}
    for s, _, t, d, _, _ in rows:
        n = len(WORD.findall(t or ""))
        by_source.setdefault(s, []).append((n, d))
    expect = []
    for s, own in by_source.items():
        rate = want[s] / sizes[s] if sizes[s] else 0.0
        offset = int(hashlib.md5(("mix" + ("" if s is None else "=" + s)).encode()).hexdigest()[:8], 16) / 2**32

        def order(x):
            n, d = x
            cls = n if n < 16 else (n.bit_length() - 4) * 8 + (n >> (n.bit_length() - 4))
            return cls, hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:2], n, (d is not None, d or 0)

        for i, (n, d) in enumerate(sorted(own, key=order), 1):
            copies = math.floor(i * rate + offset) - math.floor((i - 1) * rate + offset)
            expect.append((d, n, sizes[s], round(want[s], 6), copies * n))
            assert copies <= 2
    assert sorted(map(repr, expect)) == sorted(repr((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken)) for r in got)
    return got


def test_mix_matches_its_definition(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "a", "a", "a", "b", "Z", "é", None]), 1, " ".join(["w"] * rng.randrange(60)), i, "x", "k") for i in range(400)]
    got = check_mix(spark, rows)
    for size in {r.source_size for r in got}:
        own = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * 60 + 0.02 * own[0].target


def test_mix_edges(spark):
    check_mix(spark, [("a", 1, None, 1, "x", None), ("a", 1, "", 2, "x", None), (None, 1, "one two", 3, "x", None),
                      ("b", 1, "x" * 50_000, None, "x", None), ("b", 1, "t u v", 5, "x", None), ("b", 1, "t u v", 5, "x", None)])
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix_counts(none).collect() == [] and mixing.mix(none).collect() == []
    only_empty = spark.createDataFrame([(1, "", "s")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix_counts(only_empty).collect()] == [(0.0, 0)]


def test_mix_emits_rows_as_often_as_counted(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = {r.doc_id: r.copies for r in mixing.mix_counts(docs).collect()}
    seen = {}
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    for r in out.select("doc_id").collect():
        seen[r.doc_id] = seen.get(r.doc_id, 0) + 1
    assert seen == {d: n for d, n in counts.items() if n}


# --- word kernel


def test_words_and_windows():
    import numpy as np
    import pyarrow as pa

    texts = ["", "a b  c\td", None, " x ", "é a b c d e f g h i j", "one\x0btwo\x1fthree four", "q " * 3000]
    seen = {}
    for first, end, data, offsets in tk.stretches(pa.array(texts), 64):
        words = tk.Words(data, offsets)
        raw = data.tobytes()
        for i in range(end - first):
            own = WORD.findall(texts[first + i] or "")
            at = range(words.first[i], words.first[i + 1])
            assert [raw[words.start[j]: words.end[j]].decode() for j in at] == own
            for j, w in zip(at, own):
                assert seen.setdefault(w, words.hash[j]) == words.hash[j]
        hashes, firsts = words.windows(3)
        assert np.diff(firsts).tolist() == [max(0, len(WORD.findall(t or "")) - 2) for t in texts[first:end]]
        assert len(hashes) == firsts[-1]
    assert len(set(map(int, seen.values()))) == len(seen)


# --- components and near duplicates


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(400 + i, 401 + i) for i in range(40)] + [(999, i) for i in range(500, 600)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.component for r in graph.connected(df).collect()}
    want = reach({x for link in links for x in link}, links)
    lone = {a for a, b in links if a == b} - {x for a, b in links if a != b for x in (a, b)}
    assert got == {k: v for k, v in want.items() if k not in lone}
    assert graph.connected(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_sets(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = WORD.findall(low)
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def check_near(spark, rows):
    df = spark.createDataFrame(rows, "text string, n long, doc_id long, id string, component string")
    got = neardup.near_duplicates(df).collect()
    sets = [(d, plain_sets(t)) for t, _, d, _, _ in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= 85 * len(x | y)]
    least = reach({d for d, _ in sets if d is not None}, links)
    want = sorted(repr((d, len(s), least.get(d), d == least.get(d))) for d, s in sets)
    assert want == sorted(repr((r.doc_id, r.n_shingles, r.component_id, r.kept)) for r in got)


def test_near_duplicates_match_all_pairs(spark):
    rng = random.Random(9)
    vocab = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 5, 40, 150, 400]))]
        for _ in range(rng.choice([1, 2, 9, 25])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            rows.append((rng.choice([" ", "  ", "\n"]).join(own) if rng.random() < 0.5 else " ".join(own).upper(), 1, len(rows), "x", "y"))
    rng.shuffle(rows)
    check_near(spark, rows)


def test_chain_is_one_component(spark):
    """Neighbours in the chain are close enough, its ends are not."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for step in range(8):
        own = list(base)
        for k in range(step):
            own[10 + 20 * k] = f"z{k}"
        rows.append((" ".join(own), 1, 50 - step, "x", "y"))
    check_near(spark, rows)
    assert len({r.component_id for r in neardup.near_duplicates(
        spark.createDataFrame(rows, "text string, n long, doc_id long, id string, component string")).collect()}) == 1


def test_near_duplicate_edges(spark):
    check_near(spark, [(None, 1, 1, "x", "y"), ("", 1, 2, "x", "y"), (" \t", 1, 3, "x", "y"), ("a b", 1, 4, "x", "y"), ("A  b", 1, 5, "x", "y"),
                       ("a b c", 1, 6, None, "y"), ("a b", 1, 4, "x", "y"), ("ab " * 40_000, 1, 8, "x", "y"), ("ab " * 30_000, 1, 9, "x", "y")])
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    null_id = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f")], "doc_id long, text string")
    assert sorted((repr(r.doc_id), r.kept) for r in neardup.near_duplicates(null_id).collect()) == [("7", True), ("None", True)]


@pytest.mark.parametrize("name", ["op2_mix", "op4_near_duplicates"])
def test_queries_match_their_sql(spark, sf, name):
    from holdsift.llm.queries import QUERIES, SQL

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    got = QUERIES[name](spark, sf)
    cols = sorted(got.columns)
    want = con.execute(SQL[name]).df()[cols].astype(object).values.tolist()
    assert sorted(map(repr, got.toPandas()[cols].astype(object).values.tolist())) == sorted(map(repr, want))


def test_rows_that_share_an_id_keep_the_links_of_each(spark):
    rng = random.Random(4)
    words = [f"w{rng.randrange(900)}" for _ in range(400)]
    near, own = list(words), " ".join(f"v{rng.randrange(900)}" for _ in range(400))
    near[200] = "other"
    rows = [(7, " ".join(words)), (7, own), (9, " ".join(near)), (11, own + " and a few more words")]
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(7, 7), (9, 7), (11, 7)}
