"""Phrase collocations against a plain count of everything."""

import random
import re
from collections import Counter, defaultdict

import pytest

from holdsift.llm import phrases

SCHEMA = "text string, lang string, doc_id long, n long, hash string, word string, score int"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    counts = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(FOLD)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 6):
                counts[lang if lang is not None else "und"].update(tuple(w[i: i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        wanted = {g: c for g, c in f.items() if len(g) > 1 and c >= least}
        gone = {g[i:j] for g, c in wanted.items() for i in range(len(g)) for j in range(i + 2, len(g) + 1)
                if j - i < len(g) and c >= f[g[i:j]]}
        scored = []
        for g, a in wanted.items():
            score, k = min((1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            if g not in gone:
                scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]], n))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right, n) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def texts(seed, n, langs):
    rng = random.Random(seed)
    vocab = ["the", "of", "A", "é", "日本", "x1"] + [f"w{i}" for i in range(60)]
    weight = [60, 40, 30, 20, 10, 10] + [1 + 40 // (i + 1) for i in range(60)]
    fixed = [" ".join(rng.choices(vocab, weight, k=rng.randrange(2, 9))) for _ in range(25)]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(8)):
            part = rng.choice(fixed) if rng.random() < 0.5 else " ".join(rng.choices(vocab, weight, k=rng.randrange(1, 12)))
            parts.append(part + rng.choice([" ", ". ", ",", "\n", "\x0b", "\t", "!?"]))
        rows.append(("".join(parts), rng.choice(langs)))
    return rows + [(None, "en"), ("", None), ("  \t .,", "en"), ("aa " * 400, "rep"), ("the THE The", None)]


@pytest.mark.parametrize("least,top,probe,langs", [
    (3, 2000, 8, ["en", "fr", None]), (3, 15, 1, ["en"]), (5, 40, 2, ["en", "fr", "en"]), (2, 7, 3, ["en"]), (10, 1, 1, ["en", "und", None])])
def test_equals_a_plain_count(spark, least, top, probe, langs):
    rows = texts(least * top, 220, langs)
    df = spark.createDataFrame([(t, g, 1, 2, "h", "w", 3) for t, g in rows], SCHEMA).repartition(6)
    got = phrases.collocations(df, least=least, top=top, probe=probe)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(rows, least, top)


def test_the_bound_spares_common_words(spark, monkeypatch):
    """With a low top the common words are never expanded, and the result is the same."""
    rows = texts(1, 300, ["en"]) + [(f"rare{i} rarer{i}", "en") for i in range(5)] * 4
    df = spark.createDataFrame([(t, g, 1, 2, "h", "w", 3) for t, g in rows], SCHEMA)
    sizes, build = [], phrases.bitmap
    monkeypatch.setattr(phrases, "bitmap", lambda h: (sizes.append(h.count()), build(h))[1])
    got = phrases.collocations(df, least=3, top=3, probe=2)
    assert sorted(map(tuple, got.collect())) == plain(rows, 3, 3)
    assert 0 < sizes[1] < sizes[0] and sum(sizes[1::2]) < sizes[0]  # frequent words; then words and pairs of each round


def test_combining_rows_keeps_every_key(monkeypatch):
    """Equal mixed hashes do not merge different phrases, and gathering in parts loses nothing."""
    import numpy as np

    monkeypatch.setattr(phrases, "GATHERED", 5)
    monkeypatch.setattr(phrases, "_mixed", lambda cols: np.zeros(len(cols[0]), np.uint64))
    g = phrases._Gather(1, ["k", "n", "x_lo", "x_hi"])
    out = []
    for i in range(40):
        k = np.array([i % 3, 7], np.int64)
        out += g.add([k, np.ones(2, np.int64), k + i, k + i])
    out += g.rest()
    total, low, high = Counter(), {}, {}
    for b in out:
        for k, n, lo, hi in zip(*(c.to_pylist() for c in b.columns)):
            total[k] += n
            low[k], high[k] = min(low.get(k, lo), lo), max(high.get(k, hi), hi)
    assert total == {0: 14, 1: 13, 2: 13, 7: 40} and low[7] == 7 and high[7] == 46


def test_words_with_one_hash_start_anew(spark, monkeypatch):
    seeds, salt = [], phrases.count_words

    def counted(texts_, least, seed):
        seeds.append(seed)
        out = salt(texts_, least, seed)
        return out.withColumn("same", phrases.F.lit(2)) if seed == 0 else out

    monkeypatch.setattr(phrases, "count_words", counted)
    df = spark.createDataFrame([("a b a b", None)] * 3, "text string, lang string")
    assert [r.phrase for r in phrases.collocations(df, least=2).orderBy("rank").collect()] and seeds == [0, 1]


def test_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
