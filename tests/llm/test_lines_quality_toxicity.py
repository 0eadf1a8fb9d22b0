"""Line dedup, quality and toxicity against plain readings, and their edge cases."""

import random
import re
import zlib

from pyspark.sql import functions as F

from holdsift.llm import linededup, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- lines


def shingles(norm):
    if len(norm) < linededup.MIN_CHARS:
        return {norm}
    return {norm[i: i + linededup.SHINGLE] for i in range(len(norm) - linededup.SHINGLE + 1)}


def plain_dedup(rows):
    lines = []
    for doc, text in rows:
        for pos, line in enumerate((text or "").split("\n") if doc is not None and text is not None else []):
            norm = line.lower().strip(" ")
            if WORD.search(norm):
                lines.append((doc, pos, norm))
    norms = sorted({n for _, _, n in lines})
    parent = {n: n for n in norms}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    sets = {n: shingles(n) for n in norms}
    for i, a in enumerate(norms):
        for b in norms[:i]:
            if 100 * len(sets[a] & sets[b]) >= linededup.PERCENT * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    first = {}
    for doc, pos, n in sorted(lines):
        first.setdefault(root(n), (doc, pos))
    gone = {(doc, pos) for doc, pos, n in lines if first[root(n)] != (doc, pos)}
    return {doc: "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone) for doc, text in rows if text is not None}


def check_lines(spark, rows):
    df = spark.createDataFrame([(t, d, "p", 1) for d, t in rows], "text string, doc_id long, pos string, line_id int")
    got = linededup.dedup_lines(df)
    assert got.columns == [*df.columns, "lines_before", "lines_dropped"]
    want = plain_dedup(rows)
    found = got.collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.text == want.get(r.doc_id) if r.doc_id is not None else True
        if r.text is not None and r.doc_id is not None:
            before = dict(rows)[r.doc_id]
            assert r.lines_before == len(before.split("\n"))


def test_lines_match_all_pairs(spark):
    rng = random.Random(8)
    vocab = ["".join(rng.choice("abcdefé") for _ in range(rng.randint(1, 8))) for _ in range(200)]
    bases = [[rng.choice(vocab) for _ in range(rng.choice([4, 12, 40]))] for _ in range(12)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(5)):
            own = list(rng.choice(bases)) if rng.random() < 0.7 else [rng.choice(vocab) for _ in range(20)]
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            lines.append(rng.choice(["", "  "]) + " ".join(own) + rng.choice(["", " "]))
        rows.append((d * 3, "\n".join(lines)))
    check_lines(spark, rows)


def test_line_edges(spark):
    long = "this line is long enough to take part"
    check_lines(spark, [(5, None), (1, ""), (2, "\n\n"), (3, f"{long}\nshort\n{long}"), (4, f"{long.upper()}  \nshort\nother"), (6, " Short \n\t\n \nshorter\n\t"), (9, "x" * 60_000), (10, "y " * 30_000)])
    lone = spark.createDataFrame([(None, long), (None, long)], "doc_id long, text string")
    assert [r.text for r in linededup.dedup_lines(lone).collect()] == [long, long]
    assert linededup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    same = spark.createDataFrame([(1, long), (1, long), (2, long)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in linededup.dedup_lines(same).collect()) == [(1, long), (1, long), (2, "")]


def test_unspaced_scripts_have_a_shingle_at_every_sign(spark):
    line = "これは単語の間に空白を置かない文章の一行です"
    rows = [(1, line), (2, line.replace("一行", "二行"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    n = linededup.lines_of(df).select(F.size(linededup._shingles(F.col("norm"))).alias("n")).first().n
    assert n == len(line) - linededup.SHINGLE + 1


# --- quality


def plain_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i: i + 8]) for i in range(len(words) - 7)]
    many = {w for w in windows if windows.count(w) > 1}
    covered = {i + k for i, w in enumerate(windows) if w in many for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), len(lines))


TEXTS = [None, "", " \n\t", "one", "a b c d e f g h " * 4, "é ü\né ü\n é ü\n\n", "x#|y <b> & *\n", "same line here\nsame line here\n" * 3,
         "w " * 5000, "\x1f z", "end\n", "p q r s t u v w\np q r s t u v w x"]


def test_counts_match_plain_reading(spark):
    rng = random.Random(6)
    texts = TEXTS + ["".join(rng.choice(["a ", "b ", "ab ", "\n", "c\t", "#", "é "]) for _ in range(rng.randrange(200))) for _ in range(80)]
    df = spark.createDataFrame([(t, i, "n") for i, t in enumerate(texts)], "text string, doc_id long, n_words string")
    for r in quality.measure(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.n_lines) == plain_counts(texts[r.doc_id]), texts[r.doc_id]


def test_em_weighs_rules():
    rng = random.Random(1)
    patterns = {}
    for _ in range(20_000):
        bad = rng.random() < 0.2
        chance = (0.9, 0.6, 0.05) if bad else (0.02, 0.02, 0.05)  # the third rule says nothing
        p = "".join("b" if rng.random() < c else "g" for c in chance)
        patterns[p] = patterns.get(p, 0) + 1
    post = quality.fit(patterns, quality.RULES[:3])
    assert post["ggg"] > 0.95 and post["bbg"] < 0.05 and post["ggb"] > 0.9 and post["bgg"] < 0.5
    assert quality.fit({}) == {}


def test_quality_edges_and_labels(spark, sf):
    none = quality.quality(spark.createDataFrame([], "doc_id long, text string"))
    assert none.collect() == []
    got = quality.quality(spark.createDataFrame([(t, None) for t in TEXTS], "text string, doc_id long")).collect()
    assert len(got) == len(TEXTS) and all(r.base_failed and not r.kept for r in got if r.n_words < 20)
    big = sf.replace("sf0.001", "sf0.01")
    judged = quality.op9_quality(spark, big).join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").filter("not base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in judged) >= 0.97 * len(judged)


# --- toxicity


def corpus(n, seed):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(150)]
    foul = ["grunzel", "flarkhead", "smurdig"]
    docs, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(20, 200))]
        for _ in range(3 if toxic else 0):
            words[rng.randrange(len(words))] = rng.choice(foul) + rng.choice(["", "s", "!", "ER"])
        docs.append((i, " ".join(words), "score"))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_no_peeking(spark):
    docs, labels = corpus(600, 3)
    d = spark.createDataFrame(docs, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in toxicity.toxicity(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sorted(i for i, r in got.items() if r.held_out) == held
    assert sum(got[i].predicted == labels[i][1] for i in held) >= 0.97 * len(held)
    flipped = [(i, 1 - y if i in set(held) else y) for i, y in labels]
    again = {r.doc_id: r.score for r in toxicity.toxicity(d, spark.createDataFrame(flipped, "doc_id long, toxic int")).collect()}
    assert again == {i: r.score for i, r in got.items()}


def test_toxicity_edges(spark):
    docs, labels = corpus(200, 5)
    d = spark.createDataFrame([*docs, (None, "x", "s"), (900, None, "s"), (901, "", "s"), (902, "Ünï " * 20_000, "s"), (1, docs[1][1], "s")],
                              "doc_id long, text string, score string")
    found = toxicity.toxicity(d, spark.createDataFrame([*labels, (None, 1), (1, None), (2, 0)], "doc_id long, toxic int")).collect()
    assert len(found) == 205 and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [True]
    bare = toxicity.toxicity(d, spark.createDataFrame([], "doc_id long, toxic int")).collect()
    assert {r.score for r in bare} == {0.5}
    left = toxicity.without_toxic(d, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert left.columns == d.columns and 0 < left.count() < 205
