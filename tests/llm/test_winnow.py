"""Winnowing against a direct reading of its definition."""

import hashlib

from holdsift.llm import winnow


def slow_choice(hashes, window):
    n, out = len(hashes), set()
    width = min(window, n)
    for i in range(n - width + 1):
        part = hashes[i: i + width]
        least = min(part)
        out.add(i + max(j for j, h in enumerate(part) if h == least))
    return sorted(out)


def test_choice_matches_the_definition():
    import random

    rng = random.Random(3)
    for n in (0, 1, 2, 5, 70, 71, 72, 200):
        import numpy as np

        h = np.array([rng.randrange(6) for _ in range(n)], np.uint32)
        for window in (1, 2, 3, 7, 64, 71):
            assert winnow.winnow(h, window).tolist() == (slow_choice(h.tolist(), window) if n else [])


def test_shared_passage_is_always_found():
    import random

    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    for _ in range(30):
        passage = word(winnow.GRAM + winnow.WINDOW - 1)
        a, b = winnow.Print(word(rng.randrange(300)) + passage + word(50)), winnow.Print(word(90) + passage)
        assert set(a.hashes.tolist()) & set(b.hashes.tolist())


def check(spark, rows):
    df = spark.createDataFrame(rows, "text string, other int, doc_id long, span string")
    got = sorted(winnow.fingerprints(df).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.fingerprint))
    order = sorted(((r[2] is not None, r[2] or 0, r[0] is not None, r[0] or "") for r in rows))
    want = []
    for i, (has, doc, _, text) in enumerate(order):
        after = order[(i + 1) % len(order)][3]
        new = winnow.edited(text, after)
        a, b, c = winnow.Print(text), winnow.Print(new), winnow.Print(after)
        want.append((doc if has else None, len(text), hashlib.sha256(new.encode()).hexdigest(), str(a), str(b), a.likeness(b), a.likeness(c)))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got)


def test_next_document_nulls_ties_and_clashing_columns(spark):
    text = "Näher betrachtet ist der Satz lang genug, um mehrere Fenster zu füllen, und er endet erst hier. "
    check(spark, [(None, 1, 5, "x"), ("", 1, 3, "x"), ("ab", 1, 9, "x"), (text * 3, 1, 7, "x"), (text * 3, 1, 8, "x"),
                  (text, None, 7, None), ("zz" + text * 40, 2, None, "y"), (text[5:] * 2, 0, 100, "z"), ("é" * 500, 0, -4, "z")])
    check(spark, [(text, 1, 1, "x")])


def test_many_documents_and_none(spark):
    import random

    rng = random.Random(1)
    check(spark, [("".join(rng.choice("abc de") for _ in range(rng.randrange(300))), 0, rng.randrange(10**6), "s") for _ in range(400)])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert winnow.fingerprints(none).collect() == []
