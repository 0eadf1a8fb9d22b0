"""Line dedup against the Jaccard similarity over all overlapping shingles."""

import random

from holdsift.llm import linededup

LONG_TOKENS = [
    "https://www.example.org/reports/monthly/2024/portfolio.pdf", "https://www.other-house.in/downloads/annual-statement.xlsx",
    "https://www.example.org/reports/monthly/2024/portfolio.pdg", '{"id":1,"name":"first","value":"something"}',
    '{"id":1,"name":"third","place":"elsewhere"}', "10001,alpha,2024-01-01,17.5,open", "10001,alpha,1999-12-31,88.1,shut",
    "transaction_reference_number=1", "transaction_reference_number=abcdefghijklmnopqrstuvwxyz",
    "fürscheinschach!! die.", "fürscheinschach die andere", "これは単語の間に空白を置かない文章の一行です。もう一つの文です", "x" * 5000 + "y" * 30,
    "x" * 30 + "y" * 5000, "short line of 20 sig", "\U0001f600" * 25, "\U0001f600" * 24 + "\U0001f601",
]


def shingles(norm):
    return {norm[i: i + linededup.SHINGLE] for i in range(max(1, len(norm) - linededup.SHINGLE + 1))}


def dropped(lines):
    """Per document of one line each, whether an earlier line's component has it."""
    sets, root = [shingles(x.strip(" ").lower()) for x in lines], list(range(len(lines)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 100 * len(a & b) >= linededup.PERCENT * len(a | b):
                one, two = sorted((root[i], root[j]))
                root = [one if r == two else r for r in root]
    return [r != i for i, r in enumerate(root)]


def check(spark, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    got = {r.doc_id: r.lines_dropped == 1 for r in linededup.dedup_lines(df).collect()}
    assert [got[i] for i in range(len(lines))] == dropped(lines)
    return [got[i] for i in range(len(lines))]


def test_long_tokens_count_whole(spark):
    rng = random.Random(3)
    near = ["".join(rng.choice("abcdef0123") for _ in range(150)) for _ in range(6)]
    near += [x[:70] + "#" + x[71:] for x in near]
    assert any(check(spark, LONG_TOKENS + near))
    assert not any(check(spark, ["https://www.example.org/a/report-of-may.pdf", "https://www.second.net/zz/other_file.xlsx"]))


def test_one_changed_word_in_a_middling_line(spark):
    """At 111 signs one changed word of four leaves 80 % of the 8-sign shingles, and 73 % of the 12-sign ones."""
    line = "fund house lists every holding with its name and sector, rating, quantity, value and share of the total assets"
    assert check(spark, [line, line.replace("with", "plus")]) == [False, True]
