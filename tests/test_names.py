"""Scores of short names as wholes: coded once for all candidates, equal to plain LCS ratios."""

import random

import numpy as np

from holdsift.functions import fuzzy as Z


def test_names_score_like_plain_ratios(monkeypatch):
    rng = random.Random(5)
    cands = [c for c, _ in Z.candidate_names()] + ["", "x", "abc " * 30]
    texts = ["", "\0", "x" * 300, "é ü 日本", *cands]
    texts += ["".join(rng.choice("abil sc\0ué") for _ in range(rng.randrange(70))) for _ in range(40)]
    texts += [c.replace("a", "", 1) + " fund" for c in cands]
    toks, cands = [Z.sort_tokens(t) for t in texts], [Z.sort_tokens(c) for c in cands]
    coded = []
    code = Z.codepoints
    monkeypatch.setattr(Z, "codepoints", lambda t: coded.append(t) or code(t))
    for cut in (-1.0, 0.0, 60.0, 100.0):
        names = Z.Names(toks, cands, cut)
        for k, cand in enumerate(cands):
            got = names.scores(k, np.full(len(toks), cut))
            for t, score in zip(toks, got):
                plain = Z.indel_ratio(cand, t)
                assert score == plain or (score == 0 and plain <= cut)
        assert coded[:len(cands)] == cands  # candidates are coded, one by one; texts are not, for each of them, again
        coded.clear()
    assert Z.Names([], cands, 0.0).scores(0, np.zeros(0)).size == 0
    assert Z.Names(["a"], [], 0.0).lens.tolist() == [1]
    assert Z.token_sort_scores(["fund sbi", "other"], "SBI fund".lower(), np.zeros(2)).tolist()[0] == 100.0
