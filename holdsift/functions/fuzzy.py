"""Fuzzy scheme lookup: normalised LCS scores over Arrow batches.

Spark partitions the rows and ships each text once; a task scores it against the
whole candidate list with vectorised bit-parallel LCS.  The candidate list is
configuration (names and aliases), travels with the function and needs no join,
so there is neither a shuffle nor a texts x candidates row explosion.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdsift.functions.text import settle
from holdsift.rules import SCHEME_MASTER, Scheme

MATCH = T.StructType([
    T.StructField("scheme_name", T.StringType()),
    T.StructField("scheme_category", T.StringType()),
    T.StructField("score", T.DoubleType()),
])
SHEET_MATCH = T.StructType([
    T.StructField("scheme_name", T.StringType()),
    T.StructField("scheme_category", T.StringType()),
    T.StructField("hits", T.IntegerType()),
])

_WORD = 63
_CHUNK = 1 << 16
_BLOCK = 1 << 18
_STEP = 4


def candidate_names(master: Sequence[Scheme] = SCHEME_MASTER) -> list[tuple[str, int]]:
    """(lower-cased candidate, scheme position) in master order: name first, then aliases."""
    out = []
    for pos, s in enumerate(master):
        out.append((s.scheme_name.lower(), pos))
        out.extend((a.lower(), pos) for a in s.aliases)
    return out


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _bit_masks(pattern: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, c in enumerate(pattern.tolist()):
        masks[c] = masks.get(c, 0) | (1 << i)
    return masks


def _step(s: np.ndarray, m: np.ndarray) -> np.ndarray:
    u = s & m
    return (s + u) | (s - u)


def lcs_length(a: str, b: str) -> int:
    """LCS of two strings with unbounded integers; the path for patterns over 63 signs."""
    masks = _bit_masks(codepoints(a))
    full = (1 << len(a)) - 1
    s = full
    for c in codepoints(b).tolist():
        u = s & masks.get(c, 0)
        s = ((s + u) | (s - u)) & full
    return len(a) - bin(s).count("1")


def indel_ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 200.0 * lcs_length(a, b) / total


def sort_tokens(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sort_scores(names: list[str], candidate: str, cut: np.ndarray) -> np.ndarray:
    """Score of each name against one candidate; 0 where a bound rules out more than ``cut``."""
    cand = sort_tokens(candidate)
    return Names([sort_tokens(n) for n in names], [cand], float(np.min(cut, initial=np.inf))).scores(0, cut)


class Names:
    """Short texts, coded once, to be scored as wholes against each of some candidates."""

    def __init__(self, toks: list[str], cands: list[str], cut: float):
        """``cut``: the least that will be asked for; texts too long to beat it with any candidate are not coded."""
        self.toks, self.cands = toks, cands
        self.lens = np.array([len(t) for t in toks], dtype=np.int64)
        self.patterns = [Pattern(c) for c in cands]
        signs = [p.signs for p in self.patterns if 0 < p.m <= _WORD]
        # a text's blanks behind its end are signs 0, which match nothing
        self.alphabet = np.setdiff1d(np.concatenate(signs), 0) if signs else np.empty(0, np.uint32)
        longest = max((p.m for p in self.patterns if p.m <= _WORD), default=0)
        reach = (self.lens <= longest) | (self._most(longest) > cut)
        coded = np.flatnonzero((self.lens > 0) & reach) if self.alphabet.size else np.empty(0, np.int64)
        self.row = np.full(len(toks), -1)
        self.row[coded] = np.arange(coded.size)
        width = int(self.lens[coded].max(initial=0))
        grid = np.frombuffer("".join(toks[i].ljust(width, "\0") for i in coded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        grid = grid.reshape(coded.size, width)
        slot = np.searchsorted(self.alphabet, grid)
        slot[slot == self.alphabet.size] = 0
        # position in the alphabet + 1, 0 for signs that no candidate has; a column per text
        code = np.where(self.alphabet[slot] == grid, slot + 1, 0) if coded.size else slot
        self.code = np.ascontiguousarray(code.T.astype(np.uint8 if self.alphabet.size < 255 else np.uint32))
        self.counts = np.array([(code == k + 1).sum(axis=1) for k in range(self.alphabet.size)], dtype=np.int32)

    def _most(self, m: int) -> np.ndarray:
        """The highest score that lengths allow."""
        total = self.lens + m
        return np.where(total > 0, 200.0 * np.minimum(self.lens, m) / np.maximum(total, 1), 100.0)

    def scores(self, k: int, cut: np.ndarray) -> np.ndarray:
        """Score of each text against candidate ``k``; 0 where lengths or shared signs rule out more than ``cut``."""
        pat, out = self.patterns[k], np.zeros(len(self.toks))
        m, total = pat.m, self.lens + pat.m
        out[total == 0] = 100.0
        live = np.flatnonzero((self._most(m) > cut) & (self.lens > 0) & (m > 0))
        if live.size == 0:
            return out
        if m > _WORD:
            for i in live:
                out[i] = 200.0 * lcs_length(self.cands[k], self.toks[i]) / total[i]
            return out
        known = pat.signs != 0
        slot = np.searchsorted(self.alphabet, pat.signs[known])
        # signs shared, in any order, are at least those of the longest common subsequence
        row = self.row[live]
        shared = np.zeros(live.size, dtype=np.int64)
        for j, times in zip(slot.tolist(), pat.counts[known].tolist()):
            shared += np.minimum(self.counts[j][row], times)
        live = live[200.0 * shared / total[live] > np.broadcast_to(cut, out.shape)[live]]
        if live.size == 0:
            return out
        row, full = self.row[live], np.uint64((1 << m) - 1)
        bits = np.zeros(self.alphabet.size + 1, dtype=np.uint64)
        bits[slot + 1] = pat.bits[known]
        s = np.full(live.size, full, dtype=np.uint64)
        for j in range(int(self.lens[live].max())):
            s = _step(s, bits[self.code[j][row]])
        lcs = m - np.bitwise_count(s & full).astype(np.int64)
        out[live] = 200.0 * lcs / total[live]
        return out


class Pattern:
    """A short text to look for: its signs, their match bits and counts."""

    __slots__ = ("text", "m", "signs", "bits", "counts")

    def __init__(self, text: str):
        cp = codepoints(text)
        self.text, self.m = text, len(cp)
        masks = _bit_masks(cp)
        self.signs, self.counts = np.unique(cp, return_counts=True)
        self.bits = np.array([masks[c] & ((1 << 64) - 1) for c in self.signs.tolist()], dtype=np.uint64)


class Block:
    """Many texts laid end to end with gaps wider than any pattern, scored together.

    No window touches two texts, so one vectorised pass serves all of them and the
    windows at a text's edges are ordinary windows of the block.
    """

    def __init__(self, texts: list[str], alphabet: np.ndarray, starts=None, ends=None):
        """``starts``/``ends`` say whether a text begins/ends for real or is a piece cut from a longer one."""
        gap = np.full(_WORD, 0xFFFFFFFF, dtype=np.uint32)
        parts, begin, at = [gap], [], _WORD
        for t in texts:
            cp = codepoints(t)
            parts += [cp, gap]
            begin.append(at)
            at += len(cp) + _WORD
        self.cp = np.concatenate(parts)
        self.begin = np.array(begin, dtype=np.int64)
        self.size = np.array([len(t) for t in texts], dtype=np.int64)
        self.texts = len(texts)
        self.starts = None if starts is None or all(starts) else np.array(starts)
        self.ends = None if ends is None or all(ends) else np.array(ends)
        # position in the alphabet + 1, 0 for signs no pattern has
        self.alphabet = alphabet
        slot = np.searchsorted(alphabet, self.cp)
        slot[slot == alphabet.size] = 0
        self.code = np.where(alphabet[slot] == self.cp, slot + 1, 0).astype(
            np.uint8 if alphabet.size < 255 else np.uint32
        )
        self._runs: dict[int, np.ndarray] = {}
        self._coarse_runs: dict[int, np.ndarray] = {}
        self._inside = self._run(self.cp != 0xFFFFFFFF)

    @staticmethod
    def _run(flags: np.ndarray) -> np.ndarray:
        # uint8 wrap-around is harmless: windows are at most 63 long, differences stay exact
        out = np.zeros(flags.size + 1, dtype=np.uint8)
        np.cumsum(flags, dtype=np.uint8, out=out[1:])
        return out

    def running(self, code: int) -> np.ndarray:
        got = self._runs.get(code)
        if got is None:
            got = self._runs[code] = self._run(self.code == code)
        return got

    def _coarse(self, code: int) -> np.ndarray:
        """Every ``_STEP``-th entry of a running count."""
        got = self._coarse_runs.get(code)
        if got is None:
            run = self._inside if code < 0 else self.running(code)
            got = self._coarse_runs[code] = np.ascontiguousarray(run[::_STEP])
        return got

    def _near(self, pairs: list[tuple[int, int]], m: int, need: np.ndarray) -> np.ndarray:
        """Starts of all windows that may reach ``need``, and some more.

        The ``_STEP`` windows that start side by side lie in one stretch, which shares at least the signs that each of
        them shares; a stretch that has too few rules all of them out.
        """
        starts = self.cp.size - m + 1
        wide = -(-(m + _STEP - 1) // _STEP)
        groups = max((self.cp.size // _STEP + 1) - wide, 0)
        near = np.zeros(-(-starts // _STEP), dtype=bool)
        near[groups:] = True  # too close to the end for a whole stretch
        bound = np.zeros(groups, dtype=np.uint8)
        for code, times in pairs:
            run = self._coarse(code)
            bound += np.minimum(run[wide: wide + groups] - run[:groups], np.uint8(times))
        run = self._coarse(-1)
        most = (run[wide: wide + groups] - run[:groups]).astype(np.int16)
        # a window has at least what is inside the stretch less the signs that it leaves out
        near[:groups] = bound >= need[np.clip(most - (wide * _STEP - m), 0, _WORD)]
        at = (np.flatnonzero(near)[:, None] * _STEP + np.arange(_STEP)).ravel()
        return at[at < starts]

    def best(self, pat: Pattern, cut: np.ndarray) -> np.ndarray:
        """Per text: best ratio over all windows of the pattern's length, 0 if none beats its ``cut``.

        A bag-of-signs bound (shared signs >= LCS) drops windows that cannot beat the
        cut before any LCS is computed; it never drops one that could.
        """
        m = pat.m
        slot = np.searchsorted(self.alphabet, pat.signs) + 1
        pairs = list(zip(slot.tolist(), pat.counts.tolist()))
        low = float(cut.min())
        need = np.ceil(low * (m + np.arange(_WORD + 1)) / 200.0 - 1e-9).clip(1, 255).astype(np.uint8)
        out = np.zeros(self.texts)
        live = self._near(pairs, m, need)
        if live.size == 0:
            return out
        bound = np.zeros(live.size, dtype=np.uint8)
        for code, times in pairs:
            run = self.running(code)
            bound += np.minimum(run[live + m] - run[live], np.uint8(times))
        size = self._inside[live + m] - self._inside[live]
        kept = bound >= need[size]
        live, bound, size = live[kept], bound[kept], size[kept]
        if live.size == 0:
            return out
        owner = np.searchsorted(self.begin, live + m - 1, side="right") - 1
        total = m + size.astype(np.int64)
        keep = 200.0 * bound / total > cut[owner]
        if self.starts is not None:
            keep &= self.starts[owner] | (live >= self.begin[owner])
        if self.ends is not None:
            keep &= self.ends[owner] | (live + m <= self.begin[owner] + self.size[owner])
        live, owner, total = live[keep], owner[keep], total[keep]
        bits = np.zeros(self.alphabet.size + 1, dtype=np.uint64)
        bits[slot] = pat.bits
        full = np.uint64((1 << m) - 1)
        for a in range(0, live.size, _CHUNK):
            at = live[a: a + _CHUNK]
            s = np.full(at.size, full, dtype=np.uint64)
            for j in range(m):
                s = _step(s, bits[self.code[at + j]])
            lcs = m - np.bitwise_count(s & full).astype(np.int64)
            np.maximum.at(out, owner[a: a + _CHUNK], 200.0 * lcs / total[a: a + _CHUNK])
        out[out <= cut] = 0.0
        return out


def _alphabet(patterns: Sequence[Pattern]) -> np.ndarray:
    return np.unique(np.concatenate([p.signs for p in patterns]))


def _long_best(needle: str, text: str) -> float:
    """Window search for needles over 63 signs, one window at a time."""
    m, n = len(needle), len(text)
    return max(
        indel_ratio(needle, text[max(i, 0): min(i + m, n)]) for i in range(-(m - 1), n)
    )


def _needle_best(needle: str, text: str) -> float:
    if len(needle) > _WORD:
        return _long_best(needle, text)
    pat = Pattern(needle)
    return float(Block([text], pat.signs).best(pat, np.zeros(1))[0])


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against every window of the longer (both ways when equally long)."""
    if not a or not b:
        return 100.0 if len(a) == len(b) else 0.0
    if len(a) > len(b):
        a, b = b, a
    best = _needle_best(a, b)
    return max(best, _needle_best(b, a)) if len(a) == len(b) else best


class Finder:
    """Scores batches of texts against a fixed list of names."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)
        self.patterns = [Pattern(n) for n in self.names]
        self.longest = max((p.m for p in self.patterns), default=0)
        self.short = [p for p in self.patterns if 0 < p.m <= _WORD]
        self.alphabet = _alphabet(self.short) if self.short else np.empty(0, np.uint32)

    def rounds(self, texts: list[str], cut: np.ndarray, starts=None, ends=None):
        """Yield (name index, score per text) in list order; ``cut`` may be raised by the caller between rounds."""
        lens = np.array([len(t) for t in texts])
        # a text shorter than the name is the needle itself
        swapped = {i: self._as_needle(texts[i]) for i in np.flatnonzero(lens <= self.longest)}
        block = Block(texts, self.alphabet, starts, ends) if self.short and texts else None
        for k, pat in enumerate(self.patterns):
            if block is not None and 0 < pat.m <= _WORD:
                score = block.best(pat, cut)
                score[lens < pat.m] = 0.0
            elif pat.m:
                score = np.array([_long_best(pat.text, t) if len(t) >= pat.m else 0.0 for t in texts])
            else:
                score = np.array([100.0 if n == 0 else 0.0 for n in lens])
            for i, row in swapped.items():
                if pat.m >= lens[i]:
                    score[i] = max(score[i], row[k])
            yield k, score

    def _as_needle(self, text: str) -> np.ndarray:
        if not text:
            return np.array([0.0 if p.m else 100.0 for p in self.patterns])
        if len(text) > _WORD:
            return np.array([_long_best(text, n) if len(n) >= len(text) else 0.0 for n in self.names])
        pat = Pattern(text)
        return Block(self.names, pat.signs).best(pat, np.zeros(len(self.names)))

    def _pieces(self, texts: list[str]):
        """(text index, piece, starts, ends): long texts in overlapping pieces so that memory stays flat."""
        step = _BLOCK - min(self.longest, _WORD)
        for i, t in enumerate(texts):
            if len(t) <= _BLOCK or self.longest > _WORD:
                yield i, t, True, True
                continue
            for a in range(0, len(t), step):
                last = a + _BLOCK >= len(t)
                yield i, t[a: a + _BLOCK], a == 0, last
                if last:
                    break

    def best(self, texts: list[str], cut: float) -> tuple[np.ndarray, np.ndarray]:
        """Per text the first name with the highest score above ``cut`` (-1 if none), and that score."""
        top = np.full(len(texts), float(cut))
        who = np.full(len(texts), -1)
        for run in _runs(self._pieces(texts), lambda p: len(p[1])):
            owner = np.array([p[0] for p in run])
            whole = all(p[2] and p[3] for p in run)
            cuts = np.where(who[owner] > 0, np.nextafter(top[owner], 0), top[owner])
            for k, score in self.rounds([p[1] for p in run], cuts, [p[2] for p in run], [p[3] for p in run]):
                got = np.zeros(len(texts))
                np.maximum.at(got, owner, score)
                better = (got > top) | ((got == top) & (who > k))
                top[better] = got[better]
                who[better] = k
                # an earlier name may still tie from a later piece of the same text
                cuts[:] = top[owner] if whole else np.where(who[owner] > k + 1, np.nextafter(top[owner], 0), top[owner])
        return who, top


def _runs(items, size):
    """Group items into runs of about ``_BLOCK`` signs."""
    run, total = [], 0
    for it in items:
        run.append(it)
        total += size(it) + _WORD
        if total >= _BLOCK:
            yield run
            run, total = [], 0
    if run:
        yield run


def _frame(rows, columns):
    return pd.DataFrame(rows, columns=columns)


def scheme_by_name(name: Column, cut: float, master: Sequence[Scheme] = SCHEME_MASTER) -> Column:
    """Best scheme by token-sorted ratio of a short name; repeated names are scored once per Arrow batch."""
    cands = candidate_names(master)
    info = [(s.scheme_name, s.category) for s in master]

    @F.pandas_udf(MATCH)
    def score(texts: pd.Series) -> pd.DataFrame:
        codes, uniq = pd.factorize(texts)
        uniq = list(uniq)
        best = np.full(len(uniq), float(cut))
        who = np.full(len(uniq), -1)
        names = Names([sort_tokens(u) for u in uniq], [sort_tokens(c) for c, _ in cands], float(cut))
        for k, (_, pos) in enumerate(cands):
            s = names.scores(k, best)
            better = s > best
            best[better] = s[better]
            who[better] = pos
        rows = [
            (*info[who[c]], float(best[c])) if c >= 0 and who[c] >= 0 else (None, None, None)
            for c in codes
        ]
        return _frame(rows, ["scheme_name", "scheme_category", "score"])

    return settle(score(name))


def scheme_in_text(text: Column, cut: float, master: Sequence[Scheme] = SCHEME_MASTER) -> Column:
    """Best scheme by partial ratio inside a (long) lower-cased text; null text is skipped."""
    cands = candidate_names(master)
    info = [(s.scheme_name, s.category) for s in master]

    @F.pandas_udf(MATCH)
    def score(texts: pd.Series) -> pd.DataFrame:
        finder = Finder([c for c, _ in cands])
        codes, uniq = pd.factorize(texts)
        who, top = finder.best(list(uniq), cut)
        found = [(*info[cands[w][1]], float(t)) if w >= 0 else (None, None, None) for w, t in zip(who, top)]
        rows = [found[c] if c >= 0 else (None, None, None) for c in codes]
        return _frame(rows, ["scheme_name", "scheme_category", "score"])

    return settle(score(text))


def scheme_by_sheets(sheets: Column, cut: float, master: Sequence[Scheme] = SCHEME_MASTER) -> Column:
    """Scheme named by a sheet: the last (sheet, scheme) pair over the cut wins, every pair counts."""
    cands = candidate_names(master)
    info = [(s.scheme_name, s.category) for s in master]

    @F.pandas_udf(SHEET_MATCH)
    def score(col: pd.Series) -> pd.DataFrame:
        finder = Finder([c for c, _ in cands])
        lists = [[(s or "").lower() for s in names] if names is not None else [] for names in col]
        distinct = list(dict.fromkeys(s for names in lists for s in names))
        over: dict[str, list[int]] = {s: [] for s in distinct}
        for run in _runs(distinct, len):
            for k, sc in finder.rounds(run, np.full(len(run), float(cut))):
                for i in np.flatnonzero(sc > cut):
                    pos = cands[k][1]
                    if pos not in over[run[i]]:
                        over[run[i]].append(pos)
        rows = []
        for names in lists:
            pairs = [p for s in names for p in over[s]]
            rows.append((*info[pairs[-1]], len(pairs)) if pairs else (None, None, 0))
        out = _frame(rows, ["scheme_name", "scheme_category", "hits"])
        out["hits"] = out["hits"].astype("int32")
        return out

    return settle(score(sheets))
