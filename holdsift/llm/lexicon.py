"""A minimal acyclic transducer from words to token ids, laid out for memory-mapping.

Words share prefixes and suffixes: states with the same continuations are one. Each arc carries a number; the numbers
along a word's path add up to the word's place among the sorted words, which finds its ids. The file is a few flat
arrays, so a worker maps it and reads only the pages its words touch.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

_MAGIC = b"MATL0001"
_PARTS = (("key", np.uint64), ("target", np.uint32), ("skip", np.uint32), ("final", np.uint8),
          ("start", np.uint32), ("ids", np.int32))


def build(entries: Iterable[tuple[bytes, Sequence[int]]]) -> bytes:
    """File content for (word, ids) entries; words distinct and not empty, in any order."""
    entries = sorted(entries)
    arcs: list[dict[int, int]] = [{}]  # of the states of the word in work, then of registered ones
    final = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int]] = []  # (state, label) down to the last state of the word before
    last = b""
    spare: list[int] = []  # numbers of states that turned out to be known ones

    def new_state() -> int:
        if spare:
            final[spare[-1]] = False
            return spare.pop()
        arcs.append({})
        final.append(False)
        return len(arcs) - 1

    def settle(depth: int) -> None:
        while len(path) > depth:
            parent, label = path.pop()
            child = arcs[parent][label]
            mark = (final[child], tuple(arcs[child].items()))
            known = register.setdefault(mark, child)
            if known != child:
                arcs[parent][label] = known
                arcs[child] = {}
                spare.append(child)

    for word, _ in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        state = arcs[path[-1][0]][path[-1][1]] if path else 0
        for label in word[common:]:
            arcs[state][label] = new_state()
            path.append((state, label))
            state = arcs[state][label]
        final[state] = True
        last = word
    settle(0)

    number: dict[int, int] = {0: 0}
    order = [0]
    for state in order:
        for child in arcs[state].values():
            if child not in number:
                number[child] = len(order)
                order.append(child)
    words_below: dict[int, int] = {}
    stack = [0]
    while stack:
        state = stack[-1]
        waiting = [c for c in arcs[state].values() if c not in words_below]
        if waiting:
            stack.extend(waiting)
        else:
            words_below[state] = int(final[state]) + sum(words_below[c] for c in arcs[state].values())
            stack.pop()
    key, target, skip = [], [], []
    for state in order:
        before = int(final[state])
        for label, child in sorted(arcs[state].items()):
            key.append(number[state] << 8 | label)
            target.append(number[child])
            skip.append(before)
            before += words_below[child]
    start = np.concatenate([[0], np.cumsum([len(ids) for _, ids in entries])])
    parts = (key, target, skip, [final[s] for s in order], start, [i for _, ids in entries for i in ids])
    out = [_MAGIC, np.array([len(p) for p in parts], np.int64).tobytes()]
    for (_, kind), part in zip(_PARTS, parts):
        raw = np.asarray(part, kind).tobytes()
        out.append(raw + b"\0" * (-len(raw) % 8))
    return b"".join(out)


class Lexicon:
    """A mapped lexicon file."""

    def __init__(self, path: str) -> None:
        whole = np.memmap(path, np.uint8, "r")
        if bytes(whole[:8]) != _MAGIC:
            raise ValueError(f"{path} is no lexicon")
        sizes = whole[8: 8 + 8 * len(_PARTS)].view(np.int64)
        at = 8 + 8 * len(_PARTS)
        for (name, kind), n in zip(_PARTS, sizes):
            length = int(n) * np.dtype(kind).itemsize
            setattr(self, name, whole[at: at + length].view(kind).view(np.ndarray))
            at += length + -length % 8

    def places(self, words: Sequence[bytes]) -> np.ndarray:
        """Place of each word, -1 where the lexicon has it not; all words walk one letter at a time together."""
        n = len(words)
        place = np.full(n, -1, np.int64)
        if not n or not len(self.key):
            return place
        lengths = np.array([len(w) for w in words])
        flat = np.frombuffer(b"".join(words), np.uint8)
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        live, state, total = np.arange(n), np.zeros(n, np.uint64), np.zeros(n, np.int64)
        step = 0
        while len(live):
            done = lengths[live] == step
            ended = done & (self.final[state.astype(np.int64)] == 1)
            place[live[ended]] = total[ended]
            live, state, total = live[~done], state[~done], total[~done]
            if not len(live):
                break
            wanted = state << np.uint64(8) | flat[begin[live] + step].astype(np.uint64)
            arc = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            there = self.key[arc] == wanted
            arc, live = arc[there], live[there]
            state, total = self.target[arc].astype(np.uint64), total[there] + self.skip[arc]
            step += 1
        return place

    def ids_at(self, place: int) -> list[int]:
        return self.ids[self.start[place]: self.start[place + 1]].tolist()
