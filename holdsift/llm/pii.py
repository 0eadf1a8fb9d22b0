"""Personal data in texts: fixed patterns, and a character BiLSTM-CRF that adds what they miss.

Base spans come from the four patterns and always stay. The model is trained in NumPy on labelled spans: stretches of
sampled documents (base spans labelled) with made-up data written into them, plain and disguised ("name (at) mail dot
com", numbers without a plus, dotted cards), among look-alikes that are none. A text is read in overlapping windows;
each is decoded by Viterbi, and the spans of all windows of a text are reconciled together: those that most windows
agree on, by the best set without overlaps.

A span must hold an anchor (a digit, "@", a bracketed "at" or the word "dot") outside all base spans. A window without
one can hold no such span, so it is not decoded; that changes no result.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdsift.llm import bilstm
from holdsift.llm.common import columns, table
from holdsift.llm.piitraining import examples

KINDS = ("email", "ip", "card", "phone")
HIDDEN = 20
#: Documents whose texts carry the training examples: those with the least digest of their id, at most so many.
CARRIERS = 200
#: A window begins every STRIDE signs and is twice as long: a span of up to STRIDE signs lies whole in one.
STRIDE = 96
WINDOW = 2 * STRIDE
BATCH = 512
_TAGS = 1 + 2 * len(KINDS)  # 0 outside, 2k+1 begins and 2k+2 continues kind k

# Fixed patterns of the base; which signs belong to what is theirs.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]|[(\[{]\s?(?:at|dot)\s?[)\]}]|\bdot\b", re.I)
Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else 2 * n - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches without overlap, found from their "@": the part before it reaches back as far as it may."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
            free = domain.end()
        at = text.find("@", max(free, at + 1))


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by kind, then start. A match that fails its check is dropped, not tried anew."""
    out: list[Span] = [(0, a, b) for a, b in _emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def classes(text: str) -> np.ndarray:
    """Character classes: 0 is kept for padding, ASCII signs have their own, others go by what they are."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < 128, codes + 1, np.where(codes < 0x2000, 129, np.where(codes < 0x2070, 130, 131))).astype(np.uint8)


N_CLASSES = 132


def _grammar() -> tuple[np.ndarray, np.ndarray]:
    """Moves and first tags that are allowed: a kind continues only itself."""
    allowed = np.ones((_TAGS, _TAGS), bool)
    first = np.ones(_TAGS, bool)
    for k in range(len(KINDS)):
        allowed[:, 2 * k + 2] = False
        allowed[[2 * k + 1, 2 * k + 2], 2 * k + 2] = True
        first[2 * k + 2] = False
    return allowed, first


ALLOWED, FIRST = _grammar()


def tags_of(length: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(length, np.int64)
    for kind, a, b in spans:
        tags[a: b] = 2 * kind + 2
        tags[a] = 2 * kind + 1
    return tags


def spans_of(tags: np.ndarray) -> list[Span]:
    out, open_ = [], None
    for i, t in enumerate([*tags.tolist(), 0]):
        if open_ is not None and t != 2 * open_[0] + 2:
            out.append((open_[0], open_[1], i))
            open_ = None
        if t and t % 2 == 1:
            open_ = (t // 2, i)
    return out


def plausible(kind: int, text: str) -> bool:
    """Exact check of a span the model adds: what its kind cannot do without."""
    digits = _digits(text)
    if kind == 0:
        return bool(re.search(r"@|\bat\b", text, re.I)) and bool(re.search(r"\.|\bdot\b", text, re.I))
    if kind == 1:
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 8 <= len(digits) <= 15


def fit(carriers: list[str], hidden: int = HIDDEN, n: int = 2400, epochs: int = 8, seed: int = 5) -> bilstm.Net:
    """Model from labelled examples of one length made over the carriers' texts."""
    texts, spans = examples(carriers, base_spans, n, STRIDE, seed)
    x = np.stack([classes(t) for t in texts], axis=1)
    gold = np.stack([tags_of(len(t), s) for t, s in zip(texts, spans)], axis=1)
    net = bilstm.fresh(N_CLASSES, hidden, _TAGS, seed)
    bilstm.train(net, x, gold, ALLOWED, FIRST, epochs, 80, 0.025, seed)
    return net


def windows(length: int, anchors: list[int]) -> list[int]:
    """Starts of the windows, every STRIDE signs, that hold an anchor."""
    last = max(0, -(-(length - WINDOW) // STRIDE)) if length > WINDOW else 0
    found = {min(w, last) for a in anchors for w in (a // STRIDE - 1, a // STRIDE) if w >= 0}
    return sorted(w * STRIDE for w in found)


def reconcile(votes: dict[Span, float]) -> list[Span]:
    """The set of spans without overlaps with the most votes; of equal sets the one that ends earlier."""
    spans = sorted(votes, key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    best: list[tuple[float, int]] = [(0.0, -1)]
    for i, (kind, a, b) in enumerate(spans):
        j = int(np.searchsorted(ends[:i], a, "right"))
        take = best[j][0] + votes[(kind, a, b)]
        best.append((take, i) if take > best[i][0] else (best[i][0], -1))
    out, i = [], len(spans)
    while i:
        if best[i][1] < 0:
            i -= 1
        else:
            span = spans[best[i][1]]
            out.append(span)
            i = int(np.searchsorted(ends[: i - 1], span[1], "right"))
    return out[::-1]


def _decode(net: bilstm.Net, pieces: list[np.ndarray]) -> list[list[Span]]:
    out = []
    for at in range(0, len(pieces), BATCH):
        part = pieces[at: at + BATCH]
        x = np.zeros((max(map(len, part)), len(part)), np.uint8)
        for i, p in enumerate(part):
            x[: len(p), i] = p
        tags = bilstm.viterbi(net, bilstm.emissions(net, x), np.array([len(p) for p in part]), ALLOWED, FIRST)
        out.extend(spans_of(tags[: len(p), i]) for i, p in enumerate(part))
    return out


def find(texts: list[str], net: bilstm.Net, every_window: bool = False) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text. ``every_window`` decodes those without an anchor too (for tests)."""
    base, jobs, pieces = [], [], []
    for n, text in enumerate(texts):
        own = base_spans(text)
        base.append(own)
        covered = sorted((a, b) for _, a, b in own)
        starts = [a for a, _ in covered]
        reach = np.maximum.accumulate([b for _, b in covered]).tolist() if covered else []
        anchors = []
        for m in _ANY.finditer(text):
            i = int(np.searchsorted(starts, m.start(), "right")) if starts else 0
            if not i or reach[i - 1] <= m.start():
                anchors.append(m.start())
        begins = windows(len(text), range(0, len(text), STRIDE) if every_window else anchors)
        if begins:
            coded = classes(text)
            pieces.extend(coded[b: b + WINDOW] for b in begins)
            jobs.extend((n, b) for b in begins)
    votes: dict[int, dict[Span, float]] = defaultdict(lambda: defaultdict(float))
    for (n, begin), piece, spans in zip(jobs, pieces, _decode(net, pieces)):
        text, size = texts[n], len(piece)
        for kind, a, b in spans:
            cut = (a == 0 and begin > 0) or (b == size and begin + size < len(text))
            if not cut:
                votes[n][(kind, begin + a, begin + b)] += 1.0 + min(a, size - b) / (10.0 * WINDOW)
    out = []
    for n, text in enumerate(texts):
        free = {s: v for s, v in votes[n].items() if _ANY.search(text, s[1], s[2]) and plausible(s[0], text[s[1]: s[2]])
                and not any(a < s[2] and s[1] < b for _, a, b in base[n])} if n in votes else {}
        out.append((base[n], reconcile(free)))
    return out


def told(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def carrier_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carriers: int = CARRIERS) -> DataFrame:
    """(id, text) of at most ``carriers`` documents, in order. They are chosen by id, so that only their texts are gathered;
    of rows that share a chosen id the least text is taken, rows without an id or a text carry nothing."""
    texts = columns(docs, id=id_col, text=text_col).filter("text is not null and id is not null")
    order = [F.md5(F.col("id").cast("string")), F.col("id")]
    chosen = texts.select("id").distinct().orderBy(*order).limit(carriers)
    least = texts.join(F.broadcast(chosen), "id", "left_semi").groupBy("id").agg(F.min("text").alias("text"))
    return least.orderBy(*order)


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carriers: int = CARRIERS) -> bilstm.Net:
    return fit([r["text"] for r in carrier_texts(docs, id_col, text_col, carriers).collect()])


def personal_data(docs: DataFrame, net: bilstm.Net | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every whole text; a span is (kind, start, end, base) in code points, end exclusive.

    Defined results: null and empty texts have no spans; repeated rows and null ids are read like any other; a span the
    model adds is at most ``STRIDE`` signs long where windows cut it; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net or train(docs, id_col, text_col))  # some 100 kB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for at in range(0, batch.num_rows, 256):
                found += find([t or "" for t in batch.column(1).slice(at, 256).to_pylist()], shared.value)
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "base": own} for group, own in zip(pair, (True, False)) for k, a, b in group]
                    for pair in found]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], ["doc_id", "spans"])

    picked = columns(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {dict(picked.dtypes)['doc_id']}, spans array<struct<kind: string, start: long, end: long, base: boolean>>"
    return picked.mapInArrow(run, schema)


def summary(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""
    order = F.array(*(F.lit(k) for k in KINDS))
    listed = F.array_sort(F.transform("spans", lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), s["kind"].alias("kind"))))
    line = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter(F.col("listed"), lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", listed.alias("listed")).select(
        "doc_id", *(count(k) for k in KINDS), F.sha2(line(base), 256).alias("base_sha256"), line(F.col("listed")).alias("spans"))


def op1_pii(spark, sf_dir):
    return summary(personal_data(table(spark, sf_dir, "documents")))
