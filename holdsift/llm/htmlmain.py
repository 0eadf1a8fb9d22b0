"""Main text of web pages: a linear-chain CRF over the leaf blocks of the DOM.

A page is read once, left to right, with a stack of open elements; each stretch of text between block borders is a leaf
block. What a block shows is the tags and names of its ancestors and the shape of its text. A two-label chain, trained
by maximum likelihood on labelled pages, is decoded by Viterbi over the blocks of a page.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from holdsift.llm import labelledpages
from holdsift.llm.common import columns, table

BITS = 14
TRAINING_PAGES = 600

_TOKEN = regex.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|template|noscript|iframe|svg|textarea|select|title)\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</\1\s*+[^>]*+>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?/][^>]*+>", regex.S | regex.I)
_NAME = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_WORDS_OF_NAME = re.compile(r"[A-Za-z][a-z]*|[0-9]+")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr img br".split())
#: What an opening tag closes first, when it stands open below the next border.
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "option": ("option",), "body": ("head",)}
_BORDERS = frozenset("ul ol dl table article section main aside nav header footer div form body".split())


def _hash(name: str) -> int:
    return zlib.crc32(name.encode("utf-8")) & ((1 << BITS) - 1)


def element_features(tag: str, attributes: str) -> list[int]:
    names = [f"tag:{tag}"]
    for value in _NAME.findall(attributes):
        names.extend({f"name:{w.lower()}" for w in _WORDS_OF_NAME.findall(value)})
    return [_hash(n) for n in names]


def text_features(text: str, linked: int) -> list[int]:
    n = len(text)
    words = text.count(" ") + 1
    share = 4 * linked // max(n, 1)
    return [_hash(f) for f in ("bias", f"words:{words.bit_length()}", f"linked:{min(share, 4)}", f"end:{text[-1:] in '.!?:;…'}",
                               f"rights:{'©' in text}", f"commas:{min(text.count(','), 3)}")]


class Reader:
    """Blocks of a page: (text, feature numbers). Ancestors' features add up over the open elements.

    Without ``features``, for who wants the texts alone, blocks have none.
    """

    def __init__(self, features: bool = True) -> None:
        self.features = features
        self.memo: dict[tuple[str, str], list[int]] = {}

    def _features(self, tag: str, attributes: str) -> list[int]:
        if not self.features:
            return []
        key = (tag, attributes if len(attributes) < 200 else attributes[:0])
        if key[1] != attributes:
            return element_features(tag, attributes)
        found = self.memo.get(key)
        if found is None:
            if len(self.memo) > 20_000:
                self.memo.clear()
            found = self.memo[key] = element_features(tag, attributes)
        return found

    def blocks(self, page: str) -> Iterator[tuple[str, list[int]]]:
        stack: list[tuple[str, list[int]]] = []
        parts: list[str] = []
        linked, links = 0, 0
        end = 0

        def close(keep: int) -> None:
            nonlocal links
            links -= sum(tag == "a" for tag, _ in stack[keep:])
            del stack[keep:]

        def flush() -> tuple[str, list[int]] | None:
            nonlocal linked
            text = " ".join(html.unescape("".join(parts)).split())
            parts.clear()
            share, linked = linked, 0
            if text:
                if not self.features:
                    return text, []
                return text, [f for _, own in stack for f in own] + text_features(text, share)
            return None

        for m in _TOKEN.finditer(page):
            if m.start() > end:
                parts.append(page[end: m.start()])
                if links:
                    linked += m.start() - end
            end = m.end()
            tag = m.group(3)
            if tag is None:
                continue
            tag = tag.lower()
            if tag in _INLINE:
                if tag == "br":
                    parts.append(" ")
                elif m.group(2):
                    at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag or stack[i][0] not in _INLINE), -1)
                    if at >= 0 and stack[at][0] == tag:
                        close(at)
                elif tag not in _VOID:
                    stack.append((tag, self._features(tag, m.group(4))))
                    links += tag == "a"
                continue
            block = flush()
            if block:
                yield block
            if m.group(2):
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
                if at >= 0:
                    close(at)
                continue
            closes = _CLOSES.get(tag, ())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or stack[i][0] in closes or (stack[i][0] in _INLINE and stack[i][0] != "a"):
                    close(i)
                elif stack[i][0] in _BORDERS:
                    break
            if tag not in _VOID and not m.group(4).endswith("/"):
                stack.append((tag, self._features(tag, m.group(4))))
        if end < len(page):
            parts.append(page[end:])
            linked += (len(page) - end) if links else 0
        block = flush()
        if block:
            yield block


class Chain:
    """Linear-chain CRF with labels 0 (other) and 1 (main)."""

    def __init__(self, emission: np.ndarray, transition: np.ndarray, start: np.ndarray) -> None:
        self.emission, self.transition, self.start = emission, transition, start

    def scores(self, features: Sequence[Sequence[int]]) -> np.ndarray:
        ends = np.cumsum([len(f) for f in features])
        flat = self.emission[np.fromiter((i for f in features for i in f), np.int64, int(ends[-1]))]
        total = np.concatenate([np.zeros((1, 2)), np.cumsum(flat, axis=0)])
        return total[ends] - total[np.concatenate([[0], ends[:-1]])]

    def decode(self, features: Sequence[Sequence[int]]) -> list[int]:
        """Best label sequence (Viterbi); of equal ones that with label 0 latest."""
        if not features:
            return []
        score = self.scores(features).tolist()
        (a, b), (c, d) = self.transition.tolist()
        other, main = self.start[0] + score[0][0], self.start[1] + score[0][1]
        back = []
        for s0, s1 in score[1:]:
            to_other, to_main = main + c > other + a, main + d > other + b
            back.append((to_other, to_main))
            other, main = (main + c if to_other else other + a) + s0, (main + d if to_main else other + b) + s1
        label = int(main > other)
        out = [label]
        for step in reversed(back):
            label = int(step[label])
            out.append(label)
        return out[::-1]


def train(pages: Sequence[tuple[list[list[int]], list[int]]], rounds: int = 200, step: float = 0.1, decay: float = 0.002) -> Chain:
    """Maximum likelihood by full-batch Adam; ``pages``: features and labels of each page's blocks.

    Pages are padded to one length and run through the forward and backward sums together.
    """
    pages = [p for p in pages if p[1]]
    n, longest = len(pages), max(len(p[1]) for p in pages)
    row, col = [], []
    gold = np.zeros((n, longest, 2))
    mask = np.zeros((n, longest), bool)
    for i, (features, labels) in enumerate(pages):
        mask[i, : len(labels)] = True
        gold[i, np.arange(len(labels)), labels] = 1
        for t, f in enumerate(features):
            row.extend([i * longest + t] * len(f))
            col.extend(f)
    row, col = np.array(row), np.array(col)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    used, firsts = np.unique(col, return_index=True)
    theta = [np.zeros((1 << BITS, 2)), np.zeros((2, 2)), np.zeros(2)]
    first, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    gold_pairs = np.einsum("nti,ntj,nt->ij", gold[:, :-1], gold[:, 1:], mask[:, 1:])
    back = np.argsort(row, kind="stable")
    rows_used, row_firsts = np.unique(row[back], return_index=True)

    def logsum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis=axis, keepdims=True)
        return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)

    for k in range(1, rounds + 1):
        emission, transition, start = theta
        e = np.zeros((n * longest, 2))
        e[rows_used] = np.add.reduceat(emission[col[back]], row_firsts, axis=0)
        e = e.reshape(n, longest, 2)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = start + e[:, 0]
        for t in range(1, longest):
            moved = logsum(alpha[:, t - 1, :, None] + transition[None], 1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None], moved, alpha[:, t - 1])
        for t in range(longest - 2, -1, -1):
            moved = logsum(transition[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None], moved, 0)
        z = logsum(alpha[:, -1], 1)
        node = np.exp(alpha + beta - z[:, None, None]) * mask[..., None]
        pair = np.exp(alpha[:, :-1, :, None] + transition + (e + beta)[:, 1:, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
        slope = (node - gold).reshape(-1, 2)
        g_emission = np.zeros_like(emission)
        g_emission[used] = np.add.reduceat(slope[row], firsts, axis=0)
        grads = [g_emission / n + decay * emission / n, (pair.sum(axis=(0, 1)) - gold_pairs) / n, (node[:, 0] - gold[:, 0]).mean(axis=0)]
        for x, g, m, v in zip(theta, grads, first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= step * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.999**k)) + 1e-8)
    return Chain(*theta)


def labelled(page: str, reader: Reader) -> tuple[list[list[int]], list[int]]:
    """Features and labels of a labelled page; a block that holds both marks counts as main."""
    features, labels = [], []
    marks = str.maketrans("", "", labelledpages.MAIN + labelledpages.OTHER)
    plain = list(reader.blocks(page.translate(marks)))
    for (_, f), (text, _) in zip(plain, reader.blocks(page)):
        features.append(f)
        labels.append(int(labelledpages.MAIN in text))
    return features, labels


def trained(n_pages: int = TRAINING_PAGES) -> Chain:
    reader = Reader()
    return train([labelled(p, reader) for p in labelledpages.pages(n_pages)])


def main_text(page: str, chain: Chain, reader: Reader) -> str:
    blocks = list(reader.blocks(page))
    labels = chain.decode([f for _, f in blocks])
    return "\n".join(text for (text, _), label in zip(blocks, labels) if label)


def extract(pages: DataFrame, chain: Chain | None = None, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Defined results: null, empty and textless pages have an empty text; ids and urls pass through, null or repeated;
    unclosed comments and scripts reach to the page's end; unknown and unbalanced tags are tolerated; an empty table
    gives no rows.
    """
    chain = chain or trained()
    weights = pages.sparkSession.sparkContext.broadcast((chain.emission, chain.transition, chain.start))  # 2**BITS pairs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, own = Reader(), Chain(*weights.value)
        for batch in batches:
            texts = [main_text(p.as_py() or "", own, reader) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    picked = columns(pages, page_id=id_col, url=url_col, html=html_col)
    kinds = dict(picked.dtypes)
    return picked.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op8_main_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
