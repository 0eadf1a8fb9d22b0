"""BPE encoding and decoding with a lexicon of frequent words.

The words of all documents are counted by Spark; the most frequent are merged once and compiled into a minimal
acyclic transducer (``lexicon``), which is sent along as a file and memory-mapped by the workers. A word in the
lexicon takes its ids from there; any other word is merged exactly, pair by pair, so the ids never depend on what the
lexicon holds. The tokenizer's file is a parameter and is read, not trained.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
import re
import unicodedata
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdsift.llm.common import columns, table
from holdsift.llm.lexicon import Lexicon, build
from holdsift.session import served_folder

#: Words the lexicon holds at most: the most frequent of all documents, ties by code point. All others are merged.
LEXICON_WORDS = 1 << 17
#: Resolved words a worker remembers, and counts it gathers, before it starts anew.
REMEMBERED = 1 << 18
COUNTED = 1 << 17
#: A merge is its rank above and its new id below; what never merges has the last rank.
_ID, _NEVER = (1 << 32) - 1, 1 << 62

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The word pattern of this family of tokenizers (a fixed value of its files), white space spelt out.
_PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: The same for texts whose numbers are all decimal digits, where the built-in classes say it, several times as fast.
_PLAIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w{_SPACE}]|_)+")
_ODD_NUMBERS = frozenset(c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("No", "Nl"))


def _byte_letters() -> list[str]:
    """The sign that stands for each byte: itself where it prints, else the next free one from code point 256."""
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in printing else chr(next(other)) for b in range(256)]


class Bpe:
    """A tokenizer file: BPE over byte letters with word ends; lower-cased and NFC, white space dropped."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or spec.get("decoder"):
            raise ValueError(f"{path}: a BPE file with word ends and no decoder is needed")
        self.end, vocab = model["end_of_word_suffix"], model["vocab"]
        self.token = {i: t for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token.update({i: t for t, i in self.added.items()})
        self.merge = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((vocab[a], vocab[b]), rank << 32 | vocab[a + b])
        letters = _byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + self.end] for c in letters]
        self._added = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; an added token stands as itself."""
        if self._added and self._added.search(text):
            out = []
            for i, part in enumerate(self._added.split(text)):
                out.extend([part] if i % 2 else self._words(part))
            return out
        return self._words(text)

    @staticmethod
    def _words(text: str) -> list[str]:
        if not text.isascii():
            # signs are lower-cased one by one, so a capital sigma never becomes a final one
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
            return (_PLAIN_PIECES if _ODD_NUMBERS.isdisjoint(set(text)) else _PIECES).findall(text)
        return _PLAIN_PIECES.findall(text.lower())

    def merged(self, word: str) -> list[int]:
        """Token ids of a word: the pair of least rank is merged first, the leftmost of equal pairs."""
        raw = word.encode("utf-8")
        ids = [self.inner[b] for b in raw]
        ids[-1] = self.last[raw[-1]]
        return self._merge_short(ids) if len(ids) <= 64 else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        find = self.merge.get
        hits = [find(p, _NEVER) for p in zip(ids, ids[1:])]
        while hits:
            best = min(hits)
            if best == _NEVER:
                break
            i = hits.index(best)
            ids[i: i + 2] = [best & _ID]
            del hits[i]
            if i < len(hits):
                hits[i] = find((ids[i], ids[i + 1]), _NEVER)
            if i:
                hits[i - 1] = find((ids[i - 1], ids[i]), _NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n and (hit := self.merge.get((ids[i], ids[after[i]]))) is not None:
                heapq.heappush(heap, (hit, i, ids[i], ids[after[i]]))

        for i in range(n - 1):
            offer(i)
        while heap:
            hit, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], gone[j], after[i] = hit & _ID, True, after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [t for t, out in zip(ids, gone) if not out]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Bpe:
    return Bpe(path)


@lru_cache(maxsize=4)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


class _Numbers(dict):
    """Words to numbers in order of appearance; ``fresh`` lists those just numbered."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.fresh.append(word)
        return n


class Encoder:
    """Words to ids through the lexicon, unseen words by merging; remembers a bounded number of words."""

    def __init__(self, bpe: Bpe, lexicon: Lexicon, remembered: int = REMEMBERED) -> None:
        self.bpe, self.lexicon, self.remembered = bpe, lexicon, remembered
        self._forget()

    def _forget(self) -> None:
        self.numbers, self.ends, self.pool = _Numbers(), array("q", [0]), array("i")

    def _learn(self) -> None:
        words, self.numbers.fresh = self.numbers.fresh, []
        places = self.lexicon.places([w.encode("utf-8") for w in words])
        found = np.maximum(places, 0)
        empty = not len(self.lexicon.key)
        begins = [0] * len(words) if empty else self.lexicon.start[found].tolist()
        ends = [0] * len(words) if empty else self.lexicon.start[found + 1].tolist()
        for word, place, begin, end in zip(words, places.tolist(), begins, ends):
            if word in self.bpe.added:
                self.pool.append(self.bpe.added[word])
            elif place >= 0:
                self.pool.extend(self.lexicon.ids[begin:end].tolist())
            else:
                self.pool.extend(self.bpe.merged(word))
            self.ends.append(len(self.pool))

    def encode(self, texts: list[str]) -> pa.ListArray:
        if len(self.numbers) > self.remembered:
            self._forget()
        words = [self.bpe.pieces(t) for t in texts]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        number = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
        self._learn()
        ends, pool = np.array(self.ends, np.int64), np.array(self.pool, np.int32)
        begin, length = ends[number], ends[number + 1] - ends[number]
        total = np.concatenate([[0], np.cumsum(length)])
        ids = pool[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        return pa.ListArray.from_arrays(pa.array(total[np.concatenate([[0], np.cumsum(sizes)])], pa.int32()), pa.array(ids))


def count_words(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(word, n) over the whole texts of all documents; each task adds up before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, counts = tokenizer(path), Counter()

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for text in batch.column(0):
                counts.update(bpe.pieces(text.as_py() or ""))
                if len(counts) > COUNTED:
                    yield flush()
                    counts = Counter()
        yield flush()

    return docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def compile_lexicon(docs: DataFrame, path: str, text_col: str = "text", size: int = LEXICON_WORDS) -> str:
    """Name of the lexicon file of the ``size`` most frequent words, added to the session's files.

    The file is a few megabytes by its bound; Spark sends it to every executor, also to one that starts later.
    """
    bpe = tokenizer(path)
    frequent = count_words(docs, path, text_col).orderBy(F.col("n").desc(), "word").limit(size).select("word").toArrow()
    words = [w for w in frequent.column("word").to_pylist() if w not in bpe.added]
    content = build((w.encode("utf-8"), bpe.merged(w)) for w in words)
    name = f"lexicon-{hashlib.sha256(content).hexdigest()[:20]}.bin"
    sc = docs.sparkSession.sparkContext
    if not any(os.path.basename(f) == name for f in sc.listFiles):  # the same words, the same file
        path = os.path.join(served_folder(), name)
        with open(path, "wb") as f:
            f.write(content)
        sc.addFile(path)
    return name


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            yield batch.slice(at, 128)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    texts = columns(docs, doc_id=id_col, text=text_col)
    return texts, f"doc_id {dict(texts.dtypes)['doc_id']}, ids array<int>"


def _token_table(path: str) -> pa.Array:
    token = tokenizer(path).token
    return pa.array([token.get(i) for i in range(max(token) + 1)], pa.string())


def _spelled(table: pa.Array, ids: pa.ListArray) -> pa.Array:
    ids = pc.fill_null(ids, pa.scalar([], ids.type)) if ids.null_count else ids
    tokens = pa.ListArray.from_arrays(pc.subtract(ids.offsets, ids.offsets[0]), table.take(ids.flatten()))
    return pc.binary_join(tokens, " ")


def encode(docs: DataFrame, path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids) of every whole text. Null and empty texts have no ids; repeated rows are encoded alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer(path), _lexicon(lexicon))
        for part in _parts(batches):
            ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), ids], ["doc_id", "ids"])

    texts, schema = _texts(docs, id_col, text_col)
    return texts.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``: the tokens in order, special ones too, joined by a space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _token_table(path)
        for part in _parts(batches):
            yield pa.RecordBatch.from_arrays([*part.columns, _spelled(table, part.column(1))], ["doc_id", "ids", "decoded"])

    picked = encoded.select("doc_id", "ids")
    return picked.mapInArrow(run, f"doc_id {dict(picked.dtypes)['doc_id']}, ids array<int>, decoded string")


def encode_and_decode(docs: DataFrame, path: str, lexicon: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(...))`` in one Python stage: a task has one worker, with one tokenizer, instead of two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = Encoder(tokenizer(path), _lexicon(lexicon)), _token_table(path)
        for part in _parts(batches):
            ids = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), ids, _spelled(table, ids)], ["doc_id", "ids", "decoded"])

    texts, schema = _texts(docs, id_col, text_col)
    return texts.mapInArrow(run, f"{schema}, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and the SHA-256 of the ids and of the decoded text of every document."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    coded = encode_and_decode(docs, path, compile_lexicon(docs, path))
    text = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(text, 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_bpe(spark, sf_dir):
    return digests(table(spark, sf_dir, "documents"))
