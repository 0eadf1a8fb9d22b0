"""Token counts of whole texts through a cache keyed by digests.

A count depends on the text's normalised content and on the tokenizer's version alone, so it is kept under the digests
of both. A run digests its texts, joins the digests to the stored counts, encodes only distinct contents that are not
there, each once however often it stands, and appends their counts. Nothing in the cache ever changes: a run that is
stopped while it appends leaves counts that are right, and two runs that append the same content agree.

Normalising joins contents that the tokenizer itself cannot tell apart (white space it drops, case it folds); where that
is not sure from the tokenizer's file, the content is the text as it is.
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain
from importlib.metadata import version as library_version

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift.llm.common import columns, cut, serve, shared_folder, table

#: Tokens above which a document is over the limit.
LIMIT = 2048
#: Bytes of text that go to the tokenizer at once, beside the longest text.
TOGETHER = 1 << 20
#: Misses whose digests take at most so many bytes are sent to every task instead of being shuffled; their number is known.
SENT_BYTES = 8 << 20
#: Words whose counts a worker remembers, and the bytes of them, before it starts anew.
REMEMBERED = 1 << 19
REMEMBERED_BYTES = 32 << 20

_CACHE = "content binary, n_tokens long, version string"


@lru_cache(maxsize=4)
def _counter(path: str) -> Callable[[list[str]], list[int]]:
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    whole.no_truncation()
    whole.no_padding()
    return lambda texts: [len(e) for e in whole.encode_batch_fast(texts, add_special_tokens=False)]


def _plain(added: list[dict]) -> bool:
    """Whether added tokens are found by their string alone, and white space is in none."""
    return not any(t["lstrip"] or t["rstrip"] or t["single_word"] or any(c.isspace() for c in t["content"]) for t in added)


#: What an encoding by words needs of a tokenizer's file: steps that see no further than the next white space.
_BY_WORDS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True,
         "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}


@lru_cache(maxsize=4)
def counts_by_words(path: str) -> bool:
    """Whether a text's count is the sum of the counts of its words between ASCII white space, from the tokenizer's file.

    So it is where white space parts pieces and is dropped: no piece, merge, added token or composed sign reaches over it.
    """
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    return (all(spec.get(k) == v for k, v in _BY_WORDS.items()) and _plain(spec.get("added_tokens", []))
            and model["type"] == "BPE" and not model.get("dropout") and not model.get("unk_token"))


class WordCounter:
    """Counts of texts as the sums of their words' counts; ``whole`` encodes each word a worker has not met, once.

    Texts of which more than half the words are new are encoded whole: a word by itself costs about twice its share of a text.
    """

    def __init__(self, whole: Callable[[list[str]], list[int]]) -> None:
        self.whole = whole
        self.known: dict[bytes, int] = {}
        self.held = 0

    def __call__(self, texts: list[str]) -> list[int]:
        words = [t.encode().split() for t in texts]
        fresh = list(set(chain.from_iterable(words)).difference(self.known))
        if 2 * len(fresh) > sum(map(len, words)):
            return self.whole(texts)
        self.known.update(zip(fresh, self.whole([w.decode() for w in fresh])))
        self.held += sum(map(len, fresh))
        sizes = [sum(map(self.known.__getitem__, ws)) for ws in words]
        if len(self.known) > REMEMBERED or self.held > REMEMBERED_BYTES:
            self.known, self.held = {}, 0
        return sizes


@lru_cache(maxsize=2)
def _counter_of(path: str) -> Callable[[list[str]], list[int]]:
    """The counter of a worker, which keeps the words it has met from task to task."""
    return WordCounter(_counter(path)) if counts_by_words(path) else _counter(path)


def _content_of(path: str) -> Callable[[Column], Column]:
    """The normal form of a text in which contents with equal counts meet, from the tokenizer's file.

    White space folds where the file itself replaces every run of it by a space; ASCII capitals fold where it also
    lower-cases, in ASCII texts without the string of an added token (those are found before any normalising).
    """
    as_is = lambda text: text
    if not path.endswith(".json"):
        return as_is
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers") or [spec.get("normalizer") or {}]
    added = spec.get("added_tokens", [])
    folds = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} and s.get("content") == " " for s in steps)
    if not folds or not _plain(added):
        return as_is

    def content(text: Column) -> Column:
        blank = F.regexp_replace(text, r"[\t-\r ]+", " ")
        if not any(s.get("type") == "Lowercase" for s in steps):
            return blank
        low = F.translate(blank, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        plain = F.octet_length(text) == F.char_length(text)
        for token in added:
            plain = plain & ~F.contains(low, F.lit(token["content"].lower()))
        return F.when(plain, low).otherwise(blank)

    return content


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file and of the library that reads it."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    digest = hashlib.sha256(f"{library} {library_version(library)}\n".encode())
    with open(path, "rb") as f:
        for part in iter(lambda: f.read(1 << 20), b""):
            digest.update(part)
    return digest.hexdigest()


class CountCache:
    """Stored counts: Parquet files in a folder all executors share, split by tokenizer version."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def _there(self) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def counts(self, version: str) -> DataFrame:
        """(content, n_tokens), each content once."""
        if not self._there():
            return self.spark.createDataFrame([], _CACHE).drop("version")
        stored = self.spark.read.schema(_CACHE).parquet(self.folder).filter(F.col("version") == version)
        return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counted: DataFrame, version: str) -> None:
        counted.withColumn("version", F.lit(version)).write.mode("append").partitionBy("version").parquet(self.folder)


def _encode(name: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter_of(SparkFiles.get(name))
        for batch in batches:
            sizes, part, held = [], [], 0
            for text in batch.column(1):
                text = text.as_py() or ""
                if part and held + len(text) > TOGETHER:
                    sizes += count(part)
                    part, held = [], 0
                part.append(text)
                held += len(text)
            sizes += count(part) if part else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], ["content", "n_tokens"])

    return run


def token_counts(docs: DataFrame, path: str, cache: CountCache, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text; ``cache`` gains what it did not hold.

    Defined results: a null text counts as empty, with 0 bytes and 0 tokens; repeated rows and rows that share an id
    each have their own row; an empty table gives no rows and leaves the cache as it is. The tokenizer's file is read
    on the driver and served to the executors.
    """
    spark = docs.sparkSession
    version, content = tokenizer_version(path), _content_of(path)
    texts = columns(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    digest = F.unhex(F.sha2(content(F.col("text")), 256))
    told = cut(texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), digest.alias("content")))
    misses = cut(told.select("content").distinct().join(cache.counts(version), "content", "left_anti"))
    n = misses.count()
    if n:
        named = texts.select(digest.alias("content"), "text")
        if 64 * n <= SENT_BYTES:
            named = named.join(F.broadcast(misses), "content", "left_semi")
        # copies meet in each task before anything is shuffled
        each = named.groupBy("content").agg(F.first("text").alias("text"))
        if 64 * n > SENT_BYTES:
            each = each.join(misses, "content", "left_semi").select("content", "text")
        cache.append(each.mapInArrow(_encode(serve(spark, path)), "content binary, n_tokens long"), version)
    return told.join(cache.counts(version), "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def op12_token_counts(spark, sf_dir):
    """From an empty cache, so that every distinct text of the table is encoded in this run."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    cache = CountCache(spark, f"{shared_folder(spark)}/token-counts-{uuid.uuid4().hex}")
    return token_counts(docs, public_tokenizers.path("word_bpe_49k.json"), cache)
