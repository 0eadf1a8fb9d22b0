"""Document fingerprints by winnowing, and their likeness to an edited text and to the next document.

A rolling hash of every ``GRAM`` code points; of every ``WINDOW`` neighbouring hashes the least is chosen, the rightmost
of equal ones, and kept with its position. Two texts that share ``GRAM + WINDOW - 1`` code points in a row therefore
share a fingerprint, wherever the passage stands; nothing shorter than ``GRAM`` matches.

The next document by id is found without sorting all texts in one task: ids alone give the cut points of many ranges;
each text goes to its range, and the first text of a range goes to the range before as well. One shuffle of the texts,
then each range is read in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdsift.llm import textkernel as tk
from holdsift.llm.common import columns, table

GRAM = 30
WINDOW = 71
#: Ranges for each shuffle partition of the session.
RANGES = 4


def gram_hashes(codes: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """32-bit hash of every run of ``gram`` code points, each from the one before; one of the whole if it is shorter."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.uint32)
    width = min(gram, n)
    up, down = tk._POWERS.upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(tk.mix64(codes.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    rolled = (total[width:] - total[:-width]) * down[: n - width + 1]
    return (tk.mix64(rolled + np.uint64(width)) >> np.uint64(32)).astype(np.uint32)


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Ascending positions of the chosen hashes."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    # hash above, distance from the end below: the least is the least hash, the rightmost of equals
    key = hashes.astype(np.uint64) << np.uint64(32) | np.arange(n - 1, -1, -1, dtype=np.uint64)
    width, reach = min(window, n), 1
    while 2 * reach <= width:
        key = np.minimum(key[:-reach], key[reach:])
        reach *= 2
    if reach < width:
        key = np.minimum(key[: len(key) - (width - reach)], key[width - reach:])
    return np.unique(n - 1 - (key & np.uint64(0xFFFFFFFF)).astype(np.int64))


class Print:
    """Fingerprint of a text: chosen hashes and their positions."""

    def __init__(self, text: str, gram: int = GRAM, window: int = WINDOW) -> None:
        hashes = gram_hashes(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), gram)
        self.at = winnow(hashes, window)
        self.hashes = hashes[self.at]
        self.distinct = np.unique(self.hashes)

    def __str__(self) -> str:
        return ",".join([f"{h:08x}@{p}" for h, p in zip(self.hashes.tolist(), self.at.tolist())])

    def likeness(self, other: Print) -> float:
        """Shared part of the distinct hashes of both; 1 for two empty fingerprints."""
        both = len(np.intersect1d(self.distinct, other.distinct, assume_unique=True))
        either = len(self.distinct) + len(other.distinct) - both
        return both / either if either else 1.0


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by as many first ones of the following text, or all."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
_NAMES = [c.strip().split(" ")[0] for c in _OUT.split(",")]


def _compare(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by range, marks of following texts last: each row is answered when its follower is seen."""
        waiting = None  # (range, id, text, fingerprint) of the row before
        for batch in batches:
            out = []
            for span, tail, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                text = text or ""
                mark = Print(text, gram, window)
                if waiting and waiting[0] == span:
                    _, before, own, own_mark = waiting
                    new = edited(own, text)
                    new_mark = Print(new, gram, window)
                    digest = hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((before, len(own), digest, str(own_mark), str(new_mark), own_mark.likeness(new_mark), own_mark.likeness(mark)))
                waiting = None if tail else (span, doc, text, mark)
            columns_out = list(zip(*out)) or [()] * len(_NAMES)
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns_out, kinds)], _NAMES)

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gram: int = GRAM,
                 window: int = WINDOW) -> DataFrame:
    """Fingerprints of each text and of its edited text, with their likeness, and that to the next document's.

    Defined results: null and empty texts have an empty fingerprint, and two empty ones have likeness 1; a text
    shorter than a gram has one hash, of the whole; rows that share an id follow each other in order of their texts;
    rows without an id come before all others; a lone row follows itself; an empty table gives no rows.
    """
    texts = columns(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    texts = texts.withColumn("place", F.coalesce("doc_id", F.lit(-(2**63))))
    spark = docs.sparkSession
    n = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = texts.agg(F.min("place"), F.percentile_approx("place", [i / n for i in range(1, n)], 20 * n)).first()
    starts = np.unique(np.array([cuts[0], *(cuts[1] or [])], np.int64)) if cuts[0] is not None else np.zeros(1, np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """To each row its range; the rows of a range's first id go to the range before too, as its tail."""
        for batch in batches:
            place = batch.column(2).to_numpy()
            span = np.searchsorted(starts, place, "right") - 1
            again = np.flatnonzero(starts[span] == place)
            rows = np.concatenate([np.arange(len(place)), again])
            dealt = np.concatenate([span, (span[again] - 1) % len(starts)])
            tail = np.concatenate([np.zeros(len(place), bool), np.ones(len(again), bool)])
            picked = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(dealt, pa.int64()), pa.array(tail), picked.column(0), picked.column(1)],
                ["span", "tail", "doc_id", "text"])

    return (
        texts.mapInArrow(deal, "span long, tail boolean, doc_id long, text string")
        .repartition("span").sortWithinPartitions("span", "tail", F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(_compare(gram, window), _OUT)
    )


def op7_fingerprints(spark, sf_dir):
    return fingerprints(table(spark, sf_dir, "documents"))
