"""Toxicity: a linear classifier of character n-grams scaled by naive Bayes log-count ratios.

Lower-cased texts are read as runs of 3, 4 and 5 code points, hashed to 2**18 features; a feature is present or not,
however long the text. Its value is the naive Bayes log ratio of its document counts in the two classes; a logistic
regression is fitted on top. Fitting takes a bounded sample of labelled rows (``SAMPLE`` of each class, those with the
least digest of their id); scoring reads every whole text once, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from holdsift.llm.common import columns, table

BITS = 18
SIZES = (3, 4, 5)
#: Labelled rows of each class that fitting takes at most.
SAMPLE = 2000
THRESHOLD = 0.7
#: Entries of the training table that a step of the fit handles at once.
TOGETHER = 1 << 19
_STEP = np.uint32(0x9E3779B1)


class Features:
    """Distinct feature numbers of a text."""

    def __init__(self, bits: int = BITS, sizes: tuple[int, ...] = SIZES) -> None:
        self.shift, self.sizes = np.uint32(32 - bits), sizes
        self.mark = np.zeros(1 << bits, np.int32)

    def of(self, text: str) -> np.ndarray:
        codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le"), np.uint32)
        acc, out = codes, []
        for n in range(2, max(self.sizes) + 1):
            if len(codes) < n:
                break
            acc = acc[:-1] * _STEP + codes[n - 1:]
            if n in self.sizes:
                h = (acc ^ (acc >> np.uint32(15))) * np.uint32(0x85EBCA6B + 2 * n)
                out.append((h ^ (h >> np.uint32(13))) * _STEP >> self.shift)
        if not out:
            return np.zeros(0, np.int32)
        found = np.concatenate(out).astype(np.int32)
        place = np.arange(len(found), dtype=np.int32)
        self.mark[found] = place  # the last of equal numbers stays
        return found[self.mark[found] == place]


def log_ratios(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, smooth: float = 2.0,
               certainty: float = 3.5) -> np.ndarray:
    """Log ratio of document counts in class 1 to class 0; ``smooth`` counts are split by class size.

    Zero where the classes' rates differ by less than ``certainty`` standard errors: most n-grams of a text are rare,
    and their ratios are noise.
    """
    counts = [np.zeros(1 << bits, np.int64) for _ in (0, 1)]
    for r, y in zip(rows, labels):
        if y in (0, 1):
            np.add.at(counts[int(y)], r, 1)
    n = np.array([(labels == 0).sum(), (labels == 1).sum()], float)
    share = n / n.sum()
    rates = [(counts[c] + smooth * share[c]) / (n[c] + smooth * share[c]) for c in (0, 1)]
    pooled = (counts[0] + counts[1]) / n.sum()
    error = np.sqrt(np.maximum(pooled * (1 - pooled), 1e-9) * (1 / n[0] + 1 / n[1]))
    sure = np.abs(counts[1] / n[1] - counts[0] / n[0]) >= certainty * error
    return np.where(sure, np.log(rates[1]) - np.log(rates[0]), 0).astype(np.float32)


def fit(rows: list[np.ndarray], labels: np.ndarray, bits: int = BITS, rounds: int = 150, decay: float = 10.0,
        step: float = 0.02) -> tuple[np.ndarray, float]:
    """Weights per feature and a bias: logistic regression on ratio-scaled presence (full-batch Adam, fixed rounds).

    With one class only, or no rows, the weights are zero and the bias is the smoothed log odds of the class.
    """
    labels = np.asarray(labels)
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    if not ones or not zeros:
        return np.zeros(1 << bits, np.float32), float(np.log((ones + 0.5) / (zeros + 0.5)))
    ratio = log_ratios(rows, labels, bits)
    rows = [r[ratio[r] != 0] for r in rows]
    col = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    parts = [slice(i, i + TOGETHER) for i in range(0, len(col), TOGETHER)]
    balance = np.where(labels == 1, 0.5 / ones, 0.5 / zeros)
    w, bias = np.zeros(1 << bits), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, rounds + 1):
        scaled = w * ratio
        z = sum((np.bincount(row[p], scaled[col[p]], len(rows)) for p in parts), np.zeros(len(rows))) + bias
        slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * balance
        g = sum((np.bincount(col[p], slope[row[p]], 1 << bits) for p in parts), np.zeros(1 << bits)) * ratio + decay / len(rows) * w
        gb = float(slope.sum())
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        a, b = 1 - 0.9**t, 1 - 0.999**t
        w -= step * (m / a) / (np.sqrt(v / b) + 1e-9)
        bias -= step * (mb / a) / (np.sqrt(vb / b) + 1e-9)
    return (w * ratio).astype(np.float32), float(bias)


def held_out(doc_id: Column) -> Column:
    """Never trained on: crc32 of the id as text leaves 1 when divided by 3, or there is no id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Classifier from labelled rows that are not held out; ids labelled more than once take the larger label."""
    known = (
        columns(labels, id=id_col, label=label_col).filter(F.col("label").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max(F.col("label").cast("int")).alias("label"))
    )
    order = (F.md5(F.col("id").cast("string")), F.col("id"))
    chosen = known.filter("label = 0").orderBy(*order).limit(sample).unionByName(
        known.filter("label = 1").orderBy(*order).limit(sample))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = Features()
        for batch in batches:
            rows = [one.of(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.int32()))], ["label", "features"])

    # at most 2 * sample ids: small enough to broadcast by construction
    rows = (
        columns(docs, id=id_col, text=text_col).join(F.broadcast(chosen), "id").select("label", "text")
        .mapInArrow(features, "label int, features array<int>").toArrow()
    )
    known_labels, taken = rows.column("label").to_numpy(), rows.column("features").combine_chunks()
    del rows
    ends = np.concatenate([[0], np.cumsum(pc.list_value_length(taken).to_numpy())]).astype(int) if len(taken) else [0]
    flat = pc.list_flatten(taken).to_numpy() if len(taken) else np.zeros(0, np.int32)
    return fit([flat[ends[i]: ends[i + 1]] for i in range(len(taken))], known_labels)


def with_score(docs: DataFrame, model: tuple[np.ndarray, float], text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of each whole text. A null text is scored as empty."""
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # 2**BITS numbers, whatever the corpus
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, w = Features(), shared.value
        for batch in batches:
            z = np.array([w[one.of(t.as_py() or "")].sum(dtype=np.float64) for t in batch.column(at)], float) + bias
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    Defined results: null and empty texts get the classifier's bias as score; null ids are scored and held out;
    repeated rows score alike; without labels of both classes the score is the class share; no rows in, none out.
    """
    model = train(docs, labels, id_col, text_col, label_col)
    scored = with_score(columns(docs, doc_id=id_col, text=text_col), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, their columns unchanged."""
    scored = with_score(docs, train(docs, labels, id_col, text_col, label_col), text_col, "__score")
    return scored.filter(F.col("__score") < threshold).drop("__score")


def op6_toxicity(spark, sf_dir):
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
