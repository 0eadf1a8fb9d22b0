"""MinHash near-duplicate documents: one-permutation hashing with optimal densification, bands, stars.

A document is its set of distinct five-word shingles. One hash per shingle fills ``BANDS * ROWS`` bins with the least
hash falling into each (one permutation, whatever the number of bins); an empty bin takes the value of the first
filled bin in its own fixed random order of bins (optimal densification). Runs of ``ROWS`` bins are buckets. Documents
with equal sets are one class first; classes meet in buckets and are linked exactly by ``links.similar_components``.

Classes, buckets and links are DataFrame work; only the hashing of texts runs in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdsift.llm import textkernel as tk
from holdsift.llm.common import columns, cut, table
from holdsift.llm.links import similar_components

WIDTH = 5
PERCENT = 85
#: At 85 % similarity a pair misses all buckets with probability (1 - 0.85**9)**32 = 0.0002.
BANDS, ROWS = 32, 9


class Sketcher:
    """Least hash per bin, densified, as one 64-bit bucket per band."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 7) -> None:
        k = bands * rows
        self.bands, self.rows, self.bins = bands, rows, k
        self.edges = np.array([(i << 64) // k for i in range(k)], np.uint64)
        self.order = np.random.default_rng(seed).permuted(np.tile(np.arange(k), (k, 1)), axis=1)
        self.rank = np.argsort(self.order, axis=1).astype(np.int32)  # rank[j, b]: when bin j would ask bin b
        self.salt = tk.mix64(np.arange(1, bands + 1, dtype=np.uint64))

    def buckets(self, hashes: np.ndarray) -> np.ndarray:
        """``hashes``: distinct, ascending, at least one."""
        at = np.searchsorted(hashes, self.edges)
        filled = at < np.append(at[1:], len(hashes))
        donor = np.arange(self.bins)
        if not filled.all():
            have, lack = np.flatnonzero(filled), np.flatnonzero(~filled)
            donor[lack] = have[np.argmin(self.rank[np.ix_(lack, have)], axis=1)]
        value = hashes[at[donor]].reshape(self.bands, self.rows)
        acc = self.salt.copy()
        for r in range(self.rows):
            acc = tk.mix64(acc * np.uint64(0xD1342543DE82EF95) + value[:, r])
        return acc.view(np.int64)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> Iterator[np.ndarray]:
    """Per row the ascending distinct shingle hashes; the whole sequence as one where words are fewer."""
    for _, _, data, offsets in tk.stretches(column):
        words = tk.Words(data, offsets, lower=True)
        hashes, first = words.windows(width)
        for i in range(len(offsets) - 1):
            if first[i + 1] > first[i]:
                yield np.unique(hashes[first[i]: first[i + 1]])
            elif words.first[i + 1] > words.first[i]:
                yield np.array([tk.sequence_hash(words.hash[words.first[i]: words.first[i + 1]])], np.uint64)
            else:
                yield np.zeros(0, np.uint64)


def _sketches(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher = Sketcher(bands, rows)
        for batch in batches:
            n, one, two, buckets = [], [], [], []
            for s in shingle_sets(batch.column(1), width):
                n.append(len(s))
                one.append(int(np.bitwise_xor.reduce(s).view(np.int64)) if len(s) else 0)
                two.append(int(tk.mix64(s + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                buckets.append(sketcher.buckets(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                 pa.array(two, pa.int64()), pa.array(buckets, pa.list_(pa.int64()))],
                ["id", "n", "one", "two", "buckets"])

    return run


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.view(np.int64) for s in shingle_sets(batch.column(1), width)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(sets, pa.list_(pa.int64()))], ["id", "n", "items"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), a row per document; ids are whole numbers.

    Defined results: a null, empty or wordless text has an empty set and is linked with nothing; a text with fewer
    words than ``width`` has its whole word sequence as one shingle; documents with equal sets are always linked;
    rows that share an id are one document, whose links are those of all its rows; a null id is linked with nothing
    and kept; an empty table gives no rows.
    """
    texts = columns(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))
    sketches = cut(texts.mapInArrow(
        _sketches(width, bands, rows), "id long, n long, one long, two long, buckets array<long>"))
    linkable = sketches.filter("n > 0 and id is not null")
    classes = cut(linkable.groupBy("one", "two", "n").agg(F.min("id").alias("class")))
    member = cut(linkable.select("id", "one", "two", "n").join(classes, ["one", "two", "n"]).select("id", "class", "n").distinct())
    reps = member.filter("id = class").select("id", "n")
    buckets = linkable.join(reps, ["id", "n"], "left_semi").select("id", F.explode("buckets").alias("bucket"))

    def sets_of(ids: DataFrame) -> DataFrame:
        chosen = texts.join(ids, "id", "left_semi").mapInArrow(_sets(width), "id long, n long, items array<long>")
        return chosen.filter("n > 0").select("id", "items")

    # rows that share an id tie their classes together
    ties = member.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("b")).filter("a <> b").select("a", "b")
    found = similar_components(buckets, sets_of, percent, known=ties)
    component = (
        member.groupBy("id").agg(F.min("class").alias("class"))
        .join(found.select(F.col("id").alias("class"), "component"), "class", "left")
        .select("id", F.coalesce("component", "class").alias("component"))
    )
    return (
        sketches.select("id", "n").join(component, "id", "left")
        .select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                F.coalesce("component", "id").alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def op4_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), least AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least ON least.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""
