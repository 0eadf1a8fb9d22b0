"""Merkle manifest of a dataset by nested-interval labels: leaves, subroots, root and a proof for every row.

Rows of a group (a language) are leaves in order of id. Every node carries the interval ``[lo, hi)`` of the leaf ranks
it covers; a level's nodes cover runs of ``fanout**level`` ranks, the last one fewer. From that all else follows:

* Ancestors: a node is an ancestor where its interval holds the leaf's. The join meets only nodes of the same level and
  the same slot (``lo div fanout**level``), so it is an equi-join with the containment as its condition.
* Siblings: the children of a parent whose intervals lie outside the one that is climbed from, before it or after it.

Levels go up in bands, and bands keep every key small. The nodes of a band hang on at most ``BLOCK`` nodes of its lowest
level, so its upper nodes have at most that many descendants *in the band*; a band's lowest nodes get their steps up to
its top, and the rest of the way is handed down from the band above, once per block. No join has a key with more than
``BLOCK`` rows, however many leaves lie below one node. The groups' subroots are leaves of a last tree of the same kind.

Ranks come from ranges of (group, id) and counts per range, so no group is ever sorted in one task.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdsift.llm.common import cut, table

FANOUT = 2
#: Lowest nodes below one top node of a band.
BLOCK = 256
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<level:int,before:binary,after:binary>>"


def leaf_hash(*fields: Column) -> Column:
    """Digest of a row: each field ``-`` if null, else its UTF-8 length, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told), 256)


def hexed(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf (hex) and the siblings of its proof give."""
    return F.aggregate(proof, leaf, lambda h, s: F.sha2(F.concat(hexed(s["before"]), h, hexed(s["after"])), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, level by level, left to right; of nothing where there are none."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(hexed(s["before"]), hexed(s["after"]))), ""), 256)


def ranked(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, within the key by ``order``) and the key's ``total``; the key is not null.

    Only (range, key) counts meet in a window; a key that holds most rows is spread over many ranges.
    """
    by = [F.col(key), *(F.col(c).asc_nulls_first() for c in order)]
    spread = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    placed = cut(spread.withColumn("__range", F.spark_partition_id()).withColumn("__seq", F.monotonically_increasing_id()))
    before = Window.partitionBy(key).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy("__range", key).agg(F.min("__seq").alias("__first"), F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn("total", F.sum("__n").over(Window.partitionBy(key)))
    )
    return (
        placed.join(runs, ["__range", key])
        .withColumn("rank", F.col("__before") + F.col("__seq") - F.col("__first"))
        .drop("__range", "__seq", "__first", "__n", "__before")
    )


def _parents(children: Column, level: int, fanout: int, total: Column) -> Column:
    """The nodes above a block's nodes of one level; none where the level below has only one node left."""

    def parent(i: Column) -> Column:
        own = F.slice(children, i * fanout + 1, fanout)
        digest = F.unhex(F.sha2(F.array_join(F.transform(own, lambda c: hexed(c["digest"])), ""), 256))
        return F.struct(F.lit(level).alias("level"), own[0]["lo"].alias("lo"), F.element_at(own, -1)["hi"].alias("hi"),
                        digest.alias("digest"), F.transform(own, lambda c: F.struct(
                            c["lo"].alias("lo"), c["hi"].alias("hi"), c["digest"].alias("digest"))).alias("children"))

    runs = F.sequence(F.lit(0), F.ceil(F.size(children) / fanout).cast("int") - 1)
    return F.when((F.size(children) > 0) & (F.lit(fanout ** (level - 1)) < total), F.transform(runs, parent)).otherwise(
        F.transform(F.slice(F.sequence(F.lit(0), F.lit(0)), 1, 0), parent))


class Tree:
    """The trees over ``leaves`` (key, rank, total, digest: binary), one per key, as a table of nodes for each band."""

    def __init__(self, leaves: DataFrame, fanout: int = FANOUT, block: int = BLOCK) -> None:
        if fanout < 2:
            raise ValueError("fanout must be 2 at least")
        self.fanout = fanout
        self.height = max(1, int(math.log(block, fanout) + 1e-9))
        base = leaves.select("key", "total", F.col("rank").alias("lo"), (F.col("rank") + 1).alias("hi"), "digest")
        largest = base.agg(F.max("total")).first()[0] or 0
        self.bands: list[tuple[int, DataFrame, DataFrame]] = []  # lowest level, lowest nodes, nodes above them
        roots = [base]
        low = 0
        while low == 0 or fanout**low < largest:
            nodes = cut(self._grown(base, low))
            self.bands.append((low, base, nodes))
            above = nodes.select("key", "total", "level", "lo", "hi", "digest")
            roots.append(above.drop("level"))
            low += self.height
            base = above.filter((F.col("level") == low) & (F.lit(fanout**low) < F.col("total"))).drop("level")
        # one node of a tree covers all its leaves
        self.roots = cut(reduce(DataFrame.unionByName, roots).filter("lo = 0 and hi = total").select("key", "total", "digest"))

    def _grown(self, base: DataFrame, low: int) -> DataFrame:
        width = self.fanout ** (low + self.height)
        rows = base.groupBy("key", "total", F.expr(f"lo div {width}").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("lo", "hi", "digest"))).alias("l0"))
        for i in range(1, self.height + 1):
            rows = rows.withColumn(f"l{i}", _parents(F.col(f"l{i - 1}"), low + i, self.fanout, F.col("total")))
        grown = F.concat(*(f"l{i}" for i in range(1, self.height + 1)))
        return rows.select("key", "total", F.explode(grown).alias("node")).select("key", "total", "node.*")

    def _steps(self, low: int, base: DataFrame, nodes: DataFrame) -> DataFrame:
        """(key, lo, total, steps) of a band's lowest nodes: the siblings on the way to the band's top."""
        levels = F.array(*(F.struct(F.lit(low + i).alias("level"), F.lit(self.fanout ** (low + i)).cast("long").alias("width"))
                           for i in range(1, self.height + 1)))
        there = F.filter(levels, lambda s: s["width"] / self.fanout < F.col("total"))
        climbing = (
            base.select("key", "total", "lo", "hi", F.explode_outer(there).alias("up"))
            .select("key", "total", "lo", "hi", F.col("up.level").alias("level"), F.expr("lo div up.width").alias("slot"))
        )
        width = F.element_at(F.create_map(*(x for i in range(1, self.height + 1) for x in (
            F.lit(low + i), F.lit(self.fanout ** (low + i)).cast("long")))), F.col("level"))
        above = nodes.withColumn("width", width).select(
            F.col("key").alias("k"), F.col("level").alias("at"), F.expr("lo div width").alias("place"),
            F.col("lo").alias("from"), F.col("hi").alias("to"), "children")
        held = climbing.join(
            above, (F.col("key") == F.col("k")) & (F.col("level") == F.col("at")) & (F.col("slot") == F.col("place"))
            & (F.col("from") <= F.col("lo")) & (F.col("hi") <= F.col("to")), "left")
        # the parent's interval without the child's leaves the siblings' intervals, on either side
        side = lambda outside: F.aggregate(
            F.filter("children", outside), F.lit(b""), lambda all_, c: F.concat(all_, c["digest"]))
        step = F.when(F.col("at").isNotNull(), F.struct(
            "level", side(lambda c: c["hi"] <= F.col("lo")).alias("before"), side(lambda c: c["lo"] >= F.col("hi")).alias("after")))
        return (
            held.select("key", "lo", "total", step.alias("step"))
            .groupBy("key", "lo", "total").agg(F.sort_array(F.collect_list("step")).cast(_STEPS).alias("steps"))
        )

    def paths(self, tops: DataFrame, leaves: DataFrame | None = None) -> DataFrame:
        """(key, rank, path and ``tops``' other columns) of every leaf, with the columns of ``leaves``.

        ``tops``: (key, path, ...), the way on from each tree's root. Every band takes it from the band above it, or
        from ``tops`` where the tree ends in it.
        """
        tops = tops.join(self.roots.select("key", "total"), "key")
        rest = [c for c in tops.columns if c not in ("key", "path", "total")]
        handed = None
        for low, base, nodes in reversed(self.bands):
            width = self.fanout ** (low + self.height)
            ends = (F.col("total") <= F.lit(width)) & ((F.col("total") > F.lit(self.fanout**low)) if low else F.lit(True))
            upper = tops.filter(ends).select("key", F.lit(0).cast("long").alias("block"), "path", *rest)
            if handed is not None:
                upper = upper.unionByName(handed)
            steps = self._steps(low, base, nodes)
            if not low and leaves is not None:
                own = leaves.drop("total").withColumnRenamed("rank", "lo")
                steps = steps.join(own, ["key", "lo"])
            more = [c for c in steps.columns if c not in ("key", "lo", "total", "steps")]
            joined = steps.withColumn("block", F.expr(f"lo div {width}")).join(upper, ["key", "block"])
            out = joined.select("key", "lo", F.concat("steps", "path").alias("path"), *rest, *more)
            if low:
                handed = cut(out.select("key", F.expr(f"lo div {self.fanout**low}").alias("block"), "path", *rest))
        return out.withColumnRenamed("lo", "rank")


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
             fanout: int = FANOUT, block: int = BLOCK, carry: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, group, rank, leaf, subroot, root, proof, and ``carry``'s columns), a row per row of ``docs``.

    ``proof`` lists per level the digests of the siblings before and after, from the leaf via the subroot to the root;
    ``folded`` gives the root back, ``proof_digest`` its digest.

    Defined results: null fields count as ``-``, an empty text as ``0:``; rows without a group are a group of their own,
    the first, rows without an id come first in theirs; rows that share an id go by leaf digest (rows equal in all fields
    are interchangeable); a group of one row has its leaf as subroot, one group has its subroot as root; a last run of
    one node is hashed by itself; an empty table gives no rows.
    """
    group = F.col(group_col).cast("string")
    leaves = cut(docs.select(
        F.col(id_col).alias("doc_id"), F.col(group_col).alias("group"),
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("key"),  # null first, then by code point
        leaf_hash(*(F.col(f) for f in fields)).alias("leaf"),
        *(c.alias(name) for name, c in (carry or {}).items()), F.monotonically_increasing_id().alias("__tie")))
    leaves = cut(ranked(leaves, "key", "doc_id", "leaf", "__tie").drop("__tie"))
    tree = Tree(leaves.select("key", "rank", "total", F.unhex("leaf").alias("digest")), fanout, block)
    groups = tree.roots.select(F.lit("").alias("all"), F.col("key").alias("group_key"), F.col("digest").alias("subroot"))
    groups = cut(ranked(groups, "all", "group_key").withColumnRenamed("all", "key"))
    last = Tree(groups.select("key", "rank", "total", F.col("subroot").alias("digest")), fanout, block)
    tops = last.roots.select("key", F.array().cast(_STEPS).alias("path"), F.col("digest").alias("root"))
    tops = last.paths(tops, groups).select(F.col("group_key").alias("key"), "path", "subroot", "root")
    found = tree.paths(cut(tops), leaves)
    return found.select("doc_id", "group", "rank", "leaf", hexed(F.col("subroot")).alias("subroot"),
                        hexed(F.col("root")).alias("root"), F.col("path").alias("proof"), *(carry or {}))


def op13_merkle(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = F.when(changed, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    tampered = F.when(changed, leaf_hash(*(more if f == "n_chars" else F.col(f) for f in FIELDS)))
    return (
        manifest(docs, carry={"tampered": tampered})
        .withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("proof")))
        .select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                (F.col("folded_root") == F.col("root")).alias("verified"))
    )


_CRC = """list_reduce(
    flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, 4294967295::BIGINT)"""

_H = "sha256(concat({}))".format(", ".join(
    f"CASE WHEN {f} IS NULL THEN '-' ELSE concat(strlen(CAST({f} AS VARCHAR)), ':', CAST({f} AS VARCHAR)) END" for f in FIELDS))

SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS k, {_H} AS leaf,
         {_H.replace("n_chars", "(n_chars + 1)")} AS other, xor({_CRC}, 4294967295::BIGINT) % 7 = 0 AS changed FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY k) AS total FROM leaves
), tree AS (
  SELECT k, 0 AS level, i, leaf AS h, total AS m FROM placed
  UNION ALL
  SELECT k, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (m + 1) // 2 FROM tree WHERE m > 1 GROUP BY k, level, i // 2, m
), subroots AS (
  SELECT k, h AS subroot, level AS height, row_number() OVER (ORDER BY k) - 1 AS j, count(*) OVER () AS groups FROM tree WHERE m = 1
), upper_tree AS (
  SELECT 0 AS level, j, subroot AS h, groups AS m FROM subroots
  UNION ALL
  SELECT level + 1, j // 2, sha256(string_agg(h, '' ORDER BY j)), (m + 1) // 2 FROM upper_tree WHERE m > 1 GROUP BY level, j // 2, m
), root AS (
  SELECT h AS root, level AS height FROM upper_tree WHERE m = 1
), nodes AS (
  SELECT k, level, i, h FROM tree WHERE m > 1
  UNION ALL
  SELECT s.k, s.height + u.level, u.j, u.h FROM subroots s CROSS JOIN upper_tree u WHERE u.m > 1
), climb AS (
  SELECT p.k, p.i AS leaf_rank, CASE WHEN changed THEN other ELSE leaf END AS h, 0 AS level, '' AS proof,
         s.height, s.j, r.height AS top FROM placed p JOIN subroots s ON s.k = p.k CROSS JOIN root r
  UNION ALL
  SELECT c.k, c.leaf_rank,
         sha256(CASE WHEN n.h IS NULL THEN c.h
                     WHEN (CASE WHEN c.level < c.height THEN c.leaf_rank >> c.level ELSE c.j >> (c.level - c.height) END) % 2 = 0
                     THEN c.h || n.h ELSE n.h || c.h END),
         c.level + 1, c.proof || coalesce(n.h, ''), c.height, c.j, c.top
  FROM climb c LEFT JOIN nodes n ON n.k = c.k AND n.level = c.level
   AND n.i = xor((CASE WHEN c.level < c.height THEN c.leaf_rank >> c.level ELSE c.j >> (c.level - c.height) END)::BIGINT, 1::BIGINT)
  WHERE c.level < c.height + c.top
)
SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = r.root AS verified
FROM placed p JOIN subroots s ON s.k = p.k CROSS JOIN root r
JOIN climb c ON c.k = p.k AND c.leaf_rank = p.i AND c.level = c.height + c.top
"""
