"""The Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from holdsift.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, rank string, total string, leaf int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*fields):
    told = ["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields]
    return sha(*told)


def climb(nodes, fanout):
    """Root and, per leaf, its (before, after) siblings level by level."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = nodes[i - i % fanout: i - i % fanout + fanout]
            proofs[k].append(("".join(run[: i % fanout]), "".join(run[i % fanout + 1:])))
        at = [i // fanout for i in at]
        nodes = [sha(*nodes[i: i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], proofs


def plain(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    own = {}
    for g in names:
        leaves = sorted(((r[0] is not None, r[0] or 0, plain_leaf(*r[:5])) for r in groups[g]))
        own[g] = (leaves, *climb([x[2] for x in leaves], fanout))
    root, tops = climb([own[g][1] for g in names], fanout)
    out = []
    for g, top in zip(names, tops):
        leaves, subroot, proofs = own[g]
        out += [(doc if there else None, g, leaf, subroot, root, tuple(p + top)) for (there, doc, leaf), p in zip(leaves, proofs)]
    return sorted(out, key=repr)


def rows_of(n, seed, langs):
    rng = random.Random(seed)
    rows = [(rng.randrange(10**6), rng.choice(["a", None]), rng.choice(langs), rng.choice([None, 0, 7]),
             rng.choice([None, "", "word é\n" * rng.randrange(5), "x"]), "k", "r", "t", 1) for _ in range(n)]
    return rows + [(None, None, None, None, None, "k", "r", "t", 1), (5, "a", "en", 1, "t", "k", "r", "t", 1),
                   (5, "a", "en", 1, "t", "k", "r", "t", 1), (5, "b", "en", 1, "t", "k", "r", "t", 1)]


@pytest.mark.parametrize("n,fanout,block,langs", [
    (90, 2, 4, ["en"] * 6 + ["fr", None, "", "é"]), (40, 3, 9, ["en", "de"]), (150, 2, 256, [None]), (70, 5, 5, ["en", "en", "z"])])
def test_manifest_equals_a_plain_tree(spark, n, fanout, block, langs):
    rows = rows_of(n, n, langs)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = merkle.manifest(df, fanout=fanout, block=block, carry={"chars": F.col("n_chars")})
    assert got.columns == ["doc_id", "group", "rank", "leaf", "subroot", "root", "proof", "chars"]
    digests = got.select("leaf", "root", merkle.folded(F.col("leaf"), F.col("proof")).alias("again"),
                         merkle.proof_digest(F.col("proof")).alias("told"), "proof").collect()
    assert all(r.again == r.root for r in digests)
    assert all(r.told == sha("".join(s.before.hex() + s.after.hex() for s in r.proof)) for r in digests)
    found = sorted(((r.doc_id, r.group, r.leaf, r.subroot, r.root, tuple((s.before.hex(), s.after.hex()) for s in r.proof))
                    for r in got.collect()), key=repr)
    assert found == plain(rows, fanout)


def test_lone_leaf_lone_group_and_empty_table(spark):
    one = spark.createDataFrame([(3, "s", "en", 4, "text", "k", "r", "t", 1)], SCHEMA)
    r = merkle.manifest(one).first()
    assert r.leaf == r.subroot == r.root == plain_leaf(3, "s", "en", 4, "text") and r.proof == []
    assert merkle.manifest(one.limit(0)).count() == 0


def test_query_finds_what_was_tampered_with(spark, sf):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = merkle.op13_merkle(spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        touched = zlib.crc32(str(r.doc_id).encode()) % 7 == 0
        assert r.verified == (not touched or docs[r.doc_id].n_chars is None) == (r.folded_root == r.root)
