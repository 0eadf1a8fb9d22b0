"""Hashes of files above a piece: handed on from task to task, equal to those of the whole bytes."""

import hashlib
import random

import pytest

from holdsift.functions import sha256
from holdsift.sources import files

PIECE = 4096


def test_state_is_handed_on():
    data = random.Random(1).randbytes(1000)
    first = sha256.Sha256()
    first.update(data[:333])
    second = sha256.Sha256(first.state)
    second.update(data[333:])
    assert second.hexdigest() == hashlib.sha256(data).hexdigest()


@pytest.fixture
def small_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(PIECE))
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_large_files_by_pieces(spark, tmp_path, small_splits, monkeypatch):
    rng = random.Random(2)
    given = {
        "random bytes.parquet": rng.randbytes(9 * PIECE + 17),
        "ends.bin": rng.randbytes(5 * PIECE) + b"\n",
        "ends twice.bin": rng.randbytes(3 * PIECE) + b"\n\n",
        "returns.csv": b"a\r\nb\rc\n" * 2000,
        "marked.csv": b"\xef\xbb\xbf" + b"k,v\n" * 3000,
        "marked open.csv": b"\xef\xbb\xbf" + b"k,v\n" * 3000 + b"k",
        "one line.txt": b"x" * (4 * PIECE),
        "breaks.txt": b"\n" * (2 * PIECE + 1),
        "marks.txt": b"\xef\xbb\xbf\n" * 3000,
        "packed.gz": rng.randbytes(2 * PIECE),
        "exact.bin": rng.randbytes(PIECE),
        "small.pdf": b"bytes",
    }
    (tmp_path / "sub").mkdir()
    for i, (name, data) in enumerate(given.items()):
        (tmp_path / ("sub" if i % 2 else ".") / name).write_bytes(data)
    rounds = []
    kept = files.checkpointed
    monkeypatch.setattr(files, "checkpointed", lambda df: rounds.append(1) or kept(df))
    got = files.landed_files(spark, str(tmp_path), piece=PIECE).collect()
    assert len(rounds) > 9  # no task hashed the largest file by itself
    assert {r["path"].rsplit("/", 1)[1]: r["file_size_bytes"] for r in got} == {
        n: len(d) for n, d in given.items()}
    assert {r["path"].rsplit("/", 1)[1]: r["file_hash_sha256"] for r in got} == {
        n: hashlib.sha256(d).hexdigest() for n, d in given.items()}
