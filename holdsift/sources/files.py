"""Landed files as rows: size, byte hash, content-addressed path, integrity."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift.functions import sha256
from holdsift.functions.urls import content_path, extension
from holdsift.session import checkpointed, shared_work, ship

#: Files above this many bytes are hashed piece by piece, so that no task reads a whole one.
PIECE = 128 << 20
#: Bytes in a row of a staged piece.
_CHUNK = 16 << 10
#: Names that Spark's text reader would unpack; such files are hashed whole.
_PACKED = r"(?i)\.(gz|bz2|deflate|lz4|snappy|zst|lzo)$"
_BOM = b"\xef\xbb\xbf"


def _reader(spark: SparkSession, form: str, glob: str | None, **options):
    reader = spark.read.format(form).options(recursiveFileLookup="true", **options)
    return reader.option("pathGlobFilter", glob) if glob else reader


def landed_files(spark: SparkSession, path: str, glob: str | None = None, piece: int = PIECE) -> DataFrame:
    """path, filename, file_type, size, SHA-256 of the bytes; the bytes themselves are dropped.

    A file of up to ``piece`` bytes is hashed whole in one task. The hash of a larger one goes through its bytes in
    order, so it is handed from task to task: see ``_relayed``. ``piece`` should not be below the size of a read split.
    """
    files = _reader(spark, "binaryFile", glob).load(path)
    whole = files.select("path", "length", F.sha2("content", 256).alias("hash"))
    if sha256.available():
        packed = F.col("_metadata.file_name").rlike(_PACKED)
        large = files.filter(F.col("length") > piece).select(
            "path", "length", F.col("_metadata.file_path").alias("file"), packed.alias("packed"))
        found = large.groupBy("packed").agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()
        hashed = whole.filter(F.col("length") <= piece)
        for kind in found:
            if kind["packed"]:
                more = files.filter(packed & (F.col("length") > piece)).select("path", "length", F.sha2("content", 256).alias("hash"))
            else:
                lines = _reader(spark, "text", glob, lineSep="\n").load(path).filter(
                    (F.col("_metadata.file_size") > piece) & ~packed
                ).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.col("value").cast("binary").alias("line"))
                more = _relayed(large.filter("not packed"), lines, piece, kind["n"], kind["longest"])
            hashed = hashed.unionByName(more)
    else:
        hashed = whole
    name = F.element_at(F.split("path", "/"), -1)
    return hashed.select(
        "path",
        name.alias("filename"),
        extension(name).alias("file_type"),
        F.col("length").alias("file_size_bytes"),
        F.col("hash").alias("file_hash_sha256"),
    )


def _chunks(batches) -> Iterator:
    """Lines of read splits, in order, to (file, block, seq, size, bytes) with the line ends put back."""
    import pyarrow as pa

    at, seq, held = None, 0, bytearray()

    def rows(least: int):
        nonlocal seq
        out = []
        while len(held) > least:
            data = bytes(held[:_CHUNK])
            del held[:_CHUNK]
            out.append((*at, seq, len(data), data))
            seq += 1
        if out:
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                             ["file", "block", "seq", "size", "bytes"])

    for batch in batches:
        files, blocks, lines = (batch.column(i).to_pylist() for i in range(3))
        a = 0
        while a < len(lines):
            here, b = (files[a], blocks[a]), a + 1
            while b < len(lines) and blocks[b] == here[1] and files[b] == here[0]:
                b += 1
            if here != at:
                yield from rows(0)
                at, seq = here, 0
            # some lines at a time, so that what is held stays small
            for i in range(a, b, 256):
                held += b"\n".join(lines[i: min(i + 256, b)]) + b"\n"
                if len(held) > 64 * _CHUNK:
                    yield from rows(_CHUNK)
            a = b
    yield from rows(0)


def _hash_on(batches) -> Iterator:
    """Per file the state before (block -1) and the chunks that follow, in order, to the state after them.

    ``bytes`` of a state holds the hash's state and, held back, the last byte; nothing at a file's start.
    """
    import pyarrow as pa

    now = hashing = None
    over, last = 0, b""

    def done():
        return pa.RecordBatch.from_arrays(
            [pa.array([now], pa.string()), pa.array([over], pa.int64()), pa.array([hashing.state + last], pa.binary())],
            ["file", "over", "state"])

    for batch in batches:
        for file, block, seq, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if block < 0:
                if now is not None:
                    yield done()
                now, over = file, seq
                if over not in (0, 1, -3, -2):
                    raise ValueError(f"{over} bytes more than {file} has were read")
                hashing, last = sha256.Sha256(data[:sha256.STATE] or None), data[sha256.STATE:]
                if not data and over < 0:
                    hashing.update(_BOM)
                continue
            hashing.update(last)
            hashing.update(data[:-1])
            last = data[-1:]
    if now is not None:
        yield done()


def _relayed(large: DataFrame, lines: DataFrame, piece: int, n: int, longest: int) -> DataFrame:
    """(path, length, hash) of the files ``large`` (path, length, file), whose ``lines`` are (file, block, line).

    Read splits cut a file at line ends; the text reader keeps all other bytes as they are, but for a byte order mark at
    the start, and does not tell whether the last line ended. The file's length tells both. The bytes are staged by
    piece; then a round for each piece hashes on from the state that the round before left, for all files at once. A task
    reads one piece of a file, bytes are read once and staged once, and no file comes together in one place.
    """
    spark = ship(lines.sparkSession)
    place = f"{shared_work(spark)}/pieces"
    form = "file string, block long, seq long, size long, bytes binary"
    (
        lines.mapInArrow(_chunks, form).withColumn("round", F.floor(F.col("block") / piece).cast("long"))
        .write.partitionBy("round").option("compression", "none").option("parquet.enable.dictionary", "false").parquet(place)
    )
    staged = spark.read.schema(f"{form}, round long").parquet(place)
    sizes = staged.groupBy("file").agg(F.sum("size").alias("read"))
    states = checkpointed(large.join(sizes, "file").select(
        "file", (F.col("read") - F.col("length")).alias("over"), F.lit(b"").alias("state")))
    for k in range(longest // piece + 1):
        rows = staged.filter(F.col("round") == k).select("file", "block", "seq", "bytes").unionByName(states.select(
            "file", F.lit(-1).cast("long").alias("block"), F.col("over").alias("seq"), F.col("state").alias("bytes")))
        rows = rows.repartition(2 * n, "file").sortWithinPartitions("file", "block", "seq")
        states = checkpointed(rows.mapInArrow(_hash_on, "file string, over long, state binary"))
    return large.join(states, "file").select("path", "length", _digest(F.col("state"), F.col("over")).alias("hash"))


def _digest(state: Column, over: Column) -> Column:
    """The hash from the state after a file's last piece; a line end that the file lacks is left out."""

    @F.pandas_udf("string")
    def digest(states: pd.Series, overs: pd.Series) -> pd.Series:
        out = []
        for after, more in zip(states, overs):
            hashing = sha256.Sha256(after[:sha256.STATE])
            hashing.update(after[sha256.STATE:] if more in (0, -3) else b"")
            out.append(hashing.hexdigest())
        return pd.Series(out, dtype=object)

    return digest(state, over)


def with_content_path(files: DataFrame) -> DataFrame:
    return files.withColumn("content_path", content_path(F.col("file_hash_sha256"), F.col("file_type")))


def integrity(files: DataFrame, stored_path: str = "path") -> DataFrame:
    """Compare each file's byte hash with the hash its content-addressed name claims."""
    claimed = F.regexp_extract(F.col(stored_path), r"([0-9a-f]{64})\.[^./]+$", 1)
    folder = F.regexp_extract(F.col(stored_path), r"([0-9a-f]{2})/[0-9a-f]{64}\.[^./]+$", 1)
    return files.withColumns(
        {
            "claimed_hash": F.when(claimed != "", claimed),
            "intact": (claimed == F.col("file_hash_sha256")) & (folder == F.substring("file_hash_sha256", 1, 2)),
        }
    )
