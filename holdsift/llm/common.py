"""What the corpus operators share: tables, ids of staged data, checkpoints."""

from __future__ import annotations

import hashlib
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift.session import checkpointed as cut  # noqa: F401  the operators cut lineage by it
from holdsift.session import served_folder, ship

#: A word is a run of signs other than space and the five ASCII controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
#: The signs that are in no word.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A corpus table; the workers get the package first."""
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted input columns, under the operator's own names: whatever else the table has cannot clash."""
    return df.select(*(df[source].alias(name) for name, source in wanted.items()))


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hex_number(digest: Column, start: int, n: int) -> Column:
    """``n`` hex digits of a digest, from the 1-based ``start``, as a long."""
    return F.conv(F.substring(digest, start, n), 16, 10).cast("long")


def serve(spark: SparkSession, path: str) -> str:
    """Name under which executors find a file of the driver (``SparkFiles.get``); equal files are sent once.

    The package goes with it: whoever is served a file runs functions of this package.
    """
    with open(path, "rb") as f:
        digest = hashlib.file_digest(f, "sha256").hexdigest()
    name = f"{digest[:20]}-{os.path.basename(path)}"
    sc = ship(spark).sparkContext
    if not any(os.path.basename(f) == name for f in sc.listFiles):
        copy = os.path.join(served_folder(), name)
        shutil.copyfile(path, copy)
        sc.addFile(copy)
    return name


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; a local session without one gets a temporary one."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
    return folder
