"""Session helpers shared by jobs, tests and the bench."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Spark setting: shuffle files are removed at the end of an execution.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def session(app: str = "holdsift", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the jobs rely on; a cluster's own settings win.

    Shuffle partition count is left to the cluster (AQE coalesces); only UTC and
    AQE are pinned because results or plans depend on them.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def served_folder() -> str:
    """A folder of the driver for files that it serves to executors; kept while the program runs, since a new executor
    fetches them when it starts."""
    folder = os.path.realpath(tempfile.mkdtemp(prefix="holdsift-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, so functions run in Python workers find it there.

    ``--py-files`` or an installed package does the same; this serves a session that was started without either.
    """
    sc = spark.sparkContext
    if getattr(sc, "_holdsift_shipped", False):
        return spark
    package = Path(__file__).resolve().parent
    packed = os.path.join(served_folder(), "holdsift.zip")
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    sc.addPyFile(packed)
    sc._holdsift_shipped = True
    return spark


def shared_work(spark: SparkSession) -> str:
    """A fresh folder in the cluster's shared checkpoint folder; only a local session without one gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="holdsift-")
    return f"{base.rstrip('/')}/work-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows lie in the folder all executors share, the plan starts anew there.

    The folder is ``spark.checkpoint.dir``. Where it is unset, a local session (tests, a laptop) gets a temporary one
    and a cluster gets an error, since no machine-local folder would do there. The plan's shuffle files go as soon as the
    rows lie there; nothing reads them again.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(folder)
    before = spark.conf.get(FREE_SHUFFLES, "false")
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a new reference: the setting counts when it is made
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
