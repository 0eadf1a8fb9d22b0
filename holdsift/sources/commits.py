"""The published table as immutable snapshots under a commit log: each run is published exactly once.

A run writes new files of the periods it touches into a folder nobody reads yet, then adds one small file to the log: the
commit, which names for every period the folder that holds it now. Adding that file is the only step that changes what
readers see, and it either happens or does not (a file is put in place under a name that must not exist yet). So:

* a run stopped before its commit has published nothing and is simply started again;
* a run stopped after its commit finds it in the log and publishes nothing more;
* a reader works on the folders of one commit, whatever is published meanwhile;
* of two runs that commit at once one gets the next number; the other merges into what now stands and tries again,
  reading only periods that both touched anew.

Every row carries the run that last touched it (``touched_by``). Untouched periods keep their folders.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift.operators.warehouse import PUBLISHED_SCHEMA, publish_upsert

STORED_SCHEMA = PUBLISHED_SCHEMA + ", touched_by string"
#: Commits a run tries to add while others publish, before it gives up.
TRIES = 10


@dataclass(frozen=True)
class Commit:
    """One state of a table: per part (a period "year-month", a bucket) the folder or folders of its rows, below the
    table's folder."""

    number: int
    run: str
    folders: dict = field(default_factory=dict)


class Taken(RuntimeError):
    """Another run has added a commit of this number."""


class CommitLog:
    """The log below a table's folder: its states in order, each put in place in one step."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.log = spark, path, f"{path}/_commits"
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop.fs
        self._fs = self._hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _file(self, number: int) -> str:
        return f"{self.log}/{number:020d}.json"

    def head(self) -> Commit:
        """The newest commit; number 0, without folders, where nothing is published."""
        log = self._hadoop.Path(self.log)
        names = [s.getPath().getName() for s in self._fs.listStatus(log)] if self._fs.exists(log) else []
        numbers = [int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith((".", "_"))]
        return self.commit_at(max(numbers)) if numbers else Commit(0, "")

    def commit_at(self, number: int) -> Commit:
        stream = self._fs.open(self._hadoop.Path(self._file(number)))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit(**json.loads(text))

    def commit_of(self, run: str) -> Commit | None:
        """The commit of a run, if it has one; the log's files are searched by Spark."""
        if not self._fs.exists(self._hadoop.Path(self.log)):
            return None
        found = self.spark.read.schema("number long, run string").json(self.log).filter(F.col("run") == run).agg(F.min("number")).first()[0]
        return None if found is None else self.commit_at(found)

    def _add(self, commit: Commit) -> None:
        """Put a commit into the log, or raise ``Taken``: its whole content first, then its name in one step."""
        scratch = self._hadoop.Path(f"{self.path}/_work/{uuid.uuid4().hex}.commit")
        out = self._fs.create(scratch, True)
        out.write(json.dumps({"number": commit.number, "run": commit.run, "folders": commit.folders}).encode())
        out.close()
        target = self._hadoop.Path(self._file(commit.number))
        self._fs.mkdirs(target.getParent())
        rename = getattr(self._hadoop, "Options$Rename")
        never_over = self.spark._sc._gateway.new_array(rename, 1)
        never_over[0] = rename.NONE
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(self._fs.makeQualified(scratch), self._fs.makeQualified(target), never_over)
        except Exception as e:
            if "FileAlreadyExists" in str(e):
                raise Taken(str(commit.number)) from None
            raise


class PublishedStore(CommitLog):
    # --- reading

    def read(self, commit: Commit | None = None, periods: list[str] | None = None) -> DataFrame:
        """Rows of a commit (the newest if none is given), of some periods or all; other periods are not listed even."""
        commit = commit or self.head()
        chosen = commit.folders if periods is None else {p: commit.folders[p] for p in periods if p in commit.folders}
        if not chosen:
            return self.spark.createDataFrame([], STORED_SCHEMA)
        return self.spark.read.schema(STORED_SCHEMA).parquet(*(f"{self.path}/{f}" for f in sorted(chosen.values())))

    # --- publishing

    def publish(self, run: str, batch: DataFrame, order: list[str], as_of) -> Commit:
        """Upsert a batch under a run's name; a run that is in the log already gets its commit back and changes nothing.

        The batch is written once; of the stored rows only the periods it touches are read. The periods of a batch come
        to the driver (a few per fund calendar), rows never do.
        """
        done = self.commit_of(run)
        if done:
            return done
        work = f"{self.path}/_work/{uuid.uuid4().hex}"
        rows = self._staged(batch, work)
        touched = sorted(f"{r[0]}-{r[1]}" for r in rows.select("period_year", "period_month").distinct().collect())
        merged_from, folders = None, {}
        for _ in range(TRIES):
            head = self.head()
            if merged_from is None or any(head.folders.get(p) != merged_from.folders.get(p) for p in touched):
                snapshot = f"data/{uuid.uuid4().hex}"
                self._merge(head, rows, touched, order, as_of, run, snapshot)
                folders = {p: f"{snapshot}/part_year={p.rsplit('-', 1)[0]}/part_month={p.rsplit('-', 1)[1]}" for p in touched}
                merged_from = head
            commit = Commit(head.number + 1, run, {**head.folders, **folders})
            try:
                self._add(commit)
            except Taken:
                continue
            return commit
        raise Taken(f"{run}: {TRIES} commits were overtaken by other runs")

    def _staged(self, batch: DataFrame, work: str) -> DataFrame:
        batch.write.parquet(f"{work}/batch")
        return self.spark.read.schema(batch.schema).parquet(f"{work}/batch")

    def _merge(self, head: Commit, rows: DataFrame, touched: list[str], order: list[str], as_of, run: str, snapshot: str) -> None:
        merged = publish_upsert(self.read(head, touched), rows, order, as_of, run)
        placed = merged.withColumns({"part_year": F.col("period_year"), "part_month": F.col("period_month")})
        # rebalancing keeps a month together and splits it by size, also one that holds most of the rows
        placed.hint("rebalance", "part_year", "part_month").write.partitionBy("part_year", "part_month").parquet(f"{self.path}/{snapshot}")
