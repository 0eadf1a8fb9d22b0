"""A table with one row per key, kept as deltas in buckets under a commit log: writing costs what changed, not what is kept.

A write adds the changed rows only, each in the folder of its key's bucket, and then one commit that names the folders of
every bucket, oldest first. Rows carry the number of the commit that wrote them; a key's row is the one with the highest
number. Readers see one commit. In a bucket with many folders the newest are compacted into one, each older one as long as
it is at most twice as large as those after it together. A row is so written anew only after its bucket has grown by half,
whatever the number of writes, and the folders of a bucket stay few.
Compaction is a commit of its own: stopped or overtaken, it has changed nothing, and the next write tries again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdsift.operators.keys import keep_last
from holdsift.sources.commits import TRIES, Commit, CommitLog, Taken

#: Buckets of a new table; a stored one keeps its own number.
BUCKETS = 64
#: Folders that a compaction joins at least, and how much larger than those after it together an older one may be.
RUNS, RATIO = 8, 2


class KeyedDeltas(CommitLog):
    """``schema`` is a DDL string and must hold ``keys``; rows whose keys are null in the same places are one key."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], buckets: int = BUCKETS,
                 runs: int = RUNS) -> None:
        super().__init__(spark, path)
        self.schema, self.keys, self.buckets, self.runs = schema, list(keys), buckets, runs
        self.columns = spark.createDataFrame([], schema).columns

    # --- reading

    def _rows(self, folders: Sequence[str]) -> DataFrame:
        schema = self.schema + ", written_by long"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def _versions(self, commit: Commit) -> DataFrame:
        return self._rows(sorted({f for runs in commit.folders.values() for f, _ in runs}))

    def _of(self, rows: DataFrame, wanted: DataFrame, by: Sequence[str]) -> DataFrame:
        return rows.join(wanted.select(*by).distinct(), list(by), "left_semi").select(*rows.columns)

    def read(self, commit: Commit | None = None, only: DataFrame | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows of a commit (the newest if none is given): of all keys or of those in ``only``, with all or some columns
        (and the keys). Keys are chosen before versions meet, so what is shuffled follows ``only``. A key with a null
        is in no ``only``."""
        chosen = [c for c in self.columns if columns is None or c in columns or c in self.keys]
        rows = self._versions(commit or self.head()).select(*chosen, "written_by")
        if only is not None:
            rows = self._of(rows, only, self.keys)
        return keep_last(rows, self.keys, ["written_by"]).select(*chosen)

    def holding(self, wanted: DataFrame, by: Sequence[str], commit: Commit | None = None,
                columns: Sequence[str] | None = None) -> DataFrame:
        """Rows whose columns ``by`` hold values that stand in ``wanted``. A key's older versions may hold them too: those
        keys are read, and their newest row decides."""
        commit = commit or self.head()
        keys = self._of(self._versions(commit).select(*dict.fromkeys([*self.keys, *by])), wanted, by)
        return self._of(self.read(commit, keys, None if columns is None else [*columns, *by]), wanted, by)

    # --- writing

    def write(self, run: str, change: Callable[[Commit], DataFrame]) -> Commit:
        """Add the rows that ``change`` gives for the state it is handed: one per key, only of keys that change.

        A run that is in the log already gets its commit back and changes nothing. A run that is overtaken by another is
        handed the new state.
        """
        done = self.commit_of(run)
        if done:
            return done
        for _ in range(TRIES):
            head = self.head()
            number, place = head.number + 1, f"data/{uuid.uuid4().hex}"
            rows = change(head).select(*self.columns).withColumn("written_by", F.lit(number).cast("long"))
            added = self._store(rows, place, self._bucket_count(head))
            folders = {**head.folders, **{b: [*head.folders.get(b, []), f] for b, f in added.items()}}
            commit = Commit(number, run, folders)
            try:
                self._add(commit)
            except Taken:
                continue
            return self.compact(commit)
        raise Taken(f"{run}: {TRIES} commits were overtaken by other runs")

    def compact(self, head: Commit) -> Commit:
        """Join the newest folders of the buckets that have too many; the state after it (``head`` if nothing was done)."""
        tails = {b: runs[-n:] for b, runs in head.folders.items() if (n := self._tail(runs))}
        if not tails:
            return head
        rows = keep_last(self._rows(sorted(f for runs in tails.values() for f, _ in runs)), self.keys, ["written_by"])
        joined = self._store(rows.select(*self.columns, "written_by"), f"data/{uuid.uuid4().hex}", self._bucket_count(head))
        folders = {b: [*runs[:len(runs) - len(tails.get(b, []))], *([joined[b]] if b in tails else [])]
                   for b, runs in head.folders.items()}
        commit = Commit(head.number + 1, f"compaction-{head.number + 1}", folders)
        try:
            self._add(commit)
        except Taken:
            return head
        return commit

    def _tail(self, runs: Sequence[Sequence]) -> int:
        """How many of a bucket's newest folders to join."""
        n, size = 0, 0
        for _, length in reversed(runs):
            if n and length > RATIO * size:
                break
            n, size = n + 1, size + length
        return n if n >= self.runs else 0

    def _bucket_count(self, head: Commit) -> int:
        return int(next(iter(head.folders)).split("/")[1]) if head.folders else self.buckets

    def _store(self, rows: DataFrame, place: str, count: int) -> dict[str, list]:
        """Write rows below ``place``; per bucket ("number/count") its folder and bytes. Buckets without rows have none."""
        placed = rows.withColumn("bucket", F.pmod(F.xxhash64(*self.keys), F.lit(count)).cast("int"))
        placed.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/{place}")
        folder, out = self._hadoop.Path(f"{self.path}/{place}"), {}
        for s in self._fs.listStatus(folder):
            name = s.getPath().getName()
            if name.startswith("bucket="):
                out[f"{name[7:]}/{count}"] = [f"{place}/{name}", self._fs.getContentSummary(s.getPath()).getLength()]
        return out
