"""Tables kept as their change rows (the table convention of §7.2).

Open Spark has no MERGE/DELETE on Parquet and no change data feed, so a mutable table is the
Parquet folder of the change rows that its merges gave, appended by version:

    <path>/changes/_commit_version=<n>/_writer=<name>/_batch_id=<b>/

Nothing is rewritten. The content at a version is the sum of the change rows up to it (``state_of``: one
aggregate), the feed is a read of the folder. A merge reads the rows of its batch's keys only.

A commit is one Parquet write, complete when Spark has written its ``_SUCCESS``. A batch that is already
complete is skipped; one that was lost half way has no ``_SUCCESS``, is read by nobody and is
cleared by the next commit. Writers of one table run one after another.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.cdc import INSERT, POST
from ..operators.joins import broadcast_if_small
from ..session import glob_paths, remove_dir
from .runner import kept

NO_BATCH = -1


class AppendOnlyViolation(Exception):
    pass


class LostCommit(Exception):
    """A writer was lost, or is at work: its change rows are not complete."""


class Commit(NamedTuple):
    version: int
    writer: str
    batch_id: int
    path: str
    complete: bool


def state_of(changes: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows that are left when all change rows are applied: per distinct row, what was inserted less
    what was taken away. Rows may repeat; nulls are equal to each other. Columns must be groupable (no maps)."""
    sign = F.when(F.col("_change_type").isin(INSERT, POST), 1).otherwise(-1)
    left = changes.groupBy(*cols).agg(F.sum(sign).cast("int").alias("_left")).filter("_left > 0")
    return left.withColumn("_left", F.explode(F.array_repeat(F.lit(0), F.col("_left")))).select(*cols)


class VersionedTable:
    """``keys`` (all or part of the merge key) let a merge read the rows of its batch only;
    ``append_only`` (SNK-9) rejects commits whose changes are not all inserts;
    ``constraints`` (QUA-1) are checked over the rows a commit adds or changes
    before anything is written, so a bad batch leaves no trace."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, *,
                 keys: Sequence[str] = (), append_only: bool = False,
                 constraints: dict[str, str] | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.keys = list(keys)
        self.append_only = append_only
        self.constraints = dict(constraints or {})

    @property
    def _changes_dir(self) -> str:
        return f"{self.path}/changes"

    @property
    def change_schema(self) -> T.StructType:
        return T.StructType(list(self.schema.fields) + [
            T.StructField("_change_type", T.StringType()),
            T.StructField("_commit_timestamp", T.TimestampType()),
            T.StructField("_commit_version", T.LongType())])

    # -- versions: folder names only -----------------------------------------
    def commits(self) -> list[Commit]:
        one = f"{self._changes_dir}/_commit_version=*/_writer=*/_batch_id=*"
        done = {p.rsplit("/", 1)[0] for p in glob_paths(self.spark, f"{one}/_SUCCESS")}
        out = []
        for p in glob_paths(self.spark, one):
            v, w, b = (part.split("=", 1)[1] for part in p.split("/")[-3:])
            out.append(Commit(int(v), w, int(b), p, p in done))
        return sorted(out)

    def latest_version(self, writer: str | None = None) -> int:
        """The newest version, -1 before the first; of one writer if given."""
        return max((c.version for c in self.commits() if c.complete and writer in (None, c.writer)), default=-1)

    def version_of(self, writer: str, batch_id: int) -> int | None:
        found = [c.version for c in self.commits() if c.complete and (c.writer, c.batch_id) == (writer, batch_id)]
        return found[0] if found else None

    def exists(self) -> bool:
        return self.latest_version() >= 0

    # -- reads ----------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """Content as of ``version`` (default latest); time travel is reading an older version (SRC-11)."""
        return self._state(self.changes(0, version))

    def _state(self, changes: DataFrame) -> DataFrame:
        if self.append_only:
            return changes.select(*self.schema.names)
        return state_of(changes, self.schema.names)

    def changes(self, start: int = 0, end: int | None = None, *, since=None, until=None) -> DataFrame:
        """Batch change feed by version, and by time of commit, both ends inclusive (SRC-6)."""
        last = self.latest_version()
        last = last if end is None else min(end, last)
        if last < start:
            return self.spark.createDataFrame([], self.change_schema)
        rows = self._feed(self.spark.read).filter(F.col("_commit_version").between(start, last))
        if since is not None:
            rows = rows.filter(F.col("_commit_timestamp") >= F.lit(since).cast("timestamp"))
        if until is not None:
            rows = rows.filter(F.col("_commit_timestamp") <= F.lit(until).cast("timestamp"))
        return rows

    def change_stream(self, start: int = 0, max_files: int | None = None) -> DataFrame:
        """Streaming change feed from ``start`` (inclusive) (SRC-5). Raises while a commit is not complete:
        its writer has to run (again) first."""
        open_ = [c.path for c in self.commits() if not c.complete]
        if open_:
            raise LostCommit(f"not complete: {open_[0]}")
        r = self.spark.readStream
        if max_files:
            r = r.option("maxFilesPerTrigger", int(max_files))
        return self._feed(r).filter(F.col("_commit_version") >= start)

    def _feed(self, reader) -> DataFrame:
        stored = T.StructType(list(self.change_schema.fields)
                              + [T.StructField("_writer", T.StringType()), T.StructField("_batch_id", T.LongType())])
        return reader.schema(stored).parquet(self._changes_dir).select(*self.change_schema.names)

    # -- writes ---------------------------------------------------------------
    def create_if_absent(self) -> None:
        """``CREATE TABLE IF NOT EXISTS`` with the declared schema (SNK-8): version 0 without rows."""
        empty = T.StructType(list(self.schema.fields) + [T.StructField("_change_type", T.StringType())])
        self.commit(self.spark.createDataFrame([], empty), writer="create", batch_id=0)

    def _check(self, changes: DataFrame) -> None:
        from ..operators import quality
        rules = {f"constraint_{k}": f"_change_type NOT IN ('insert', 'update_postimage') OR ({e})"
                 for k, e in self.constraints.items()}
        if self.append_only:
            rules["append_only"] = "_change_type = 'insert'"
        bad = {k: n for k, n in quality.violations(changes, rules).items() if n}
        if bad.pop("append_only", 0):
            raise AppendOnlyViolation(f"{self.path} is append-only")
        if bad:
            raise quality.ConstraintViolation(f"CHECK constraint violated: {bad}")

    def commit(self, changes: DataFrame, *, writer: str, batch_id: int | None = None) -> int | None:
        """Append change rows as a new version. Returns it, or None when this batch was committed before."""
        commits = self.commits()
        if batch_id is not None and any(c.complete and (c.writer, c.batch_id) == (writer, batch_id) for c in commits):
            return None
        for c in commits:
            if not c.complete:  # of a writer that was lost
                remove_dir(self.spark, c.path)
        v = max((c.version for c in commits if c.complete), default=-1) + 1
        dest = f"{self._changes_dir}/_commit_version={v}/_writer={writer}/_batch_id={NO_BATCH if batch_id is None else batch_id}"
        if self.append_only or self.constraints:
            with kept(changes) as rows:
                self._check(rows)
                self._write(rows, dest)
        else:
            self._write(changes, dest)
        return v

    def _write(self, changes: DataFrame, dest: str) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        (changes.select(*self.schema.names, "_change_type").withColumn("_commit_timestamp", F.lit(now).cast("timestamp"))
         .hint("rebalance").write.mode("overwrite").parquet(dest))

    def merge(self, fn, *, writer: str, batch_id: int | None = None, source: DataFrame | None = None) -> int | None:
        """Apply ``fn(current) -> MergeResult`` and append its change rows.

        With ``source`` (the batch) holding the table's ``keys``, ``fn`` sees the rows of the batch's keys only,
        which is exact for key-wise operations (upsert, delete by key, matched update, insert-only). A batch
        that lacks some key columns, and a delete by something else, sees every row."""
        if batch_id is not None and self.version_of(writer, batch_id) is not None:
            return None
        rows = self.changes()
        if source is None or not self.keys or not set(self.keys) <= set(source.columns):
            return self.commit(fn(self._state(rows)).changes, writer=writer, batch_id=batch_id)
        wanted = broadcast_if_small(source.select(*self.keys).dropDuplicates())
        rows = rows.join(wanted, self.keys, "left_semi").select(*rows.columns)
        with kept(self._state(rows)) as current:  # of the size of the batch; a merge reads it several times
            return self.commit(fn(current).changes, writer=writer, batch_id=batch_id)

    def insert(self, rows: DataFrame, *, writer: str = "insert", batch_id: int | None = None) -> int | None:
        """``INSERT INTO t VALUES …``: all rows or none (SNK-7); stored rows are not read."""
        return self.commit(rows.withColumn("_change_type", F.lit(INSERT)), writer=writer, batch_id=batch_id)
