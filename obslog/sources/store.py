"""Tables that keep their versions: buckets of Parquet files, a manifest for each commit, and a stored change log."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What a change row has besides the table's columns.
CHANGE_FIELDS = [T.StructField("_change_type", T.StringType()), T.StructField("_commit_timestamp", T.TimestampType()), T.StructField("_commit_version", T.LongType())]


class UnreadableRange(ValueError):
    """A range of versions that the change log does not hold."""


class CommitConflict(RuntimeError):
    """A version that is not newer than the table's newest one, or that somebody else has just committed."""


class Files:
    """The few file operations that a commit needs, in whatever file system the path is of."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.plainly = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # no overwriting

    def _at(self, path: str):
        where = self.jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self.conf), where

    def names(self, path: str) -> list[str]:
        fs, where = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []

    def read(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, path: str, text: str) -> bool:
        """Write a file that appears whole or not at all; False if there is one."""
        fs, where = self._at(path)
        if fs.exists(where):
            return False
        hidden = self.jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{uuid.uuid4().hex}")
        stream = fs.create(hidden, False)
        try:
            self.jvm.org.apache.commons.io.IOUtils.write(text, stream, "UTF-8")
        finally:
            stream.close()
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(hidden, where, self.plainly)
        except Exception:
            fs.delete(hidden, False)
            if fs.exists(where):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)


@dataclass
class Staged:
    """What a commit has written but nobody reads yet."""

    version: int
    folder: str | None
    buckets: dict[str, str]
    touched: list[int]
    has_changes: bool


class VersionedTable:
    """A table under `path`, in buckets of the hash of `bucket_by` (the keys), of which a commit rewrites those that it touches.

    A commit writes its buckets to a folder of its own and its change rows to their version's
    partition, and then one manifest, a small file that appears whole: version, time, the
    folder of every bucket, and what the caller wants to be true together with it, such as a run's
    row and a watermark. Before that nothing of it is seen; a commit that died is written
    again from the start, and leaves a folder that the next commit deletes. The state at a version
    is what its manifest names, so that no order of file times or names decides anything.

    The newest `keep` versions stay readable. Change rows are stored for commits made with
    `feed`, and stay; a range is read by its partitions alone. A manifest has an entry for each
    bucket; give as many buckets as keep one at some hundred megabytes. A commit exchanges its rows, so that a bucket
    is one file; not `gathered`, each task writes a file of its own in each bucket, which needs no exchange and is no one
    task's work: for commits of much data. There is one writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 32, keep: int = 2, feed: bool = False, bucket_by: Sequence[str] | None = None, gathered: bool = True):
        self.spark, self.path, self.keys, self.buckets, self.keep, self.feed = spark, path.rstrip("/"), list(keys), buckets, keep, feed
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in schema])
        self.bucket_by, self.gathered = list(bucket_by or keys), gathered
        self.files = Files(spark)

    # --- what is there

    def versions(self) -> list[int]:
        """Committed versions, oldest first: one listing."""
        return [int(n.removesuffix(".json")) for n in self.files.names(f"{self.path}/_manifests") if n.endswith(".json")]

    def manifest(self, version: int | None = None) -> dict | None:
        """The manifest of a version, or the newest one."""
        version = max(self.versions(), default=None) if version is None else version
        if version is None:
            return None
        try:
            return json.loads(self.files.read(f"{self.path}/_manifests/{version:020d}.json"))
        except Exception as e:
            if "FileNotFound" not in str(e):
                raise
            raise UnreadableRange(f"{self.path}: version {version} isn't there") from None

    def _at(self, folders: dict[str, str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{folder}/_bucket={b}" for b, folder in sorted(folders.items())])

    def read(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The state at a version (by default the newest), or some buckets of it."""
        manifest = self.manifest(version)
        if manifest is None:
            return self._at({})
        if version is not None and version not in self.versions()[-self.keep :]:
            raise UnreadableRange(f"{self.path}: version {version} isn't kept any more")
        return self._at({b: folder for b, folder in manifest["buckets"].items() if buckets is None or int(b) in set(buckets)})

    def changes(self, start: int, end: int) -> DataFrame:
        """Change rows of the versions start to end, both included; an error unless the log holds all of the range."""
        manifest = self.manifest() or {"version": None, "feed_from": None}
        first, last = manifest["feed_from"], manifest["version"]
        if start > end or first is None or start < first or end > last:
            held = "has no versions" if first is None else f"has {first} to {last}"
            raise UnreadableRange(f"{self.path}: versions {start} to {end} can't be read; the log {held}")
        schema = T.StructType([*self.schema, *CHANGE_FIELDS])
        if not self.files.names(f"{self.path}/changes"):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/changes").where(F.col("_commit_version").between(start, end))

    def log(self) -> DataFrame:
        """A row for each commit: version, committed_at, touched buckets, run and watermark."""
        ddl = "version long, committed_at string, touched array<int>, feed_from long, run struct<run_id: string, status: string, started_at: string, finished_at: string, candidate: long>, watermark long"
        if not self.versions():
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).json(f"{self.path}/_manifests")

    # --- commits

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.bucket_by), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets of some rows' keys: at most `buckets` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def stage(self, state: DataFrame, touched: Sequence[int] | None, version: int, changes: DataFrame | None = None) -> Staged:
        """Write what the touched buckets (None: all) have from now on, and the change rows; `publish` makes it the table's."""
        now = self.manifest()
        if now is not None and version <= now["version"]:
            raise CommitConflict(f"{self.path}: version {version} isn't newer than {now['version']}")
        touched = list(range(self.buckets)) if touched is None else list(touched)
        buckets = {b: f for b, f in (now["buckets"] if now else {}).items() if int(b) not in touched}
        folder = None
        if touched:
            folder = f"{version}-{uuid.uuid4().hex}"
            rows = state.select([f.name for f in self.schema]).withColumn("_bucket", self.bucket())
            (rows.repartition("_bucket") if self.gathered else rows).write.option("compression", "zstd").partitionBy("_bucket").parquet(f"{self.path}/data/{folder}")
            buckets |= {n.removeprefix("_bucket="): folder for n in self.files.names(f"{self.path}/data/{folder}") if n.startswith("_bucket=")}
        if self.feed and changes is not None:
            rows = changes.select(*[f.name for f in self.schema], "_change_type", "_commit_timestamp")
            rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{self.path}/changes/_commit_version={version}")
        return Staged(version, folder, buckets, touched, self.feed and changes is not None)

    def preview(self, staged: Staged) -> DataFrame:
        """The table as it will be once `staged` is published."""
        return self._at(staged.buckets)

    def publish(self, staged: Staged, at: str, **together) -> dict:
        """Make a staged version the newest one, together with whatever else the manifest is to say, and delete what no kept version needs."""
        before = self.manifest()
        if before is not None and staged.version <= before["version"]:
            raise CommitConflict(f"{self.path}: version {staged.version} isn't newer than {before['version']}")
        feed_from = before["feed_from"] if before else None
        if not self.feed:
            feed_from = None  # a gap: earlier change rows can't be joined with later ones
        elif feed_from is None and staged.has_changes:
            feed_from = staged.version
        manifest = {"version": staged.version, "committed_at": at, "feed_from": feed_from, "touched": staged.touched, "buckets": staged.buckets, **together}
        if not self.files.write_new(f"{self.path}/_manifests/{staged.version:020d}.json", json.dumps(manifest)):
            raise CommitConflict(f"{self.path}: version {staged.version} is there already")
        kept = [manifest, *[self.manifest(v) for v in self.versions()[-self.keep : -1]]]
        needed = {folder for m in kept for folder in m["buckets"].values()}
        for folder in self.files.names(f"{self.path}/data"):
            if folder not in needed and not folder.startswith((".", "_")):
                self.files.delete(f"{self.path}/data/{folder}")
        return manifest

    def commit(self, state: DataFrame, touched: Sequence[int] | None, version: int, at: str, changes: DataFrame | None = None, **together) -> dict:
        return self.publish(self.stage(state, touched, version, changes), at, **together)


def replace_in(table: VersionedTable, workset: DataFrame, rebuilt: DataFrame, version: int) -> Staged:
    """Stage a table in which the rows of the workset's keys (the table's `bucket_by`) are those of `rebuilt`.

    Only the buckets of these keys are read and written, in proportion to the workset and not
    to the table."""
    keys = table.bucket_by
    touched = table.touched(workset)
    rest = table.read(buckets=touched).join(workset.select(*keys).distinct(), keys, "left_anti")
    return table.stage(rest.unionByName(rebuilt.select([f.name for f in table.schema])), touched, version)
