"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
_written: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()
_named: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """What `spark.checkpoint.dir` names. Only a local master may go without; it gets a temporary folder."""
    set_to = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if set_to:
        return set_to.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="spark-obslog-")
    return _own[app]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def cut(df: DataFrame, by: Sequence[str] = (), codec: str | None = None) -> DataFrame:
    """`df` written as a Parquet table in the shared folder and read again: lineage ends here.

    With `by`, it is written in Spark's own buckets of these columns, as many as `dealt` makes: what is grouped,
    ranked or joined by them later needs no exchange. The table goes when the driver ends, or by `discard`."""
    spark = df.sparkSession
    path = new_path(spark, "obslog")
    if by:
        name = f"obslog_{uuid.uuid4().hex}"
        dealt(df, by).write.format("parquet").bucketBy(_partitions(spark), *by).option("compression", codec or "zstd").option("path", path).saveAsTable(name)
        out = spark.table(name)
        _named[path] = name
    else:
        (df.write.option("compression", codec) if codec else df.write).parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
    fs, where = _file_system(spark, path)
    fs.deleteOnExit(where)
    _written[out] = path
    return out


def dealt(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """`df` dealt out by the hash of some columns into as many partitions as a bucketed `cut` has buckets; no second time if it is so dealt already."""
    return df.repartition(_partitions(df.sparkSession), *by)


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def view_of(df: DataFrame, view: DataFrame) -> DataFrame:
    """`view`, which reads the table that `cut` gave as `df`, so that `discard` takes it for that table."""
    if df in _written:
        _written[view] = _written[df]
    return view


def discard(*tables: DataFrame) -> None:
    """Delete tables that `cut` gave; nothing that still has to be computed may read them."""
    for df in tables:
        path = _written.pop(df, None)
        if path in _named:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {_named.pop(path)}")
        if path:
            fs, where = _file_system(df.sparkSession, path)
            fs.delete(where, True)
