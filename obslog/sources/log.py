"""The observation log: JSON payloads as rows, appended and never changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obslog.schemas import OBSERVATION, enforce_schema
from obslog.sources.folder import cut

#: ISO 8601 with a zone: Z or an offset of hours and minutes.
ZONED = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"


def instant(text: Column) -> Column:
    """The instant that a zoned ISO text names; null for any other text."""
    return F.when(text.rlike(ZONED) & ~text.contains("\n"), F.try_to_timestamp(text))


def observe(
    payloads: DataFrame, owner: Column, name: Column, run_id: Column, ingested_at: Column, batch: Column, request_watermark: Column | None = None, payload_col: str = "payload"
) -> DataFrame:
    """Observation rows of JSON payloads.

    A payload without a positive integer id or without a zoned `updated_at` gives nulls in
    these columns, which `operators.contracts.OBSERVATION_RULES` reports."""
    text = F.col(payload_col)
    number = F.get_json_object(text, "$.id")
    return payloads.select(
        owner.alias("repository_owner"),
        name.alias("repository_name"),
        F.when(number.rlike(r"^[1-9]\d{0,18}$"), number.try_cast("bigint")).alias("issue_id"),
        instant(F.get_json_object(text, "$.updated_at")).alias("source_updated_at"),
        text.alias("raw_json"),
        run_id.alias("_run_id"),
        ingested_at.alias("_ingested_at"),
        batch.alias("_page_or_batch_reference"),
        (F.lit(None) if request_watermark is None else request_watermark).cast("timestamp").alias("_request_watermark"),
    )


def canonical_json(text: Column) -> Column:
    """A payload in one spelling: every field is kept, names in order at each level, no spaces, nulls as they are; null for what is no JSON."""
    return F.to_json(F.try_parse_json(text))


def append(observations: DataFrame, path: str, version: int) -> int:
    """Add one commit to the log at `path`; returns the rows written. No rows write nothing.

    A commit is a partition of its own, and in it each run, so that reads as of a version or of
    some runs prune files. The same version again replaces nothing and fails, since its
    folder is there."""
    seen = Observation()
    rows = enforce_schema(observations, OBSERVATION)
    if rows.isEmpty():
        return 0
    rows.observe(seen, F.count("*").alias("n")).write.mode("errorifexists").partitionBy("_run_id").parquet(f"{path.rstrip('/')}/_commit_version={int(version)}")
    return seen.get["n"]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The log with _commit_version. Version and run are partitions: conditions on them, and joins with a few runs such as a manifest's, prune files."""
    schema = T.StructType([*OBSERVATION, T.StructField("_commit_version", T.LongType())])
    return spark.read.option("basePath", path).schema(schema).parquet(path).select(*[f.name for f in schema])


def incremental(log: DataFrame, watermark, overlap_seconds: int = 300, column: str = "source_updated_at") -> DataFrame:
    """Rows from `overlap_seconds` before the watermark on, inclusive; all without a watermark."""
    if watermark is None:
        return log
    start = F.lit(watermark).cast("timestamp") - F.make_dt_interval(secs=F.lit(overlap_seconds))
    return log.where(F.col(column) >= start)


def batches(log: DataFrame, size: int, *order: str) -> DataFrame:
    """`log` with a batch label (batch-1, batch-2, ...) of `size` rows within each run, by the given order.

    Rows are dealt by ranges of run and order and numbered within a range, on from the exact
    count of the run's rows in the ranges before it: a run that is most of the log is no one
    task's work. Only the counts, a row for each run and range, meet by run."""
    dealt = cut(log.repartitionByRange("_run_id", *order).withColumn("_part", F.spark_partition_id()))
    counts = dealt.groupBy("_run_id", "_part").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("_run_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("_run_id").alias("_of"), F.col("_part").alias("_in"), F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    joined = dealt.join(before, F.col("_run_id").eqNullSafe(F.col("_of")) & (F.col("_part") == F.col("_in")))
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_run_id", "_part").orderBy(*order))
    return joined.select(*log.columns, F.concat(F.lit("batch-"), (F.floor((place - 1) / size) + 1).cast("string")).alias("batch"))


def candidate_watermark(log: DataFrame, previous=None, column: str = "source_updated_at") -> DataFrame:
    """One row: the newest source time that was read, never before `previous`; null if nothing was read."""
    newest = F.max(column)
    never_back = newest if previous is None else F.when(newest.isNotNull(), F.greatest(newest, F.lit(previous).cast("timestamp")))
    return log.agg(never_back.alias("candidate"), F.count("*").alias("rows_read"))


def of_run(log: DataFrame, run_id: str | None) -> DataFrame:
    """The rows of one run, or all; a blank run id is an error."""
    if run_id is None:
        return log
    if not run_id.strip():
        raise ValueError("a run id must not be blank")
    return log.where(F.col("_run_id") == run_id)
