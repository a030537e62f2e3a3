"""Control state as tables: run ledger, watermarks, consumer positions, health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslog.operators.contracts import Rule
from obslog.operators.state import guarded_upsert
from obslog.schemas import EntitySpec

WATERMARKS = EntitySpec("watermarks", ("source_name", "entity_name"), "watermark_value")
POSITIONS = EntitySpec("positions", ("consumer_name", "source_table"), "last_version")
TERMINAL = ("succeeded", "failed")


def run_ledger(events: DataFrame) -> DataFrame:
    """One row per run out of lifecycle events (run_id, status, at, candidate_watermark_value, error_message).

    The first start counts, and the first terminal event: later ones change nothing. A run
    with neither is not there; a candidate stands if it came no later than the end. It is
    one aggregation."""
    terminal = F.col("status").isin(*TERMINAL)
    first = F.min(F.when(terminal, F.struct("at", "status", "error_message", "candidate_watermark_value")))
    early = events.groupBy("run_id").agg(
        F.min(F.when(F.col("status") == "running", F.col("at"))).alias("started_at"),
        first.alias("end"),
        F.max(F.when(F.col("status") == "running", F.struct("at", "candidate_watermark_value"))).alias("last"),
    )
    return early.where("started_at IS NOT NULL").select(
        "run_id",
        F.coalesce("end.status", F.lit("running")).alias("status"),
        "started_at",
        F.col("end.at").alias("finished_at"),
        F.coalesce("end.candidate_watermark_value", "last.candidate_watermark_value").alias("candidate_watermark_value"),
        F.col("end.error_message").alias("error_message"),
    )


#: What must not be in a ledger with watermark_before_value.
RUN_RULES: list[Rule] = [
    ("unknown status", lambda: F.col("status").isNull() | ~F.col("status").isin("running", *TERMINAL)),
    ("running but finished", lambda: (F.col("status") == "running") & F.col("finished_at").isNotNull()),
    ("ended without an end", lambda: F.col("status").isin(*TERMINAL) & F.col("finished_at").isNull()),
    ("failed without a message", lambda: (F.col("status") == "failed") & (F.col("error_message").isNull() | (F.length(F.trim("error_message")) == 0))),
    ("message without a failure", lambda: (F.col("status") != "failed") & F.col("error_message").isNotNull()),
    ("ended before its start", lambda: F.col("finished_at") < F.col("started_at")),
    ("candidate before its watermark", lambda: F.col("candidate_watermark_value") < F.col("watermark_before_value")),
]


def failed_runs(ledger: DataFrame) -> DataFrame:
    return ledger.where("status = 'failed'").select("run_id")


def commit_watermark(stored: DataFrame, ledger: DataFrame, source: str, entity: str, column: str, overlap: Column | int = 300) -> DataFrame:
    """The watermark table after all succeeded runs: never back, and untouched by failed or running ones.

    stored: source_name, entity_name, watermark_column, watermark_value, overlap_seconds,
    last_successful_run_id, updated_at. Of runs with the same candidate the last to finish
    is named; the same commit twice changes nothing."""
    done = ledger.where("status = 'succeeded' AND candidate_watermark_value IS NOT NULL")
    best = done.agg(F.max(F.struct("candidate_watermark_value", "finished_at", "run_id")).alias("x")).where("x IS NOT NULL")
    row = best.select(
        F.lit(source).alias("source_name"),
        F.lit(entity).alias("entity_name"),
        F.lit(column).alias("watermark_column"),
        F.col("x.candidate_watermark_value").alias("watermark_value"),
        (overlap if isinstance(overlap, Column) else F.lit(overlap)).cast("long").alias("overlap_seconds"),
        F.col("x.run_id").alias("last_successful_run_id"),
        F.col("x.finished_at").alias("updated_at"),
    )
    return guarded_upsert(stored, row, WATERMARKS)[0]


def commit_positions(stored: DataFrame, reached: DataFrame) -> DataFrame:
    """Positions (consumer_name, source_table, last_version, last_run_id, updated_at) of several tables moved at once, none of them back."""
    return guarded_upsert(stored, reached, POSITIONS)[0]


def health(ledger: DataFrame, watermarks: DataFrame, runs: int = 10) -> DataFrame:
    """The last runs and all committed watermarks in one list; columns of the other kind are null."""
    recent = ledger.orderBy(F.desc("started_at"), F.desc("run_id")).limit(runs)
    a = recent.select(F.lit("pipeline_run").alias("record_type"), F.lit(1).alias("record_type_order"), "run_id", "status", "started_at", "finished_at", "candidate_watermark_value", "error_message")
    b = watermarks.select(
        F.lit("committed_watermark").alias("record_type"),
        F.lit(2).alias("record_type_order"),
        "source_name",
        "entity_name",
        "watermark_column",
        F.col("watermark_value").alias("committed_watermark_value"),
        "overlap_seconds",
        "last_successful_run_id",
        F.col("updated_at").alias("watermark_updated_at"),
    )
    both = a.unionByName(b, allowMissingColumns=True)
    return both.orderBy("record_type_order", F.desc_nulls_last("started_at"), F.desc_nulls_last("run_id"), F.asc_nulls_last("source_name"), F.asc_nulls_last("entity_name"))
