"""Continuous ingest: files of observations in; state, change log, run ledger and watermark out, one commit for each micro-batch."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslog.operators.entities import latest
from obslog.operators.state import guarded_upsert
from obslog.schemas import EntitySpec
from obslog.sources.store import VersionedTable


def now() -> str:
    return datetime.now(UTC).isoformat()


def upsert_batch(table: VersionedTable, spec: EntitySpec, name: str = "stream", clock: Callable[[], str] = now, before_publish: Callable[[int], None] | None = None):
    """A foreachBatch function: the newest row of each key of the batch goes into the state unless it is older.

    The batch number is the version. State, change rows, the run's row and the watermark
    become visible by one manifest, or none of them does. A batch whose version is there is
    skipped, so that a replay changes nothing; one that died before is done again. Every attempt
    has a run of its own: its start is noted before anything is written, and a failure, with its
    message, before the error goes on. The watermark is the newest value of the order column (a
    whole number, or an instant in microseconds) that was read, and never goes back.

    Batches may come out of order: the guard on the order column makes every order end in the
    same state, but for rows that are equal in it, of which the last batch's stays. Only the
    buckets of the batch's keys are read and rewritten; of these the driver gets numbers.
    `before_publish` runs when everything but the manifest is written."""

    def run(batch: DataFrame, number: int) -> None:
        if number in table.versions():
            return
        started, attempt = clock(), 1 + sum(n.startswith(f"{number:020d}-") and n.endswith("-running.json") for n in table.files.names(f"{table.path}/_runs"))
        run_id = f"{name}-{number}-{attempt}"

        def note(status: str, **more) -> None:
            event = {"run_id": run_id, "status": status, "at": clock(), **more}
            table.files.write_new(f"{table.path}/_runs/{number:020d}-{attempt}-{status}.json", json.dumps(event))

        note("running")
        held: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:
            held.append(df.persist())
            return held[-1]

        try:
            newest = keep(latest(batch, spec.keys, [spec.order, *[c for c in spec.ties if c in batch.columns]]).select(*[f.name for f in table.schema]))
            order = F.unix_micros(spec.order) if dict(newest.dtypes)[spec.order] == "timestamp" else F.col(spec.order).cast("long")
            seen = newest.groupBy(table.bucket().alias("b")).agg(F.max(order).alias("w")).collect()  # a row for each bucket
            touched = sorted(r.b for r in seen)
            before = table.manifest()
            candidate = max((r.w for r in seen if r.w is not None), default=None)
            watermark = max((w for w in (candidate, before and before.get("watermark")) if w is not None), default=None)
            at = clock()
            state, changes = guarded_upsert(table.read(buckets=touched), newest, spec, number, F.lit(at).cast("timestamp"), keep=keep, check=False)  # newest has each key once
            staged = table.stage(state, touched, number, changes)
            if before_publish:
                before_publish(number)
            done = {"run_id": run_id, "status": "succeeded", "started_at": started, "finished_at": clock(), "candidate": candidate}
            table.publish(staged, at, run=done, watermark=watermark)
        except Exception as error:
            note("failed", error_message=str(error).strip()[:1000] or type(error).__name__)
            raise
        finally:
            for df in held:
                df.unpersist()

    return run


def run_events(table: VersionedTable) -> DataFrame:
    """Lifecycle events (run_id, status, at, candidate_watermark_value, error_message) of a stream's batches, for `control.run_ledger`.

    Starts and failures are notes; a success is what a manifest says, and so true exactly if
    the batch's state and change rows are there."""
    stamp = lambda c: F.col(c).cast("timestamp")
    candidate = F.timestamp_micros("run.candidate").alias("candidate_watermark_value")
    done = table.log().where("run IS NOT NULL").select("run.run_id", "run.status", stamp("run.finished_at").alias("at"), candidate, F.lit(None).cast("string").alias("error_message"))
    if not table.files.names(f"{table.path}/_runs"):
        return done
    notes = table.spark.read.schema("run_id string, status string, at string, error_message string").json(f"{table.path}/_runs")
    return done.unionByName(notes.select("run_id", "status", stamp("at").alias("at"), F.lit(None).cast("timestamp").alias("candidate_watermark_value"), "error_message"))


def watermark(table: VersionedTable) -> int | None:
    """How far a stream's committed batches have read: a number, or microseconds of an instant."""
    manifest = table.manifest()
    return manifest and manifest.get("watermark")


def stream_latest_state(source: DataFrame, table: VersionedTable, spec: EntitySpec, checkpoint: str, available_now: bool = True, **options):
    """Start the stream; the checkpoint keeps what has been read. Returns the running query."""
    writer = source.writeStream.foreachBatch(upsert_batch(table, spec, **options)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def files(spark: SparkSession, path: str, schema, files_a_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def daily_activity(events: DataFrame, at: str = "at", late: str = "1 day") -> DataFrame:
    """Rows per UTC day and state, a day being final once the watermark has passed it."""
    return events.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("w"), "state").agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("day"), "state", "n")
