"""Incremental models: only the keys that changed are rebuilt, and the result equals the full build."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslog.operators.changes import change_range, changed_keys, plan_ranges, write_workset
from obslog.operators.compare import diff_by_buckets
from obslog.operators.control import commit_positions
from obslog.operators.star import ISSUE_KEY, bridge_issue_label, fact_issue
from obslog.operators.state import replace_keys, replace_workset
from obslog.schemas import ISSUES, RELATIONS
from obslog.sources.folder import cut
from obslog.sources.store import VersionedTable, replace_in


def of_workset(rows: DataFrame, workset: DataFrame, keys: Sequence[str] = ISSUE_KEY) -> DataFrame:
    """The rows whose full business key is in the workset; never multiplies rows."""
    return rows.join(workset.select(*keys), list(keys), "left_semi").select(*rows.columns)


def fact_incremental(fact: DataFrame, issues: DataFrame, workset: DataFrame) -> DataFrame:
    """The fact with the workset's issues merged in by issue_key, that is by the three columns it is the digest of: they are short, and issues may lie in their buckets."""
    return replace_keys(fact, fact_issue(of_workset(issues, workset)), ISSUE_KEY)


def bridge_incremental(bridge: DataFrame, relations: DataFrame, workset: DataFrame) -> DataFrame:
    """The bridge without the workset's issues, and their relations as they are now."""
    return replace_workset(bridge, workset, bridge_issue_label(of_workset(relations, workset)), ISSUE_KEY)


@dataclass
class Batch:
    """What one incremental batch gives: the workset, both models, and their differences from a full build."""

    workset: DataFrame
    fact: DataFrame
    bridge: DataFrame
    fact_differences: DataFrame
    bridge_differences: DataFrame


def incremental_batch(fact: DataFrame, bridge: DataFrame, issues: DataFrame, relations: DataFrame, issue_feed: DataFrame, relation_feed: DataFrame, ranges: dict[str, tuple[int, int]]) -> Batch:
    """Ranges to workset to models to comparison; the caller commits positions last, and only if there are no differences.

    issues and relations are the current state at the end of the ranges (tables `issues` and `relations`)."""
    feeds = [(change_range(issue_feed, *ranges["issues"]), ISSUES), (change_range(relation_feed, *ranges["relations"]), RELATIONS)]
    workset = cut(changed_keys(feeds, ISSUE_KEY), ISSUE_KEY)
    new_fact, new_bridge = fact_incremental(fact, issues, workset), bridge_incremental(bridge, relations, workset)
    return Batch(
        workset, new_fact, new_bridge, diff_by_buckets(new_fact, fact_issue(issues), ISSUE_KEY, ["source_run_id"]), diff_by_buckets(new_bridge, bridge_issue_label(relations), ISSUE_KEY)
    )


class RefusedBatch(ValueError):
    """A batch whose ranges can't be planned, or whose models differ from a full build; no position moves."""


def run_batch(
    fact: DataFrame, bridge: DataFrame, issues: DataFrame, relations: DataFrame, issue_feed: DataFrame, relation_feed: DataFrame,
    positions: DataFrame, baselines: DataFrame, consumer: str, run_id: str, at: Column,
) -> tuple[Batch, DataFrame]:
    """(batch, positions after it): ranges planned from the consumer's positions or baselines, then workset, models and comparison, and positions last.

    The newest versions are read before anything else, and they are what is committed: a
    change that comes in meanwhile belongs to the next batch. A range that can't be planned
    or any difference from the full build raises RefusedBatch. Idle tables keep their
    position. positions: (consumer_name, source_table, last_version, last_run_id,
    updated_at); baselines: (source_table, version)."""
    feeds = {"issues": issue_feed, "relations": relation_feed}
    current = None
    for name, feed in feeds.items():
        row = feed.agg(F.max("_commit_version").alias("version")).where("version IS NOT NULL").select(F.lit(name).alias("source_table"), "version")
        current = row if current is None else current.unionByName(row)
    stored = positions.where(F.col("consumer_name") == consumer).select("source_table", F.col("last_version").alias("version"))
    plan = plan_ranges(stored, baselines, current).collect()  # a row for each of the two tables
    bad = sorted(f"{r.source_table}: {r.status}" for r in plan if r.status not in ("ready", "idle"))
    if bad or {r.source_table for r in plan} != set(feeds):
        raise RefusedBatch(f"no ranges: {bad or sorted(r.source_table for r in plan)}")
    batch = incremental_batch(fact, bridge, issues, relations, issue_feed, relation_feed, {r.source_table: (r.start_version, r.end_version) for r in plan})
    for name, differences in (("fact", batch.fact_differences), ("bridge", batch.bridge_differences)):
        if not differences.isEmpty():
            raise RefusedBatch(f"the {name} differs from a full build")
    reached = [(consumer, r.source_table, r.end_version, run_id) for r in plan if r.status == "ready"]
    rows = fact.sparkSession.createDataFrame(reached, "consumer_name string, source_table string, last_version long, last_run_id string").withColumn("updated_at", at)
    return batch, commit_positions(positions, rows)


@dataclass
class Models:
    """Stored models: fact and bridge in buckets of the issue's key, the consumers' positions, and the path of the workset."""

    fact: VersionedTable
    bridge: VersionedTable
    positions: VersionedTable
    workset: str


@dataclass
class Published:
    """What a published batch did: the ranges it read, the keys in its workset, and where the consumer stands now."""

    ranges: dict[str, tuple[int, int]]
    workset_rows: int
    positions: dict[str, int]


def publish_batch(
    models: Models, issues: VersionedTable, relations: VersionedTable, consumer: str, run_id: str, at: str, baselines: dict[str, int] | None = None, before_commit: Callable[[], None] | None = None
) -> Published:
    """One batch that writes: ranges, workset, both models, their comparison with a full build, and then what makes it count.

    The newest versions are read before anything else, and they are what is committed. The
    workset is written and read back; of the models only the buckets of its keys are read,
    rebuilt and staged, each once; the comparison reads what was staged. Only if nothing differs
    are the models published, and the positions last. A batch that stops anywhere before
    leaves positions and models alone; one that stops between them is run again, from the same
    positions to the same models. Neither range nor position moves for a table without new
    versions. `before_commit` runs when everything is written and compared."""
    spark = models.fact.spark
    tables = {"issues": issues, "relations": relations}
    current = {name: (t.manifest() or {"version": None})["version"] for name, t in tables.items()}
    stored = models.positions.read()
    of_consumer = stored.where(F.col("consumer_name") == consumer).select("source_table", F.col("last_version").alias("version"))
    known = "source_table string, version long"
    newest = spark.createDataFrame([(k, v) for k, v in current.items() if v is not None], known)
    plan = plan_ranges(of_consumer, spark.createDataFrame(list((baselines or {}).items()), known), newest).collect()  # a row for each of the two tables
    bad = sorted(f"{r.source_table}: {r.status}" for r in plan if r.status not in ("ready", "idle"))
    if bad or {r.source_table for r in plan} != set(tables):
        raise RefusedBatch(f"no ranges: {bad or sorted(r.source_table for r in plan)}")
    ranges = {r.source_table: (r.start_version, r.end_version) for r in plan if r.status == "ready"}
    if not ranges:
        return Published({}, 0, current)
    specs = {"issues": ISSUES, "relations": RELATIONS}
    n = write_workset(changed_keys([(tables[name].changes(*of), specs[name]) for name, of in ranges.items()], ISSUE_KEY), models.workset, ISSUE_KEY)
    workset = spark.read.parquet(models.workset)
    at_end = lambda name: tables[name].read(current[name], tables[name].touched(workset))
    version = 1 + max((t.manifest() or {"version": 0})["version"] for t in (models.fact, models.bridge))
    fact = replace_in(models.fact, workset, fact_issue(of_workset(at_end("issues"), workset)), version)
    bridge = replace_in(models.bridge, workset, bridge_issue_label(of_workset(at_end("relations"), workset)), version)
    full_fact, full_bridge = fact_issue(issues.read(current["issues"])), bridge_issue_label(relations.read(current["relations"]))
    for name, differences in (("fact", diff_by_buckets(models.fact.preview(fact), full_fact, ISSUE_KEY, ["source_run_id"])), ("bridge", diff_by_buckets(models.bridge.preview(bridge), full_bridge, ISSUE_KEY))):
        if not differences.isEmpty():
            raise RefusedBatch(f"the {name} differs from a full build")
    if before_commit:
        before_commit()
    models.fact.publish(fact, at, source_versions=current)
    models.bridge.publish(bridge, at, source_versions=current)
    reached = [(consumer, name, end, run_id) for name, (_, end) in sorted(ranges.items())]
    rows = spark.createDataFrame(reached, "consumer_name string, source_table string, last_version long, last_run_id string").withColumn("updated_at", F.lit(at).cast("timestamp"))
    then = (models.positions.manifest() or {"version": 0})["version"] + 1
    models.positions.commit(commit_positions(stored, rows), None, then, at)
    return Published(ranges, n, current)
