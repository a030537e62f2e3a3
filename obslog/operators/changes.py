"""The change log: which keys really changed, and how far a consumer has read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from obslog.operators.state import AFTER, BEFORE, DELETE, INSERT
from obslog.schemas import EntitySpec
from obslog.sources.store import UnreadableRange

META = ("_change_type", "_commit_version", "_commit_timestamp")


__all__ = ["UnreadableRange", "business_columns", "change_range", "changed_keys", "plan_ranges", "real_changes", "unreadable_ranges", "write_workset"]


def change_range(feed: DataFrame, start: int, end: int, table: str = "feed", check: bool = False) -> DataFrame:
    """Change rows of the versions start to end, both included, of a feed at hand; `VersionedTable.changes` reads a stored one.

    With `check`, versions outside the log give an error that names the table and the range;
    it looks at the log's first and last version only."""
    if check:
        lo, hi = feed.agg(F.min("_commit_version"), F.max("_commit_version")).first()
        if start > end or lo is None or start < lo or end > hi:
            raise UnreadableRange(f"{table}: versions {start} to {end} can't be read; the log has {lo} to {hi}")
    return feed.where(F.col("_commit_version").between(start, end))


def unreadable_ranges(requests: DataFrame, logs: DataFrame) -> DataFrame:
    """Requested ranges (source_table, start_version, end_version) that a log (source_table, first_version, last_version) doesn't hold, with first and last."""
    joined = requests.join(logs.select("source_table", "first_version", "last_version"), "source_table", "left")
    held = (F.col("start_version") <= F.col("end_version")) & (F.col("start_version") >= F.col("first_version")) & (F.col("end_version") <= F.col("last_version"))
    return joined.where(~F.coalesce(held, F.lit(False)))


def write_workset(workset: DataFrame, path: str, keys: Sequence[str]) -> int:
    """Replace the workset at `path` by the distinct keys of this one; returns their number, counted on the way."""
    seen = Observation()
    workset.select(*keys).distinct().observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return seen.get["n"]


def business_columns(feed: DataFrame, lineage: Sequence[str]) -> list[str]:
    """All columns but the feed's own and lineage; a lineage column that isn't there is an error."""
    unknown = sorted(set(lineage) - set(feed.columns))
    if unknown:
        raise ValueError(f"unknown lineage columns: {unknown}")
    return [c for c in feed.columns if c not in META and c not in lineage]


def real_changes(feed: DataFrame, spec: EntitySpec, lineage: Sequence[str] | None = None) -> DataFrame:
    """(keys, _commit_version, change): inserts, deletes, and updates that change a business column.

    One aggregation per key and commit puts the two images of an update side by side, so
    that the feed is shuffled once and never joined with itself. Nulls equal nulls. A value
    that changes and changes back in later commits counts each time."""
    lineage = spec.lineage if lineage is None else lineage
    rest = [c for c in business_columns(feed, lineage) if c not in spec.keys]
    if not rest:  # an update can change nothing, so that there are no images to compare
        kinds = feed.where(F.col("_change_type").isin(INSERT, DELETE)).groupBy(*spec.keys, "_commit_version").agg(F.max(F.col("_change_type") == INSERT).alias("i"))
        return kinds.select(*spec.keys, "_commit_version", F.when(F.col("i"), INSERT).otherwise(DELETE).alias("change"))
    image = F.struct(*rest)
    of = lambda kind: F.max(F.when(F.col("_change_type") == kind, image))
    has = lambda kind: F.max((F.col("_change_type") == kind).cast("int"))
    per = feed.groupBy(*spec.keys, "_commit_version").agg(of(BEFORE).alias("b"), of(AFTER).alias("a"), has(INSERT).alias("i"), has(DELETE).alias("d"), has(AFTER).alias("u"), has(BEFORE).alias("w"))
    change = F.when(F.col("i") == 1, INSERT).when(F.col("d") == 1, DELETE).when((F.col("u") == 1) & (F.col("w") == 1) & ~F.col("b").eqNullSafe(F.col("a")), "update")
    return per.select(*spec.keys, "_commit_version", change.alias("change")).where("change IS NOT NULL")


def changed_keys(feeds: Sequence[tuple[DataFrame, EntitySpec]], keys: Sequence[str]) -> DataFrame:
    """Distinct parent keys that changed in any of the feeds: the workset."""
    out = None
    for feed, spec in feeds:
        part = real_changes(feed, spec).select(*keys)
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def plan_ranges(positions: DataFrame, baselines: DataFrame, current: DataFrame) -> DataFrame:
    """(source_table, start_version, end_version, status) for each table of a consumer.

    positions and baselines: (source_table, version) last read; current: newest versions. A
    range starts after the position, or after the baseline on a first run. status: ready,
    idle (nothing new), or an error: no start, two starts, not current, behind."""
    p = positions.select("source_table", F.col("version").alias("p"))
    b = baselines.select("source_table", F.col("version").alias("b"))
    c = current.select("source_table", F.col("version").alias("c"))
    all_ = c.join(p, "source_table", "full_outer").join(b, "source_table", "full_outer")
    start = F.coalesce("p", "b") + 1
    status = (
        F.when(F.col("c").isNull(), "not current")
        .when(F.col("p").isNotNull() & F.col("b").isNotNull(), "two starts")
        .when(F.col("p").isNull() & F.col("b").isNull(), "no start")
        .when(start > F.col("c") + 1, "behind")
        .when(start > F.col("c"), "idle")
        .otherwise("ready")
    )
    return all_.select("source_table", start.alias("start_version"), F.col("c").alias("end_version"), status.alias("status"))
