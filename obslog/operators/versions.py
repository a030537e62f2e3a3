"""Frozen inputs: commits, versions as of a time, allow-listed runs, manifests and replays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from obslog.functions.keys import told, told_list
from obslog.operators import entities as E
from obslog.operators.contracts import Rule, blank, duplicate_keys
from obslog.operators.state import conflicts
from obslog.sources.folder import cut
from obslog.sources.store import Files, VersionedTable


def as_of(log: DataFrame, version: int | Column) -> DataFrame:
    """The log as it was at a version. The version is the partition column, so files prune."""
    return log.where(F.col("_commit_version") <= (F.lit(version) if isinstance(version, int) else version))


def at_version(state: DataFrame, version: int) -> DataFrame:
    """A state table, which keeps each version whole, at one version."""
    return state.where(F.col("_commit_version") == version)


def commits(log: DataFrame, committed_at: str = "_ingested_at") -> DataFrame:
    """(version, committed_at, rows) of each commit."""
    return log.groupBy(F.col("_commit_version").alias("version")).agg(F.max(committed_at).alias("committed_at"), F.count("*").alias("rows"))


def resolve_version(commit_rows: DataFrame, cutoff: Column) -> DataFrame:
    """One row: the newest version committed at or before the cutoff; null if there is none."""
    return commit_rows.where(F.col("committed_at") <= cutoff).agg(F.max("version").alias("version"))


def frozen_input(log: DataFrame, manifest: DataFrame) -> DataFrame:
    """The rows of a manifest's repository, version and runs, each marked with manifest_id.

    It is an equality join by repository and run: Spark broadcasts the runs where they are few."""
    allowed = manifest.select(
        "manifest_id", F.col("repository_owner").alias("_owner"), F.col("repository_name").alias("_name"), F.col("bronze_version").alias("_version"), F.explode("successful_run_ids").alias("_allowed")
    )
    inside = (F.col("repository_owner") == F.col("_owner")) & (F.col("repository_name") == F.col("_name")) & (F.col("_run_id") == F.col("_allowed")) & (F.col("_commit_version") <= F.col("_version"))
    return log.join(allowed, inside).drop("_owner", "_name", "_version", "_allowed")


def marked_input(log: DataFrame, manifest: DataFrame, mark: str = "frozen") -> DataFrame:
    """All of the log, and whether a row is in the frozen input of any of the manifests."""
    runs = manifest.select(F.col("repository_owner").alias("_owner"), F.col("repository_name").alias("_name"), F.col("bronze_version").alias("_version"), F.explode("successful_run_ids").alias("_allowed"))
    runs = runs.groupBy("_owner", "_name", "_allowed").agg(F.max("_version").alias("_version"))
    inside = (F.col("repository_owner") == F.col("_owner")) & (F.col("repository_name") == F.col("_name")) & (F.col("_run_id") == F.col("_allowed"))
    return log.join(runs, inside, "left").withColumn(mark, F.coalesce(F.col("_commit_version") <= F.col("_version"), F.lit(False))).drop("_owner", "_name", "_version", "_allowed")


def missing_runs(log: DataFrame, manifest: DataFrame) -> DataFrame:
    """(manifest_id, run_id) of the allow-listed runs that have no row in the frozen input."""
    wanted = manifest.select("manifest_id", F.explode("successful_run_ids").alias("run_id"))
    found = frozen_input(log, manifest).select("manifest_id", F.col("_run_id").alias("run_id")).distinct()
    return wanted.join(found, ["manifest_id", "run_id"], "left_anti")


def require_frozen_input(log: DataFrame, manifest: DataFrame) -> DataFrame:
    """The frozen input; an error if its version is not in the log or a listed run has no rows."""
    newest = log.agg(F.max("_commit_version")).first()[0]
    asked = manifest.agg(F.max("bronze_version")).first()[0]
    if newest is None or asked is None or asked > newest:
        raise ValueError(f"version {asked} is not in the log, whose newest is {newest}")
    missing = [r.run_id for r in missing_runs(log, manifest).limit(20).collect()]
    if missing:
        raise ValueError(f"runs without rows in the frozen input: {sorted(missing)}")
    return frozen_input(log, manifest)


def replay(observations: DataFrame, manifest_id: Column, execution_id: Column, kinds: Sequence[str] = tuple(E.KINDS)) -> dict[str, DataFrame]:
    """The four current-state tables of one frozen input, or some of them, marked with where they come from.

    The input is read and parsed once: what `newest_of_each` gives of these tables is written, and they
    are read off it. A malformed observation, however old and in whatever table, fails it before any table is there."""
    return _tables(E.newest_written(observations, kinds=kinds), manifest_id, execution_id, kinds)


def replay_marked(observations: DataFrame, mark: str, manifest_id: Column, execution_id: Column, kinds: Sequence[str] = tuple(E.KINDS)) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """(the replay of the marked observations, the replay of all of them): two of `replay` from one read, one parse and one exchange."""
    newest = E.newest_written(observations, kinds=kinds, within=mark)
    return _tables(newest.where(F.col(mark)), manifest_id, execution_id, kinds), _tables(newest.where("_newest"), manifest_id, execution_id, kinds)


def _tables(newest: DataFrame, manifest_id: Column, execution_id: Column, kinds: Sequence[str]) -> dict[str, DataFrame]:
    return {k: E.entity_table(newest, k).withColumn("manifest_id", manifest_id).withColumn("replay_execution_id", execution_id) for k in kinds}


def write_replay(tables: dict[str, DataFrame], path: str) -> dict[str, int]:
    """Write a replay's tables under a path of its own, none of which may be there; returns the rows of each, counted on the way."""
    there = [k for k in tables if Files(next(iter(tables.values())).sparkSession).names(f"{path.rstrip('/')}/{k}")]
    if there:
        raise ValueError(f"a replay is written once; there already: {sorted(there)}")
    return {k: write_once(v, f"{path.rstrip('/')}/{k}") for k, v in tables.items()}


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) of some tables."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_once(df: DataFrame, path: str) -> int:
    """Write a result to a path that must not exist; returns the rows written, counted on the way."""
    seen = Observation()
    df.observe(seen, F.count("*").alias("n")).write.mode("errorifexists").parquet(path)
    return seen.get["n"]


def freeze(tables: dict[str, DataFrame | VersionedTable], versions: dict[str, int], path: str) -> dict[str, int]:
    """Copy state tables at pinned versions under `path`; every check comes before the first write.

    A versioned table is read as its manifest of that version says; a version that isn't kept is an error."""
    if set(tables) != set(versions):
        raise ValueError(f"tables and versions differ: {sorted(set(tables) ^ set(versions))}")
    pinned = {k: v.read(versions[k]) if isinstance(v, VersionedTable) else at_version(v, versions[k]) for k, v in tables.items()}
    empty = [k for k, v in pinned.items() if v.isEmpty()]
    if empty:
        raise ValueError(f"no rows at the pinned version: {sorted(empty)}")
    return {k: write_once(v, f"{path.rstrip('/')}/{k}") for k, v in pinned.items()}


MANIFEST_RULES: list[Rule] = [
    *[blank(c) for c in ("repository_owner", "repository_name", "bronze_table", "code_commit", "transformation_version")],
    ("bronze_version negative", lambda: F.col("bronze_version").isNull() | (F.col("bronze_version") < 0)),
    ("no runs", lambda: F.col("successful_run_ids").isNull() | (F.size("successful_run_ids") == 0)),
    ("runs repeat", lambda: F.coalesce(F.size("successful_run_ids") != F.size(F.array_distinct("successful_run_ids")), F.lit(False))),
    ("run blank", lambda: F.coalesce(F.exists("successful_run_ids", lambda r: F.length(F.trim(r)) == 0), F.lit(False))),
    ("cutoff missing", lambda: F.col("cutoff_at").isNull()),
]


def ineligible_runs(run_ids: DataFrame, ledger: DataFrame, cutoff: Column) -> DataFrame:
    """(run_id, reason) of asked runs that are unknown, not succeeded, or finished after the cutoff."""
    known = ledger.select("run_id", "status", "finished_at")
    reason = (
        F.when(F.col("status").isNull(), "unknown")
        .when(F.col("status") != "succeeded", "not succeeded")
        .when(F.col("finished_at").isNull() | (F.col("finished_at") > cutoff), "finished after the cutoff")
    )
    return run_ids.select("run_id").join(known, "run_id", "left").select("run_id", reason.alias("reason")).where("reason IS NOT NULL")


def versions_at(requests: DataFrame, commit_rows: DataFrame, table: str = "bronze_table", cutoff: str = "cutoff_at") -> DataFrame:
    """`requests` with bronze_version: the newest version of their table that was committed at or before their cutoff, or null.

    Commits (version, committed_at, and the table's name if they are of several tables) and
    requests are ordered by time together, and a request takes the newest version before it: one
    exchange by table, and no pair of a request and a commit is formed."""
    name = F.col(table) if table in commit_rows.columns else F.lit(None).cast("string")
    request = F.struct(*[F.col(f"`{c}`") for c in requests.columns])
    events = commit_rows.select(name.alias("_table"), F.col("committed_at").alias("_at"), F.lit(0).alias("_turn"), F.col("version").alias("_version"), F.lit(None).cast(requests.schema.simpleString()).alias("_request"))
    asked = requests.select((F.col(table) if table in commit_rows.columns else F.lit(None).cast("string")).alias("_table"), F.col(cutoff).alias("_at"), F.lit(1).alias("_turn"), F.lit(None).cast("long").alias("_version"), request.alias("_request"))
    so_far = Window.partitionBy("_table").orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, 0)
    placed = events.unionByName(asked).withColumn("_version", F.max("_version").over(so_far))
    return placed.where("_turn = 1").select("_request.*", F.col("_version").alias("bronze_version"))


MANIFEST_CONTENT = ["repository_owner", "repository_name", "bronze_table", "bronze_version", "successful_run_ids", "cutoff_at", "code_commit", "transformation_version"]


def manifest_id() -> Column:
    """The id of a manifest's content: equal contents, with sorted runs and the cutoff in microseconds, and no others, have equal ids."""
    of = {"successful_run_ids": told_list("successful_run_ids"), "cutoff_at": told(F.unix_micros("cutoff_at"))}
    return F.concat(F.lit("manifest-"), F.substring(F.sha2(F.concat(*[of[c] if c in of else told(c) for c in MANIFEST_CONTENT]), 256), 1, 16))


def build_manifest(requests: DataFrame, commit_rows: DataFrame, ledger: DataFrame, log: DataFrame) -> DataFrame:
    """Manifests of requests (owner, name, table, run_ids, cutoff_at, code_commit, transformation_version).

    An input has to be readable before it gets an id: every run has succeeded by the cutoff
    and has rows of the repository in the log at the version. A request of which that isn't
    true, one without runs, or one whose cutoff is before the first commit gives no manifest (`ineligible_runs` and
    `unreadable_runs` say why). The log is read for its runs only."""
    numbered = versions_at(requests, commit_rows).where("bronze_version IS NOT NULL").withColumn("successful_run_ids", F.array_sort("run_ids"))
    numbered = numbered.withColumn("_request", F.sha2(F.concat(*[told_list(c) if c == "successful_run_ids" else told(F.unix_micros(c) if c == "cutoff_at" else c) for c in MANIFEST_CONTENT]), 256))
    runs = numbered.select("_request", "repository_owner", "repository_name", "bronze_version", "cutoff_at", F.explode("successful_run_ids").alias("run_id"))
    good = (F.col("status") == "succeeded") & (F.col("finished_at") <= F.col("cutoff_at")) & (F.col("_first") <= F.col("bronze_version"))
    judged = runs.join(ledger.select("run_id", "status", "finished_at"), "run_id", "left").join(first_versions(log), ["repository_owner", "repository_name", "run_id"], "left")
    eligible = judged.groupBy("_request").agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).alias("ok")).where("ok = 1").drop("ok")
    return numbered.join(eligible, "_request", "left_semi").select(manifest_id().alias("manifest_id"), *MANIFEST_CONTENT)


def first_versions(log: DataFrame) -> DataFrame:
    """(repository_owner, repository_name, run_id, _first): the first version at which a run has rows of a repository."""
    return log.groupBy("repository_owner", "repository_name", F.col("_run_id").alias("run_id")).agg(F.min("_commit_version").alias("_first"))


def unreadable_runs(requests: DataFrame, commit_rows: DataFrame, log: DataFrame) -> DataFrame:
    """(repository_owner, repository_name, run_id) of asked runs that have no row of the repository at the request's version."""
    runs = versions_at(requests, commit_rows).select("repository_owner", "repository_name", "bronze_version", F.explode("run_ids").alias("run_id"))
    found = runs.join(first_versions(log), ["repository_owner", "repository_name", "run_id"], "left")
    return found.where(~F.coalesce(F.col("_first") <= F.col("bronze_version"), F.lit(False))).select("repository_owner", "repository_name", "run_id").distinct()


class ManifestConflict(ValueError):
    """A manifest whose id is stored with other content."""


def store_manifests(table: VersionedTable, built: DataFrame, at: str) -> int:
    """Insert manifests whose id isn't stored, and verify that the others are what is stored; returns how many were inserted.

    Nothing is written if any differs. A manifest once stored is never changed."""
    mine = cut(built.select([f.name for f in table.schema]).distinct())
    touched = table.touched(mine)
    stored = table.read(buckets=touched)
    wrong = [r.manifest_id for r in conflicts(stored, mine, ["manifest_id"]).select("manifest_id").limit(20).collect()]
    if wrong or not duplicate_keys(mine, ["manifest_id"]).isEmpty():
        raise ManifestConflict(f"stored with other content: {sorted(wrong)}")
    new = mine.join(stored.select("manifest_id"), "manifest_id", "left_anti").select(mine.columns)
    n = new.count()
    if n:
        table.commit(stored.unionByName(new), touched, 1 + max(table.versions(), default=0), at)
    return n


def manifest_runs(manifest: DataFrame, ledger: DataFrame) -> DataFrame:
    """(manifest_id, run_id, finished_at) of a manifest's runs that succeeded."""
    done = ledger.where("status = 'succeeded'").select("run_id", "finished_at")
    return manifest.select("manifest_id", F.explode("successful_run_ids").alias("run_id")).join(done, "run_id").select("manifest_id", "run_id", "finished_at")
