"""The registered queries: operators applied to the test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslog import schemas
from obslog.functions.keys import date_key, hash_key
from obslog.operators import changes, compare, contracts, control, entities, incremental, snapshots, star, state, versions
from obslog.schemas import ISSUES, LABELS, OBSERVATION, RELATIONS, USERS, EntitySpec, null_counts
from obslog.sources import adapters, log
from obslog.sources.folder import cut, discard, new_path
from obslog.sources.store import VersionedTable
from obslog.streaming import ingest

#: The calendar that the test tables' dates need.
CALENDAR = ("1990-01-01", "2035-12-31")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    """Register f under its name. It runs under UTC and gives instants as timestamps without zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        df = f(spark, sf_dir)
        return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in df.dtypes])

    QUERIES[f.__name__] = run
    return f


def _log(spark: SparkSession, sf_dir: str, *runs: str) -> DataFrame:
    out = adapters.observations(spark, sf_dir)
    return out.where(F.col("_run_id").isin(*runs)) if runs else out


def _scope(observations: DataFrame) -> DataFrame:
    return entities.observed_scope(observations)


#: What the states are folded from: an observation's issue, and the labels that it names.
_SEEN = [*entities.ISSUE_COLUMNS, "label_ids", "observed_at"]


class _States:
    """Issues and relations after run 1 and after run 4, and their change logs for versions 2 to 4; a query folds what it asks for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.newest = _newest_of_runs(spark, sf_dir)
        number = F.create_map(*[x for run, (v, *_) in adapters.RUNS.items() for x in (F.lit(run), F.lit(v))])
        self.rows = self.newest.withColumn("_version", number[F.col("source_run_id")])
        self.committed = {v: at for v, at, *_ in adapters.RUNS.values()}
        self.first_issues, self.first_relations = _both(_of(self.newest, "run_1"))
        self.written: list[DataFrame] = [self.newest]

    def _keep(self, df: DataFrame) -> DataFrame:
        """All that is folded lies in buckets of the issue's key, by which it is grouped, ranked and joined."""
        self.written.append(cut(df, star.ISSUE_KEY))
        return self.written[-1]

    @functools.cached_property
    def folded_issues(self) -> state.Folded:
        """All four runs folded at once; the first run's rows are no changes."""
        return state.folded_upserts(self.rows.select(*entities.ISSUE_COLUMNS, "_version"), ISSUES, self.committed, keep=self._keep)

    @functools.cached_property
    def folded_relations(self) -> state.Folded:
        seen = self.rows.select(*star.ISSUE_KEY, "observed_at", "source_run_id", "label_ids", "_version")
        return state.folded_reconciles(seen, "label_ids", "label_id", self.committed, star.ISSUE_KEY, keep=self._keep)

    issues = property(lambda self: self.folded_issues.state)
    issue_feed = property(lambda self: self.folded_issues.changes.where("_commit_version > 1"))
    relations = property(lambda self: self.folded_relations.state)
    relation_feed = property(lambda self: self.folded_relations.changes.where("_commit_version > 1"))


def _newest_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue and labels of the newest observation of each issue in each run: one pass parses, judges and ranks the log, and only these are written."""

    def rows(parsed: DataFrame) -> DataFrame:
        wide = contracts.checked(entities.everything(parsed), entities.ALL_RULES, "observations")
        return wide.withColumn("label_ids", F.transform("labels", lambda x: x["id"]))

    return entities.newest(_log(spark, sf_dir), rows, ["source_run_id", *ISSUES.keys], ["_source_updated_at", "_ingested_at", "_page_or_batch_reference", "raw_json"], _SEEN, by=ISSUES.keys)


def _of(newest: DataFrame, run: str) -> DataFrame:
    return newest.where(F.col("source_run_id") == run)


def _both(newest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Issues and relations of the newest observations."""
    return newest.select(*entities.ISSUE_COLUMNS), newest.select(*star.ISSUE_KEY, F.explode("label_ids").alias("label_id"), "observed_at", "source_run_id")


def _stored(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, VersionedTable]:
    """Issues and relations (or one of them) as versioned tables after four runs; change rows are stored from the second on.

    All runs are folded at once, and each version's commit reads the fold: no old state is joined with a run."""
    s = _States(spark, sf_dir)
    folds = {name: fold() for name, fold in (("issues", lambda: s.folded_issues), ("relations", lambda: s.folded_relations)) if name in (names or ("issues", "relations"))}
    tables = {name: VersionedTable(spark, new_path(spark, name), fold.state.schema, {"issues": ISSUES, "relations": RELATIONS}[name].keys, buckets=8, keep=4, feed=True, bucket_by=star.ISSUE_KEY, gathered=False) for name, fold in folds.items()}
    for run, (version, at, *_) in adapters.RUNS.items():
        touched = None if version == 1 else next(iter(tables.values())).touched(_of(s.newest, run))
        for name, table in tables.items():
            now = folds[name].at(version)
            changed = None if version == 1 else folds[name].changes.where(F.col("_commit_version") == version)
            table.commit(now if touched is None else now.where(table.bucket().isin(touched)), touched, version, at, changed)
    discard(*s.written)
    return tables


# --- ingest


@query
def observe_payloads(spark, sf_dir):
    p = adapters.payloads(spark, sf_dir)
    seen = log.observe(p, F.col("owner"), F.col("name"), F.col("run"), adapters.run_value(F.col("run"), 1, "timestamp"), F.col("batch"))
    return contracts.valid(seen, contracts.OBSERVATION_RULES).select("repository_owner", "repository_name", "issue_id", "source_updated_at", "_run_id", "_ingested_at", "_page_or_batch_reference")


@query
def observation_log(spark, sf_dir):
    path = new_path(spark, "log")
    for run, (version, *_) in adapters.RUNS.items():
        log.append(_log(spark, sf_dir, run).withColumn("_request_watermark", F.lit(None).cast("timestamp")), path, version)
    return log.read_log(spark, path).groupBy("_commit_version", "_run_id").agg(F.count("*").alias("n_rows"), F.countDistinct("issue_id").alias("n_issues"))


@query
def schema_contract(spark, sf_dir):
    return null_counts(_log(spark, sf_dir), OBSERVATION)


@query
def incremental_extract(spark, sf_dir):
    return log.incremental(_log(spark, sf_dir), "2001-07-01 00:05:00").select("issue_id", "_run_id", "_page_or_batch_reference", "source_updated_at")


@query
def candidate_watermark(spark, sf_dir):
    return log.candidate_watermark(_log(spark, sf_dir, "run_2"), "2001-01-01 00:00:00")


@query
def ingest_batches(spark, sf_dir):
    rows = log.batches(_log(spark, sf_dir), 100, "issue_id", "_page_or_batch_reference")
    return rows.groupBy("_run_id", "batch").agg(F.count("*").alias("n_rows"), F.min("issue_id").alias("first_issue"))


@query
def scoped_run_latest(spark, sf_dir):
    return entities.latest_issues(log.of_run(_log(spark, sf_dir), "run_1")).select("repository_owner", "repository_name", "issue_id", "title", "state", "updated_at")


# --- parse and latest


@query
def parse_issues(spark, sf_dir):
    return entities.issues(entities.parsed(_log(spark, sf_dir))).select(*entities.ISSUE_COLUMNS, "_page_or_batch_reference")


@query
def pull_request_flag(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    kind = F.when(F.col("o_orderkey") % 3 == 0, ',"pull_request":{"url":"x"}').when(F.col("o_orderkey") % 3 == 1, ',"pull_request":null').otherwise("")
    raw = F.concat(F.lit('{"id":'), (F.col("o_orderkey") + 1).cast("string"), kind, F.lit("}"))
    return o.select((F.col("o_orderkey") + 1).alias("issue_id"), entities.is_pull_request(raw).alias("is_pull_request"))


@query
def canonical_payloads(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    a = F.concat(F.lit('{"title": "t", "pull_request":{"url":"u", "n":null}, "id":'), F.col("o_orderkey").cast("string"), F.lit(', "state":null, "labels":[{"b":1,"a":[]}]}'))
    b = F.concat(F.lit('{"state":null,"labels":[ {"a":[],"b":1} ],"id" : '), F.col("o_orderkey").cast("string"), F.lit(',"title":"t","pull_request":{"n":null,"url":"u"}}'))
    return o.select("o_orderkey", log.canonical_json(a).alias("canonical"), (log.canonical_json(a) == log.canonical_json(b)).alias("same"))


@query
def latest_issue(spark, sf_dir):
    return entities.latest_issues(_log(spark, sf_dir))


@query
def latest_issue_of_run(spark, sf_dir):
    """The newest issues of those that the last run saw: the keys come by a semi-join above the guard."""
    rows = _log(spark, sf_dir)
    return entities.latest_issues(rows).join(log.of_run(rows, "run_4").select(*star.ISSUE_KEY), list(star.ISSUE_KEY), "left_semi")


@query
def latest_label(spark, sf_dir):
    return entities.latest_labels(_log(spark, sf_dir)).select("repository_owner", "repository_name", "label_id", "name", "color", "description", "is_default", "observed_at")


@query
def latest_user(spark, sf_dir):
    return entities.latest_users(_log(spark, sf_dir)).select("user_id", "login", "user_type", "observed_at")


@query
def observed_scope(spark, sf_dir):
    return _scope(_log(spark, sf_dir)).select("repository_owner", "repository_name", "issue_id", "observed_at", "source_run_id", F.size("labels").cast("long").alias("n_labels"))


@query
def current_relations(spark, sf_dir):
    return entities.relations_of(_scope(_log(spark, sf_dir)))


@query
def label_observations(spark, sf_dir):
    rows = entities.labels(entities.envelopes(entities.parsed(_log(spark, sf_dir))))
    return rows.select("repository_owner", "repository_name", "source_issue_id", "label_id", "name", "color", "is_default", "source_run_id", "_page_or_batch_reference")


# --- contracts


def _told(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns, F.array_join("violations", "; ").alias("violations"))


@query
def invalid_observations(spark, sf_dir):
    rows = entities.issues(entities.parsed(adapters.observations(spark, sf_dir, flawed=True)))
    return _told(contracts.invalid(rows, contracts.ISSUE_RULES), "issue_id", "source_run_id", "_page_or_batch_reference")


@query
def invalid_label_envelopes(spark, sf_dir):
    rows = entities.envelopes(entities.parsed(adapters.observations(spark, sf_dir, flawed=True)))
    return _told(contracts.invalid(rows, contracts.ENVELOPE_RULES), "issue_id", "source_run_id", "_page_or_batch_reference")


@query
def invalid_labels(spark, sf_dir):
    rows = entities.labels(entities.envelopes(entities.parsed(adapters.observations(spark, sf_dir, flawed=True))))
    return _told(contracts.invalid(rows, contracts.LABEL_RULES), "source_issue_id", "label_id", "source_run_id", "_page_or_batch_reference")


@query
def invalid_users(spark, sf_dir):
    rows = entities.users(entities.parsed(adapters.observations(spark, sf_dir, flawed=True)))
    return _told(contracts.invalid(rows, contracts.USER_RULES), "source_issue_id", "source_run_id", "_page_or_batch_reference")


@query
def duplicate_keys(spark, sf_dir):
    return contracts.duplicate_keys(_log(spark, sf_dir), [*star.ISSUE_KEY, "_run_id"])


@query
def orphan_relations(spark, sf_dir):
    relations = entities.relations_of(_scope(_log(spark, sf_dir)))
    return state.orphan_relations(relations, _scope(_log(spark, sf_dir, "run_1")), star.ISSUE_KEY).select(*star.ISSUE_KEY, "label_id", "source_run_id")


@query
def older_invalid(spark, sf_dir):
    """Malformed observations that are not the newest of their issue: the newest alone would not show them."""
    rows = entities.issues(entities.parsed(adapters.observations(spark, sf_dir, flawed=True)))
    newest = entities.latest_of(rows, ISSUES).select(*star.ISSUE_KEY, "source_run_id", "_page_or_batch_reference")
    return contracts.invalid(rows, contracts.ISSUE_RULES).join(newest, newest.columns, "left_anti").select("issue_id", "source_run_id", "_page_or_batch_reference")


@query
def any_invalid(spark, sf_dir):
    o = adapters.observations(spark, sf_dir, flawed=True)
    found = []
    for name, rows in (("sound", _log(spark, sf_dir)), ("flawed", o)):
        found.append((name, contracts.any_invalid(entities.issues(entities.parsed(rows)), contracts.ISSUE_RULES)))
    return o.groupBy("_run_id").agg(F.count("*").alias("n_rows")).withColumn("found", F.explode(F.array(*[F.struct(F.lit(n).alias("log"), F.lit(x).alias("any_invalid")) for n, x in found]))).select("_run_id", "n_rows", "found.*")


@query
def merge_source_duplicates(spark, sf_dir):
    rows = entities.issues(entities.parsed(_log(spark, sf_dir, "run_1")))
    return contracts.duplicate_keys(rows, ISSUES.keys)


@query
def missing_columns(spark, sf_dir):
    rows = _log(spark, sf_dir).drop("raw_json", "_ingested_at")
    missing = schemas.missing_columns(rows, [f.name for f in OBSERVATION if not f.nullable])
    return rows.groupBy("_run_id").agg(F.count("*").alias("n_rows")).withColumn("column_name", F.explode(F.array(*[F.lit(c) for c in missing])))


@query
def utc_hours(spark, sf_dir):
    schemas.require_utc(spark)
    return _log(spark, sf_dir).groupBy(F.hour("_ingested_at").alias("hour")).agg(F.count("*").alias("n_rows"))


@query
def named_tables(spark, sf_dir):
    adapters.table(spark, sf_dir, "orders").createOrReplaceTempView("obslog_orders")
    return spark.sql("SELECT o_orderstatus, count(*) AS n_rows FROM IDENTIFIER(:prefix || '_orders') WHERE o_totalprice >= :least GROUP BY o_orderstatus", {"prefix": "obslog", "least": 1000.0})


# --- state


@query
def upsert_latest(spark, sf_dir):
    new, _ = state.guarded_upsert(entities.latest_issues(_log(spark, sf_dir, "run_1")), entities.latest_issues(_log(spark, sf_dir, "run_2")), ISSUES)
    return new


@query
def upsert_labels(spark, sf_dir):
    new, _ = state.guarded_upsert(entities.latest_labels(_log(spark, sf_dir, "run_2")), entities.latest_labels(_log(spark, sf_dir, "run_4")), LABELS)
    return new


@query
def upsert_users(spark, sf_dir):
    new, _ = state.guarded_upsert(entities.latest_users(_log(spark, sf_dir, "run_2")), entities.latest_users(_log(spark, sf_dir, "run_4")), USERS)
    return new


@query
def reconcile_relations(spark, sf_dir):
    scope = _scope(_log(spark, sf_dir, "run_2"))
    stored = entities.relations_of(_scope(_log(spark, sf_dir, "run_1")))
    return state.reconcile(stored, scope, entities.relations_of(scope), star.ISSUE_KEY, RELATIONS)[0]


@query
def reconcile_with_parents(spark, sf_dir):
    stored = entities.relations_of(_scope(_log(spark, sf_dir, "run_2")))
    scope = _scope(_log(spark, sf_dir, "run_4"))
    parents = entities.latest_issues(_log(spark, sf_dir, "run_2"))
    return state.reconcile(stored, scope, entities.relations_of(scope), star.ISSUE_KEY, RELATIONS, parent_state=parents)[0]


@query
def stale_relations(spark, sf_dir):
    scope = _scope(_log(spark, sf_dir, "run_2"))
    stored = entities.relations_of(_scope(_log(spark, sf_dir, "run_1")))
    return state.stale_relations(stored, scope, entities.relations_of(scope), star.ISSUE_KEY, RELATIONS.keys).select(*RELATIONS.keys)


@query
def replay_equals_merge(spark, sf_dir):
    runs = ("run_1", "run_2", "run_4")
    rows = _log(spark, sf_dir, *runs)
    kinds = {"issues": ISSUES, "labels": LABELS, "users": USERS}
    each = entities.newest_written(rows, kinds=tuple(kinds), within="source_run_id")
    committed = {adapters.RUNS[run][0]: adapters.RUNS[run][1] for run in runs}
    out = None
    for kind, spec in kinds.items():
        found = entities.entity_table(each, kind).withColumn("_version", adapters.run_value(F.col("source_run_id"), 0, "int"))
        folded, _ = state.fold_upserts(found, spec, committed)
        n = compare.diff_by_buckets(folded, entities.entity_table(each.where("_newest"), kind), spec.keys).agg(F.count("*").alias("differences")).select(F.lit(spec.name).alias("table_name"), "differences")
        out = n if out is None else out.unionByName(n)
    return out


@query
def merge_change_log(spark, sf_dir):
    _, feed = state.guarded_upsert(entities.latest_issues(_log(spark, sf_dir, "run_1")), entities.latest_issues(_log(spark, sf_dir, "run_2")), ISSUES, 2, F.lit(adapters.RUNS["run_2"][1]))
    return feed.select("issue_id", "title", "state", "updated_at", "source_run_id", "_change_type", "_commit_version", "_commit_timestamp")


# --- versions and replay


@query
def as_of_version(spark, sf_dir):
    path = new_path(spark, "log")
    rows = cut(_log(spark, sf_dir))
    for run, (version, *_) in adapters.RUNS.items():
        log.append(log.of_run(rows, run), path, version)
    return versions.as_of(log.read_log(spark, path), 2).select("issue_id", "_run_id", "_commit_version", "_page_or_batch_reference")


@query
def frozen_input(spark, sf_dir):
    return versions.frozen_input(_log(spark, sf_dir), adapters.manifests(spark, sf_dir)).groupBy("manifest_id", "_run_id").agg(F.count("*").alias("n_rows"), F.sum("issue_id").alias("sum_ids"))


@query
def frozen_input_missing_runs(spark, sf_dir):
    m = adapters.manifests(spark, sf_dir)
    return versions.missing_runs(_log(spark, sf_dir), m.withColumn("successful_run_ids", F.array_append("successful_run_ids", F.concat(F.lit("run_of_"), F.col("repository_name")))))


@query
def resolve_version(spark, sf_dir):
    return versions.resolve_version(versions.commits(_log(spark, sf_dir)), F.lit("2001-09-03 23:50:00").cast("timestamp"))


def _replayed(spark, sf_dir, *kinds):
    rows = versions.frozen_input(_log(spark, sf_dir), adapters.manifests(spark, sf_dir))
    return versions.replay(rows, F.lit("m"), F.lit("x"), kinds or tuple(entities.KINDS))


@query
def freeze_counts(spark, sf_dir):
    return versions.row_counts(_replayed(spark, sf_dir))


@query
def replay_issues(spark, sf_dir):
    return _replayed(spark, sf_dir, "issues")["issues"]


@query
def replay_relations(spark, sf_dir):
    return _replayed(spark, sf_dir, "relations")["relations"]


@query
def replay_labels(spark, sf_dir):
    return _replayed(spark, sf_dir, "labels")["labels"]


@query
def replay_users(spark, sf_dir):
    return _replayed(spark, sf_dir, "users")["users"]


@query
def pinned_state(spark, sf_dir):
    """A version of the stored state, frozen after later ones were committed."""
    issues = _stored(spark, sf_dir, "issues")["issues"]
    path = new_path(spark, "frozen")
    versions.freeze({"issues": issues}, {"issues": 2}, path)
    return spark.read.schema(issues.schema).parquet(f"{path}/issues")


def _requests(spark, sf_dir):
    m = adapters.manifests(spark, sf_dir)
    return m.select("repository_owner", "repository_name", "bronze_table", F.reverse("successful_run_ids").alias("run_ids"), "cutoff_at", "code_commit", "transformation_version")


def _ledger(spark, sf_dir):
    return control.run_ledger(adapters.ledger_events(spark, sf_dir))


@query
def build_manifest(spark, sf_dir):
    return _told_manifests(_manifests(spark, sf_dir))


def _manifests(spark, sf_dir):
    rows = cut(_log(spark, sf_dir).select("repository_owner", "repository_name", "_run_id", "_commit_version", "_ingested_at"))
    return versions.build_manifest(_requests(spark, sf_dir), versions.commits(rows), _ledger(spark, sf_dir), rows)


def _told_manifests(built):
    return built.select("manifest_id", "repository_owner", "repository_name", "bronze_version", F.array_join("successful_run_ids", ",").alias("run_ids"), "cutoff_at")


@query
def unreadable_runs(spark, sf_dir):
    """Runs that requests ask for, one of their own among them, without rows of the repository at the version."""
    rows = cut(_log(spark, sf_dir).select("repository_owner", "repository_name", "_run_id", "_commit_version", "_ingested_at"))
    asked = _requests(spark, sf_dir).withColumn("run_ids", F.array_append("run_ids", F.concat(F.lit("run_of_"), F.col("repository_name"))))
    return versions.unreadable_runs(asked, versions.commits(rows), rows)


@query
def stored_manifests(spark, sf_dir):
    """Manifests stored twice: the second time they are only verified."""
    built = cut(_manifests(spark, sf_dir))
    table = VersionedTable(spark, new_path(spark, "manifests"), built.schema, ["manifest_id"], buckets=1)
    inserted = [versions.store_manifests(table, built, adapters.RUNS["run_4"][2]) for _ in range(2)]
    return _told_manifests(table.read()).withColumn("inserted_again", F.lit(inserted[1]).cast("long"))


@query
def ineligible_runs(spark, sf_dir):
    asked = _log(spark, sf_dir).select(F.col("_run_id").alias("run_id")).distinct().unionByName(adapters.table(spark, sf_dir, "region").select(F.col("r_name").alias("run_id")))
    return versions.ineligible_runs(asked, _ledger(spark, sf_dir), F.lit("2001-09-05 00:00:00").cast("timestamp"))


@query
def manifest_conflicts(spark, sf_dir):
    m = adapters.manifests(spark, sf_dir)
    other = m.withColumn("code_commit", F.when(F.length("repository_name") == 8, F.lit("other")).otherwise(F.col("code_commit")))
    return state.conflicts(m, other, ["manifest_id"]).select("manifest_id", "code_commit")


@query
def write_once(spark, sf_dir):
    path = new_path(spark, "result")
    issues = entities.latest_issues(_log(spark, sf_dir, "run_4"))
    n = versions.write_once(issues, path)
    try:
        versions.write_once(issues, path)
        again = True
    except AnalysisException:
        again = False
    return spark.read.parquet(path).groupBy("state").agg(F.count("*").alias("n_rows")).withColumn("written", F.lit(n).cast("long")).withColumn("written_again", F.lit(again))


@query
def invalid_manifests(spark, sf_dir):
    m = adapters.manifests(spark, sf_dir)
    size = F.length("repository_name")
    broken = m.withColumn("code_commit", F.when(size == 5, F.lit(" ")).otherwise(F.col("code_commit"))).withColumn(
        "successful_run_ids", F.when(size == 6, F.array()).when(size == 7, F.concat("successful_run_ids", "successful_run_ids")).otherwise(F.col("successful_run_ids"))
    )
    return _told(contracts.invalid(broken.withColumn("bronze_version", F.when(size == 8, F.lit(-1)).otherwise(F.col("bronze_version"))), versions.MANIFEST_RULES), "manifest_id")


# --- changes


@query
def change_feed_range(spark, sf_dir):
    issues = _stored(spark, sf_dir, "issues")["issues"]
    return issues.changes(3, 4).groupBy("_commit_version", "_change_type").agg(F.count("*").alias("n_rows"))


@query
def real_changes(spark, sf_dir):
    return changes.real_changes(_States(spark, sf_dir).issue_feed, ISSUES)


@query
def real_relation_changes(spark, sf_dir):
    return changes.real_changes(_States(spark, sf_dir).relation_feed, RELATIONS)


def _workset(s: _States) -> DataFrame:
    return changes.changed_keys([(s.issue_feed, ISSUES), (s.relation_feed, RELATIONS)], star.ISSUE_KEY)


@query
def changed_keys(spark, sf_dir):
    return _workset(_States(spark, sf_dir))


@query
def workset_sink(spark, sf_dir):
    s = _States(spark, sf_dir)
    path = new_path(spark, "workset")
    changes.write_workset(s.issues, path, star.ISSUE_KEY)
    n = changes.write_workset(_workset(s), path, star.ISSUE_KEY)
    return spark.read.parquet(path).withColumn("written", F.lit(n).cast("long"))


@query
def repeated_changes(spark, sf_dir):
    real = changes.real_changes(_States(spark, sf_dir).issue_feed, ISSUES)
    return real.groupBy("issue_id").agg(F.count("*").alias("n_commits"), F.max("_commit_version").alias("last_version")).where("n_commits > 1")


@query
def business_values(spark, sf_dir):
    feed = _States(spark, sf_dir).issue_feed
    columns = changes.business_columns(feed, ISSUES.lineage)
    # a column at a time: counted together, each row would be as many rows with all columns
    counts = [feed.select(c).distinct().agg(F.count(c).alias("n_values")).select(F.lit(c).alias("column_name"), "n_values") for c in columns]
    return functools.reduce(DataFrame.unionByName, counts)


@query
def unreadable_ranges(spark, sf_dir):
    c = adapters.table(spark, sf_dir, "customer").select(F.concat(F.lit("t"), F.col("c_nationkey").cast("string")).alias("source_table"), "c_custkey")
    logs = c.groupBy("source_table").agg(F.min("c_custkey").alias("first_version"), F.max("c_custkey").alias("last_version"))
    asked = c.select("source_table", (F.col("c_custkey") - 20).alias("start_version"), (F.col("c_custkey") + 20).alias("end_version"))
    return changes.unreadable_ranges(asked, logs)


@query
def plan_ranges(spark, sf_dir):
    n = adapters.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("version"))
    t = n.select(F.concat(F.lit("t"), F.col("c_nationkey").cast("string")).alias("source_table"), "version", F.col("c_nationkey").alias("k"))
    read = F.when(F.col("k") % 8 == 0, F.col("version")).otherwise(F.col("version") - 3).alias("version")
    positions = t.where("k % 4 IN (0, 2)").select("source_table", read)
    baselines = t.where("k % 4 IN (1, 2)").select("source_table", read)
    return changes.plan_ranges(positions, baselines, t.select("source_table", "version"))


@query
def workset_filter(spark, sf_dir):
    s = _States(spark, sf_dir)
    return incremental.of_workset(s.issues, _workset(s)).select("issue_id", "title", "state")


def _incremental(spark, sf_dir):
    s = _States(spark, sf_dir)
    fact, bridge = star.fact_issue(s.first_issues), star.bridge_issue_label(s.first_relations)
    return incremental.incremental_batch(fact, bridge, s.issues, s.relations, s.issue_feed, s.relation_feed, {"issues": (2, 4), "relations": (2, 4)})


@query
def batch_positions(spark, sf_dir):
    s = _States(spark, sf_dir)
    at = F.lit("2001-09-06 11:00:00").cast("timestamp")
    tables = adapters.table(spark, sf_dir, "region").limit(1).select(F.explode(F.array(F.lit("issues"), F.lit("relations"))).alias("source_table"))
    stored = tables.where("source_table = 'issues'").select(F.lit("model").alias("consumer_name"), "source_table", F.lit(1).cast("long").alias("last_version"), F.lit("run_1").alias("last_run_id"), at.alias("updated_at"))
    baselines = tables.where("source_table = 'relations'").select("source_table", F.lit(1).cast("long").alias("version"))
    fact, bridge = star.fact_issue(s.first_issues), star.bridge_issue_label(s.first_relations)
    return incremental.run_batch(fact, bridge, s.issues, s.relations, s.issue_feed, s.relation_feed, stored, baselines, "model", "run_4", at)[1]


@query
def fact_issue_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir).fact.drop("source_run_id")


@query
def published_fact(spark, sf_dir):
    """The stored fact after a batch that read the stored change logs, rewrote the workset's buckets, compared and published."""
    issues, relations = _stored(spark, sf_dir).values()
    fact, bridge = star.fact_issue(issues.read(1)), star.bridge_issue_label(relations.read(1))
    stored = [VersionedTable(spark, new_path(spark, name), df.schema, keys, buckets=8, bucket_by=star.ISSUE_KEY, gathered=False) for name, df, keys in (("fact", fact, ["issue_key"]), ("bridge", bridge, ["issue_key", "label_key"]))]
    for table, df in zip(stored, (fact, bridge), strict=True):
        table.commit(df, None, 1, adapters.RUNS["run_1"][1])
    kinds = spark.createDataFrame([], "consumer_name string, source_table string, last_version long, last_run_id string, updated_at timestamp").schema
    positions = VersionedTable(spark, new_path(spark, "positions"), kinds, ["consumer_name", "source_table"], buckets=1)
    models = incremental.Models(*stored, positions, new_path(spark, "workset"))
    incremental.publish_batch(models, issues, relations, "model", "run_4", adapters.RUNS["run_4"][2], {"issues": 1, "relations": 1})
    return models.fact.read().drop("source_run_id")


@query
def bridge_incremental(spark, sf_dir):
    return _incremental(spark, sf_dir).bridge


@query
def incremental_batch(spark, sf_dir):
    b = _incremental(spark, sf_dir)
    return versions.row_counts({"workset": b.workset, "fact_differences": b.fact_differences, "bridge_differences": b.bridge_differences, "fact": b.fact, "bridge": b.bridge})


@query
def diff_both_ways(spark, sf_dir):
    a, b = (entities.latest_issues(_log(spark, sf_dir, r)).select("issue_id", "title", "state", "source_run_id") for r in ("run_1", "run_2"))
    return compare.diff_both_ways(a, b, ["source_run_id"]).withColumn("n", F.col("n").cast("long"))


@query
def replay_report(spark, sf_dir):
    """All four tables of a replay of the succeeded runs against those of the whole log, lineage left out."""
    rows = versions.marked_input(_log(spark, sf_dir), adapters.manifests(spark, sf_dir))
    again, live = versions.replay_marked(rows, "frozen", F.lit("m"), F.lit("x"))
    keys = {"issues": ISSUES.keys, "users": USERS.keys, "labels": LABELS.keys, "relations": RELATIONS.keys}
    return compare.compare_report(again, live, keys, {k: ("source_run_id",) for k in keys}, dealt=True)


@query
def lineage_differences(spark, sf_dir):
    return compare.lineage_differences(entities.latest_issues(_log(spark, sf_dir, "run_1", "run_2", "run_4")), entities.latest_issues(_log(spark, sf_dir)), star.ISSUE_KEY)


@query
def unexplained_differences(spark, sf_dir):
    live = entities.latest_issues(_log(spark, sf_dir))
    found = compare.lineage_differences(entities.latest_issues(_log(spark, sf_dir, "run_1")), live, star.ISSUE_KEY)
    return compare.unexplained(found, control.failed_runs(_ledger(spark, sf_dir))).select("left_run", "right_run", "n")


# --- star


def _star(spark, sf_dir):
    rows = _log(spark, sf_dir)
    return star.fact_issue(entities.latest_issues(rows)), star.dim_user(entities.latest_users(rows))


@query
def fact_issue(spark, sf_dir):
    return _star(spark, sf_dir)[0]


@query
def dim_repository(spark, sf_dir):
    return star.dim_repository(entities.latest_issues(_log(spark, sf_dir)))


@query
def dim_user(spark, sf_dir):
    return _star(spark, sf_dir)[1]


@query
def dim_label(spark, sf_dir):
    return star.dim_label(entities.latest_labels(_log(spark, sf_dir)))


@query
def dim_date(spark, sf_dir):
    used = star.fact_issue(entities.latest_issues(_log(spark, sf_dir))).select(F.col("created_date_key").alias("date_key")).distinct()
    return star.dim_date(spark, *CALENDAR).join(used, "date_key")


@query
def bridge_issue_label(spark, sf_dir):
    return star.bridge_issue_label(entities.relations_of(_scope(_log(spark, sf_dir))))


@query
def open_backlog(spark, sf_dir):
    return star.open_backlog(_star(spark, sf_dir)[0])


@query
def top_authors(spark, sf_dir):
    return star.top_authors(*_star(spark, sf_dir))


@query
def issues_per_label(spark, sf_dir):
    newest = entities.newest_written(_log(spark, sf_dir), kinds=("labels", "relations"), columns={"labels": ["name"]})
    return star.issues_per_label(star.bridge_issue_label(entities.entity_table(newest, "relations")), entities.entity_table(newest, "labels"))


@query
def issues_per_month(spark, sf_dir):
    return star.issues_per_month(_star(spark, sf_dir)[0], star.dim_date(spark, *CALENDAR))


@query
def key_agreement(spark, sf_dir):
    """Relations whose keys, by the bridge's formula, are keys of the fact and of the label dimension, by theirs."""
    newest = entities.newest_written(_log(spark, sf_dir), kinds=("issues", "labels", "relations"), columns={"issues": [], "labels": []})
    issues, seen, relations = [entities.entity_table(newest, kind) for kind in ("issues", "labels", "relations")]
    # keys are exchanged as bytes, and the bridge's label key is told once the issue's is known
    fact = issues.select(F.unhex(star.issue_key()).alias("of_issue"), star.repository_key())
    known = relations.select("*", F.unhex(star.issue_key()).alias("of_issue")).join(fact, "of_issue").select(*star.LABEL_KEY, "repository_key")
    known = known.withColumn("of_label", F.unhex(star.label_key())).join(seen.select(F.unhex(star.label_key()).alias("of_label")), "of_label")
    return known.groupBy("repository_owner", "repository_name", "repository_key").agg(F.count("*").alias("n_relations"))


# --- quality


@query
def gate_report(spark, sf_dir):
    fact = star.fact_issue(entities.latest_issues(_log(spark, sf_dir)))
    return contracts.gate_report(fact, "fact_issue", ["issue_key", "author_key", "closed_date_key"], [["issue_key"], ["author_key", "created_date_key"]], {"state": ["open"]})


@query
def gate_failures(spark, sf_dir):
    fact = star.fact_issue(entities.latest_issues(_log(spark, sf_dir)))
    report = contracts.gate_report(fact, "fact_issue", ["issue_key", "closed_date_key"], [["issue_key"]], {"state": ["open"]})
    return contracts.gate_failures(report)


@query
def orphan_foreign_keys(spark, sf_dir):
    fact, users = _star(spark, sf_dir)
    return contracts.orphans(fact, users.where("user_id % 7 <> 0"), "author_key", "user_key")


# --- snapshots


@query
def manifest_runs(spark, sf_dir):
    return versions.manifest_runs(adapters.manifests(spark, sf_dir), _ledger(spark, sf_dir))


def _manifest_observations(spark, sf_dir):
    """Parsed issues of the frozen inputs, with their labels."""
    rows = entities.parsed(versions.frozen_input(_log(spark, sf_dir), adapters.manifests(spark, sf_dir)))
    return entities.issues(rows.withColumn("labels", F.col("_p.labels"))), rows


@query
def manifest_observations(spark, sf_dir):
    return _manifest_observations(spark, sf_dir)[0].groupBy("repository_name", "source_run_id", "state").agg(F.count("*").alias("n_rows"), F.max("updated_at").alias("newest"))


def _covered(spark, sf_dir):
    return snapshots.day_coverage(_ledger(spark, sf_dir).where("status = 'succeeded'"), *adapters.WINDOW)


@query
def day_coverage(spark, sf_dir):
    return _covered(spark, sf_dir)


def _picked(spark, sf_dir):
    frozen = versions.frozen_input(_log(spark, sf_dir), adapters.manifests(spark, sf_dir))
    p = entities.parsed(frozen)
    rows = p.select(
        *star.ISSUE_KEY, F.col("_p.state").alias("state"), log.instant(F.col("_p.created_at")).alias("created_at"), F.col("_p.labels").alias("labels"), F.col("source_updated_at").alias("updated_at"),
        F.col("_run_id").alias("source_run_id"), "_ingested_at", "_page_or_batch_reference",
    )
    order = ["_ingested_at", "updated_at", "source_run_id", "_page_or_batch_reference"]
    return snapshots.as_of_days(rows, _covered(spark, sf_dir).where("coverage = 'observed'"), star.ISSUE_KEY, order, "_ingested_at")


@query
def daily_snapshot(spark, sf_dir):
    return snapshots.fact_daily(_picked(spark, sf_dir))


@query
def daily_snapshot_labels(spark, sf_dir):
    return snapshots.labels_daily(_picked(spark, sf_dir))


@query
def daily_snapshot_events(spark, sf_dir):
    picked = snapshots.as_of_days(adapters.event_observations(spark, sf_dir), adapters.event_days(spark, sf_dir), ["entity_id"], ["at", "event_id"], "at")
    return picked.select("snapshot_date", "entity_id", "state", "k", "event_id")


@query
def backlog_by_day(spark, sf_dir):
    return snapshots.backlog_by_day(snapshots.fact_daily(_picked(spark, sf_dir)))


# --- control


@query
def run_ledger(spark, sf_dir):
    return _ledger(spark, sf_dir)


@query
def invalid_runs(spark, sf_dir):
    before = F.lit("2001-08-15 00:00:00").cast("timestamp").alias("watermark_before_value")
    runs = _ledger(spark, sf_dir).select("*", before)
    broken = runs.withColumn("error_message", F.when(F.col("run_id") == "run_1", F.lit("odd")).when(F.col("run_id") != "run_3", F.col("error_message")))
    return _told(contracts.invalid(broken, control.RUN_RULES), "run_id")


def _stored_watermarks(spark, sf_dir):
    c = adapters.table(spark, sf_dir, "region")
    at = F.lit("2001-08-10 00:00:00").cast("timestamp")
    return c.select(
        F.col("r_name").alias("source_name"), F.lit("issues").alias("entity_name"), F.lit("updated_at").alias("watermark_column"), at.alias("watermark_value"),
        F.lit(300).cast("long").alias("overlap_seconds"), F.lit("run_0").alias("last_successful_run_id"), at.alias("updated_at"),
    )


@query
def commit_watermark(spark, sf_dir):
    ledger = _ledger(spark, sf_dir)
    out = control.commit_watermark(_stored_watermarks(spark, sf_dir), ledger, "ASIA", "issues", "updated_at")
    return control.commit_watermark(out, ledger.where("run_id = 'run_4'"), "EUROPE", "issues", "updated_at")


@query
def commit_positions(spark, sf_dir):
    n = adapters.table(spark, sf_dir, "nation")
    name = F.lit("model").alias("consumer_name")
    at = F.lit("2001-09-06 11:00:00").cast("timestamp").alias("updated_at")
    stored = n.where("n_nationkey < 20").select(name, F.col("n_name").alias("source_table"), F.lit(10).cast("long").alias("last_version"), F.lit("run_1").alias("last_run_id"), at)
    reached = n.where("n_nationkey >= 5").select(name, F.col("n_name").alias("source_table"), F.col("n_nationkey").cast("long").alias("last_version"), F.lit("run_4").alias("last_run_id"), at)
    return control.commit_positions(stored, reached)


@query
def pipeline_health(spark, sf_dir):
    return control.health(_ledger(spark, sf_dir), _stored_watermarks(spark, sf_dir), 3)


@query
def failed_run_watermark(spark, sf_dir):
    return control.commit_watermark(_stored_watermarks(spark, sf_dir), _ledger(spark, sf_dir).where("status <> 'succeeded'"), "ASIA", "issues", "updated_at")


@query
def moved_inputs(spark, sf_dir):
    c = adapters.table(spark, sf_dir, "customer")
    versions_ = lambda rows: rows.groupBy(F.col("c_mktsegment").alias("source_table")).agg(F.countDistinct("c_nationkey").alias("version"))
    owing = c.where("c_acctbal < 0")
    return compare.moved_inputs(versions_(c), versions_(owing))


# --- scalars and streaming


@query
def scalar_functions(spark, sf_dir):
    o = adapters.table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select(
        "o_orderkey",
        hash_key("o_orderstatus", "o_orderkey").alias("key2"),
        hash_key("o_orderkey").alias("key1"),
        date_key(d).alias("date_key"),
        F.year(d).alias("y"),
        F.quarter(d).alias("q"),
        F.month(d).alias("m"),
        F.dayofmonth(d).alias("dom"),
        (F.weekday(d) + 1).alias("iso_day"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.to_date(d).alias("day"),
        F.date_add(F.to_date(d), 1).alias("next_day"),
        F.date_diff(F.lit("2001-09-01").cast("date"), F.to_date(d)).alias("age_days"),
        F.lower("o_orderpriority").alias("low"),
        F.length(F.trim("o_orderpriority")).alias("len"),
        F.col("o_orderpriority").rlike("^[1-3]-").alias("pressing"),
        F.unix_micros(d).alias("micros"),
        F.size(F.array_distinct(F.transform(F.array("o_orderkey", "o_custkey"), lambda x: x % 10))).alias("distinct_digits"),
        F.struct("o_orderkey", "o_orderstatus").eqNullSafe(F.struct("o_orderkey", F.lit("F"))).alias("same"),
        F.col("o_orderstatus").isin("F", "O").alias("listed"),
        F.size(F.sequence(F.to_date(d), F.date_add(F.to_date(d), 3), F.expr("interval 1 day"))).alias("days"),
    )


def _stream(spark, sf_dir) -> VersionedTable:
    """The state, feed and runs of a stream over the event log, a file at a time."""
    spec = EntitySpec("events", ("entity_id",), "at", ("event_id",), ())
    rows = adapters.event_observations(spark, sf_dir)
    landing = new_path(spark, "landing")
    rows.repartition(4, F.to_date("at")).sortWithinPartitions(F.desc("at")).write.parquet(landing)
    table = VersionedTable(spark, new_path(spark, "state"), rows.schema, spec.keys, buckets=8, feed=True)
    ingest.stream_latest_state(ingest.files(spark, landing, rows.schema), table, spec, new_path(spark, "checkpoint")).awaitTermination()
    return table


@query
def stream_latest_state(spark, sf_dir):
    return _stream(spark, sf_dir).read()


@query
def stream_change_feed(spark, sf_dir):
    """What the stored change rows of all batches come to, by entity: its inserts, its updates' images in pairs, and its last image's event."""
    table = _stream(spark, sf_dir)
    feed = table.changes(min(table.versions()), max(table.versions()))
    of = lambda kind: F.count_if(F.col("_change_type") == kind)
    last = F.max_by("event_id", F.when(F.col("_change_type") != state.BEFORE, F.col("_commit_version")))
    return feed.groupBy("entity_id").agg(of(state.INSERT).alias("n_inserts"), (of(state.AFTER) - of(state.BEFORE)).alias("n_unpaired"), of(state.DELETE).alias("n_deletes"), last.alias("event_id"))


@query
def stream_runs(spark, sf_dir):
    """The stream's ledger by status, and the watermark that its runs come to."""
    table = _stream(spark, sf_dir)
    ledger = control.run_ledger(ingest.run_events(table))
    return ledger.groupBy("status").agg(F.max("candidate_watermark_value").alias("watermark"))
