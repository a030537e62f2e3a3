"""Versioned tables, the stored change log, streams that die half-way, and batches that publish."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F
from test_state import log, payload  # noqa: F401

from obslog.operators import changes, control, entities, incremental, star, state, versions
from obslog.operators.star import ISSUE_KEY
from obslog.schemas import ISSUES, RELATIONS, EntitySpec
from obslog.sources.store import CommitConflict, UnreadableRange, VersionedTable, replace_in
from obslog.streaming import ingest

AT = "2026-10-12T00:00:00+00:00"


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


@pytest.fixture
def table(spark, tmp_path):
    schema = spark.createDataFrame([], "k long, v string").schema

    def make(name="t", **options):
        return VersionedTable(spark, f"{tmp_path}/{name}", schema, ["k"], **({"buckets": 4} | options))

    make.rows = lambda *pairs: spark.createDataFrame(list(pairs), schema)
    return make


def pairs(df):
    return sorted((r.k, r.v) for r in df.collect())


def put(t, rows, version):
    """An upsert by key of (k, v) rows, with its change rows."""
    spec = EntitySpec("t", ("k",), "v")
    touched = t.touched(rows)
    new, feed = state.guarded_upsert(t.read(buckets=touched), rows, spec, version, F.lit(AT))
    return t.commit(new, touched, version, AT, feed)


def test_every_kept_version_reads_as_it_was(spark, table):
    t = table(keep=2)
    assert t.read().count() == 0 and t.manifest() is None and t.versions() == []
    put(t, table.rows((1, "a"), (2, "a"), (3, "a")), 1)
    put(t, table.rows((2, "b"), (9, "b")), 5)
    put(t, table.rows((1, "c")), 7)
    assert pairs(t.read()) == pairs(t.read(7)) == [(1, "c"), (2, "b"), (3, "a"), (9, "b")]
    assert pairs(t.read(5)) == [(1, "a"), (2, "b"), (3, "a"), (9, "b")]
    for gone in (1, 6):
        with pytest.raises(UnreadableRange):
            t.read(gone)
    needed = {f for v in (5, 7) for f in t.manifest(v)["buckets"].values()}
    assert set(t.files.names(f"{t.path}/data")) == needed
    assert [(r.version, r.touched) for r in t.log().orderBy("version").collect()][-1] == (7, t.touched(table.rows((1, ""))))


def test_a_bucket_that_becomes_empty(table):
    t = table()
    put(t, table.rows((1, "a"), (2, "a")), 1)
    t.commit(table.rows(), t.touched(table.rows((1, ""))), 2, AT)
    assert (1, "a") not in pairs(t.read())
    t.commit(table.rows(), None, 3, AT)
    assert pairs(t.read()) == []


def test_what_died_before_its_manifest_is_not_there(table):
    t = table(feed=True)
    put(t, table.rows((1, "a")), 1)
    left = t.stage(table.rows((1, "z")), [0, 1, 2, 3], 2, table.rows((1, "z")).selectExpr("*", "'insert' AS _change_type", "current_timestamp() AS _commit_timestamp"))
    assert pairs(t.read()) == [(1, "a")] and pairs(t.preview(left)) == [(1, "z")]
    with pytest.raises(UnreadableRange):
        t.changes(1, 2)
    put(t, table.rows((1, "b")), 2)
    assert pairs(t.read()) == [(1, "b")] and sorted(r.v for r in t.changes(2, 2).collect()) == ["a", "b"]
    assert left.folder not in t.files.names(f"{t.path}/data")


def test_one_of_two_commits_of_a_version_wins(table):
    t = table()
    first, second = (t.stage(table.rows((1, x)), [0, 1, 2, 3], 1) for x in "ab")
    t.publish(first, AT)
    with pytest.raises(CommitConflict):
        t.publish(second, AT)
    with pytest.raises(CommitConflict):
        t.stage(table.rows((1, "c")), [0], 1)
    assert pairs(t.read()) == [(1, "a")]
    assert not t.files.write_new(f"{t.path}/_manifests/{1:020d}.json", "{}") and t.manifest()["version"] == 1


def test_the_change_log_begins_where_it_was_switched_on(table):
    put(table(), table.rows((1, "a"), (2, "a")), 1)
    put(table(), table.rows((1, "b")), 2)
    with pytest.raises(UnreadableRange, match="has no versions"):
        table().changes(1, 2)
    t = table(feed=True)
    for version, row in ((3, (2, "c")), (4, (1, "d")), (6, (5, "e"))):
        put(t, table.rows(row), version)
    assert sorted((r._commit_version, r._change_type, r.k, r.v) for r in t.changes(3, 4).collect()) == [
        (3, "update_postimage", 2, "c"), (3, "update_preimage", 2, "a"), (4, "update_postimage", 1, "d"), (4, "update_preimage", 1, "b")]
    for start, end in ((2, 4), (1, 1), (4, 7), (5, 4)):
        with pytest.raises(UnreadableRange, match="has 3 to 6"):
            t.changes(start, end)
    assert [r.k for r in t.changes(5, 6).collect()] == [5]


def test_a_range_reads_its_partitions_alone(table):
    t = table(feed=True)
    for version in range(1, 6):
        put(t, table.rows((version, "x")), version)
    asked = t.changes(3, 4)
    plan = asked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_commit_version" in plan.split("PartitionFilters")[1].split("]")[0]
    assert asked.select(F.input_file_name().alias("f")).where("f LIKE '%version=3/%' OR f LIKE '%version=4/%'").count() == asked.count() == 2


def test_a_small_workset_rewrites_its_buckets_only(table):
    """One in a hundred keys changes; nothing but their buckets is read or written."""
    t = table(buckets=128)
    t.commit(table.rows(*[(k, "old") for k in range(500)]), None, 1, AT)
    before = t.manifest()["buckets"]
    work = table.rows(*[(k, "new") for k in (3, 77, 150, 301)], (900, "new"))
    staged = replace_in(t, work.union(table.rows((444, "gone"))), work, 2)
    assert len(staged.touched) <= 6 and staged.touched == t.touched(work.union(table.rows((444, ""))))
    t.publish(staged, AT)
    after = t.manifest()["buckets"]
    assert {int(b) for b in after if after[b] != before.get(b)} <= set(staged.touched)
    assert pairs(t.read()) == sorted([(k, "new" if k in (3, 77, 150, 301) else "old") for k in range(500) if k != 444] + [(900, "new")])


def test_freezing_goes_through_the_manifests(spark, table, tmp_path):
    t = table(keep=3)
    for version, value in ((1, "a"), (2, "b"), (3, "c")):
        put(t, table.rows((1, value), (version * 10, "x")), version)
    assert versions.freeze({"t": t}, {"t": 2}, f"{tmp_path}/frozen") == {"t": 3}
    assert pairs(spark.read.parquet(f"{tmp_path}/frozen/t")) == [(1, "b"), (10, "x"), (20, "x")]
    with pytest.raises(UnreadableRange):
        versions.freeze({"t": t, "u": t}, {"t": 2, "u": 9}, f"{tmp_path}/other")
    assert t.files.names(f"{tmp_path}/other") == []


# --- streams


SPEC = EntitySpec("events", ("k",), "at", ("n",), ())
EVENTS = "k long, at timestamp, n long"


@pytest.fixture
def batches(spark):
    return [spark.createDataFrame([(i % 5, at(f"2026-01-{1 + (i * 7) % 28:02d}"), i) for i in range(n * 20, n * 20 + 20)], EVENTS) for n in range(3)]


def contents(t):
    feed = t.changes(min(t.versions()), max(t.versions())).drop("_commit_timestamp")
    return sorted(map(tuple, t.read().collect())), sorted(map(str, feed.collect())), ingest.watermark(t)


def ledger(t):
    return {r.run_id: r for r in control.run_ledger(ingest.run_events(t)).collect()}


def test_a_batch_that_dies_between_its_writes_is_done_again_whole(spark, tmp_path, batches):
    whole, broken = (VersionedTable(spark, f"{tmp_path}/{name}", batches[0].schema, ["k"], buckets=4, feed=True) for name in ("whole", "broken"))
    add = ingest.upsert_batch(whole, SPEC)
    for n, batch in enumerate(batches):
        add(batch, n)

    def die(number):
        raise RuntimeError("the power went")

    ingest.upsert_batch(broken, SPEC)(batches[0], 0)
    seen = contents(broken)
    with pytest.raises(RuntimeError, match="the power went"):
        ingest.upsert_batch(broken, SPEC, before_publish=die)(batches[1], 1)
    assert contents(broken) == seen and broken.versions() == [0]
    runs = ledger(broken)
    assert (runs["stream-0-1"].status, runs["stream-1-1"].status, runs["stream-1-1"].error_message) == ("succeeded", "failed", "the power went")
    assert runs["stream-1-1"].candidate_watermark_value is None
    add = ingest.upsert_batch(broken, SPEC)
    for n, batch in enumerate(batches):
        add(batch, n)
        add(batch, n)  # known: skipped
    assert contents(broken) == contents(whole)
    assert {r: x.status for r, x in ledger(broken).items()} == {"stream-0-1": "succeeded", "stream-1-1": "failed", "stream-1-2": "succeeded", "stream-2-1": "succeeded"}


def test_the_ledger_and_the_watermark_follow_the_commits(spark, tmp_path, batches):
    t = VersionedTable(spark, f"{tmp_path}/t", batches[0].schema, ["k"], buckets=4, feed=True)
    add, marks = ingest.upsert_batch(t, SPEC), []
    early = spark.createDataFrame([(9, at("2020-01-01"), 0)], EVENTS)
    for n, batch in enumerate([*batches, early, early.limit(0)]):
        add(batch, n)
        marks.append(ingest.watermark(t))
    newest = max(r.at for b in batches for r in b.collect())
    assert marks == sorted(marks) and marks[-1] == int(newest.replace(tzinfo=UTC).timestamp() * 1_000_000)
    assert t.versions() == [0, 1, 2, 3, 4] and t.changes(4, 4).count() == 0
    stored = spark.createDataFrame([], "source_name string, entity_name string, watermark_column string, watermark_value timestamp, overlap_seconds long, last_successful_run_id string, updated_at timestamp")
    row = control.commit_watermark(stored, control.run_ledger(ingest.run_events(t)), "events", "state", "at").first()
    assert row.watermark_value == newest and row.last_successful_run_id.startswith("stream-")


def test_a_stream_writes_its_feed(spark, tmp_path, batches):
    for n, batch in enumerate(batches):
        batch.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    t = VersionedTable(spark, f"{tmp_path}/t", batches[0].schema, ["k"], buckets=4, feed=True)
    ingest.stream_latest_state(ingest.files(spark, f"{tmp_path}/in", t.schema), t, SPEC, f"{tmp_path}/c").awaitTermination()
    last = {}
    for r in sorted(t.changes(0, 2).collect(), key=lambda r: (r._commit_version, r._change_type != "update_preimage")):
        if r._change_type == "update_preimage":
            assert last[r.k] == (r.at, r.n)
        else:
            last[r.k] = (r.at, r.n)
    assert last == {r.k: (r.at, r.n) for r in t.read().collect()} and len(last) == 5


# --- batches that publish


ISSUE = "repository_owner string, repository_name string, issue_id long, issue_number long, title string, state string, is_pull_request boolean, author_user_id long, created_at timestamp, updated_at timestamp, closed_at timestamp, source_run_id string"
RELATION = "repository_owner string, repository_name string, issue_id long, label_id long, observed_at timestamp, source_run_id string"
POSITION = "consumer_name string, source_table string, last_version long, last_run_id string, updated_at timestamp"


@pytest.fixture
def silver(spark, tmp_path):
    """Stored issues and relations at versions 1 and 2, and models of version 1."""
    row = lambda i, title, day="12": ("o", "r", i, i, title, "open", False, 7, at("2026-10-09"), at(f"2026-10-{day}"), None, "r2")
    rel = lambda i, k: ("o", "r", i, k, at("2026-10-12"), "r2")
    issues = VersionedTable(spark, f"{tmp_path}/issues", spark.createDataFrame([], ISSUE).schema, ISSUES.keys, buckets=8, feed=True, bucket_by=ISSUE_KEY)
    relations = VersionedTable(spark, f"{tmp_path}/relations", spark.createDataFrame([], RELATION).schema, RELATIONS.keys, buckets=8, feed=True, bucket_by=ISSUE_KEY)
    old, had = spark.createDataFrame([row(i, "old") for i in range(1, 9)], ISSUE), spark.createDataFrame([rel(2, 5), rel(3, 5)], RELATION)
    issues.commit(old, None, 1, AT)
    relations.commit(had, None, 1, AT)
    source = spark.createDataFrame([row(1, "new", "13"), row(2, "old", "13")], ISSUE)
    touched = issues.touched(source)
    new, feed = state.guarded_upsert(issues.read(buckets=touched), source, ISSUES, 2, F.lit(AT))
    issues.commit(new, touched, 2, AT, feed)
    scope = source.select(*ISSUE_KEY, F.col("updated_at").alias("observed_at"), "source_run_id")
    new, feed = state.reconcile(relations.read(buckets=touched), scope, had.where("false"), ISSUE_KEY, RELATIONS, 2, F.lit(AT))
    relations.commit(new, touched, 2, AT, feed)
    fact, bridge = star.fact_issue(old), star.bridge_issue_label(had)
    kept = [VersionedTable(spark, f"{tmp_path}/{name}", df.schema, [key], buckets=8, bucket_by=ISSUE_KEY) for name, df, key in (("fact", fact, "issue_key"), ("bridge", bridge, "issue_key"))]
    for t, df in zip(kept, (fact, bridge), strict=True):
        t.commit(df, None, 1, AT)
    positions = VersionedTable(spark, f"{tmp_path}/positions", spark.createDataFrame([], POSITION).schema, ["consumer_name", "source_table"], buckets=1)
    return issues, relations, incremental.Models(*kept, positions, f"{tmp_path}/workset")


BASE = {"issues": 1, "relations": 1}


def run(silver, baselines=BASE, **options):
    issues, relations, models = silver
    return incremental.publish_batch(models, issues, relations, "c", "r9", AT, baselines, **options)


def stands(models):
    return {(r.consumer_name, r.source_table): r.last_version for r in models.positions.read().collect()}


def test_a_batch_publishes_and_moves_the_positions_last(spark, silver):
    issues, relations, models = silver
    order = []
    for name in ("fact", "bridge", "positions"):
        t = getattr(models, name)
        t.publish = lambda *a, _p=t.publish, _n=name, **k: (order.append(_n), _p(*a, **k))[1]
    out = run(silver)
    assert out.ranges == {"issues": (2, 2), "relations": (2, 2)} and out.workset_rows == 2 and out.positions == {"issues": 2, "relations": 2}
    assert order == ["fact", "bridge", "positions"]
    assert {r.issue_id: r.title for r in models.fact.read().collect()} == {i: "new" if i == 1 else "old" for i in range(1, 9)}
    assert [(r.issue_id, r.label_id) for r in models.bridge.read().collect()] == [(3, 5)]
    assert stands(models) == {("c", "issues"): 2, ("c", "relations"): 2}
    assert len(models.fact.manifest()["touched"]) <= 2 and models.fact.manifest()["source_versions"] == {"issues": 2, "relations": 2}
    again = run(silver, None)
    assert again.ranges == {} and models.fact.versions() == [1, 2]


def test_a_failed_comparison_leaves_models_and_positions_alone(spark, silver):
    models = silver[2]
    spoiled = models.fact.read().withColumn("title", F.when(F.col("issue_id") == 8, "spoiled").otherwise(F.col("title")))
    models.fact.commit(spoiled, None, 5, AT)
    with pytest.raises(incremental.RefusedBatch, match="fact differs"):
        run(silver)
    assert stands(models) == {} and models.fact.versions() == [1, 5] and models.bridge.versions() == [1]
    assert models.fact.read().where("title = 'new'").count() == 0


def test_a_stop_before_the_commit_leaves_positions_alone_and_a_rerun_ends_the_same(spark, silver):
    models = silver[2]

    def stop():
        raise InterruptedError

    with pytest.raises(InterruptedError):
        run(silver, before_commit=stop)
    assert stands(models) == {} and models.fact.versions() == [1] and spark.read.parquet(models.workset).count() == 2
    publish = models.bridge.publish
    models.bridge.publish = lambda *a, **k: stop()
    with pytest.raises(InterruptedError):  # between the two models
        run(silver)
    models.bridge.publish = publish
    assert stands(models) == {} and models.fact.versions() == [1, 2]
    run(silver)
    assert stands(models) == {("c", "issues"): 2, ("c", "relations"): 2}
    assert models.fact.read().where("title = 'new'").count() == 1 and models.bridge.read().count() == 1


def test_a_bad_plan_stops_before_anything_is_built(spark, silver):
    models = silver[2]
    for baselines, told in (({}, "no start"), ({"issues": 1}, "relations: no start"), ({"issues": 7, "relations": 1}, "issues: behind")):
        with pytest.raises(incremental.RefusedBatch, match=told):
            run(silver, baselines)
    assert models.fact.files.names(models.workset) == [] and models.fact.versions() == [1] and stands(models) == {}


# --- replays


def test_a_replay_scans_and_parses_once(spark, log, tmp_path):  # noqa: F811
    newer = payload(1002, labels=[{"id": 301, "name": "renamed", "color": "FFFFFF", "default": False}], updated_at="2026-09-22T00:00:00Z")
    rows = log({"p": payload()}, {"p": newer, "issue": 1002, "updated": "2026-09-22T00:00:00"}, {"p": payload(1003, labels=[], user={"id": 9, "login": "bob", "type": "Bot"}), "issue": 1003})
    rows.write.parquet(f"{tmp_path}/log")
    rows = spark.read.parquet(f"{tmp_path}/log")
    plan = entities.newest_of_each(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("from_json(") == 1 and plan.count("Exchange hashpartitioning") == 1
    tables = versions.replay(rows, F.lit("m"), F.lit("x"))
    plain = {"issues": entities.latest_issues(rows), "users": entities.latest_users(rows), "labels": entities.latest_labels(rows), "relations": entities.relations_of(entities.observed_scope(rows))}
    for name, df in plain.items():
        assert sorted(map(str, tables[name].drop("manifest_id", "replay_execution_id").select(*df.columns).collect())) == sorted(map(str, df.collect())), name
    assert versions.write_replay(tables, f"{tmp_path}/replay") == {"issues": 3, "users": 2, "labels": 1, "relations": 2}
    with pytest.raises(ValueError, match="written once"):
        versions.write_replay(tables, f"{tmp_path}/replay")


def test_a_replay_of_a_malformed_row_writes_nothing(spark, log, tmp_path):  # noqa: F811
    rows = log({"p": payload()}, {"p": payload(labels=[{"id": 1, "name": " ", "color": "x", "default": True}])})
    with pytest.raises(Exception, match="a label is malformed"):
        versions.replay(rows, F.lit("m"), F.lit("x"))


def test_manifests_are_plain_json(table):
    t = table()
    put(t, table.rows((1, "a")), 3)
    assert json.loads(t.files.read(f"{t.path}/_manifests/{3:020d}.json"))["version"] == 3
    assert changes.UnreadableRange is UnreadableRange
