from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from obslog.operators import control, incremental, snapshots, star, versions
from obslog.operators.star import ISSUE_KEY
from obslog.schemas import OBSERVATION, EntitySpec
from obslog.sources import log
from obslog.sources.store import VersionedTable
from obslog.streaming import ingest


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


LOG = "repository_owner string, repository_name string, issue_id long, source_updated_at timestamp, raw_json string, _run_id string, _ingested_at timestamp, _page_or_batch_reference string, _commit_version long"


@pytest.fixture(scope="module")
def history(spark):
    rows = [("o", "r", i, at(w), f'{{"id":{i}}}', run, at(w), "batch-1", v) for i, w, run, v in [(1, "2026-01-01", "run-1", 1), (2, "2026-01-01", "run-1", 1), (1, "2026-01-02", "run-2", 2), (3, "2026-01-03", "run-3", 3)]]
    return spark.createDataFrame(rows, LOG)


MANIFEST = "manifest_id string, repository_owner string, repository_name string, bronze_table string, bronze_version long, successful_run_ids array<string>, cutoff_at timestamp, code_commit string, transformation_version string"


def manifest(spark, version=2, runs=("run-1", "run-2"), owner="o"):
    return spark.createDataFrame([("m", owner, "r", "t", version, list(runs), at("2026-01-02"), "c", "1")], MANIFEST)


def test_later_appends_do_not_change_a_frozen_input(spark, history):
    assert versions.require_frozen_input(history, manifest(spark)).count() == 3
    more = history.union(history.where("_run_id = 'run-1'").withColumn("_commit_version", F.lit(4).cast("long")))
    assert versions.frozen_input(more, manifest(spark)).count() == 3
    assert versions.frozen_input(history, manifest(spark, owner="other")).count() == 0
    assert [r.run_id for r in versions.missing_runs(history, manifest(spark, 2, ("run-1", "run-3"))).collect()] == ["run-3"]
    with pytest.raises(ValueError, match="run-3"):
        versions.require_frozen_input(history, manifest(spark, 2, ("run-1", "run-3")))
    with pytest.raises(ValueError, match="version 9"):
        versions.require_frozen_input(history, manifest(spark, 9))


def test_versions_are_resolved_inclusively(history):
    commits = versions.commits(history)
    at_ = lambda t: versions.resolve_version(commits, F.lit(t).cast("timestamp")).first().version
    assert (at_("2026-01-02 00:00:00"), at_("2026-01-01 23:59:59"), at_("2025-12-31 00:00:00")) == (2, 1, None)
    assert versions.as_of(history, 2).count() == 3


LEDGER = "run_id string, status string, started_at timestamp, finished_at timestamp, candidate_watermark_value timestamp, error_message string"


def test_manifests(spark, history):
    ledger = spark.createDataFrame([("run-1", "succeeded", at("2026-01-01"), at("2026-01-01"), None, None), ("run-2", "succeeded", at("2026-01-02"), at("2026-01-02"), None, None), ("run-3", "failed", at("2026-01-03"), at("2026-01-03"), None, "x")], LEDGER)
    request = "repository_owner string, repository_name string, bronze_table string, run_ids array<string>, cutoff_at timestamp, code_commit string, transformation_version string"
    ask = lambda *runs, cutoff="2026-01-02": spark.createDataFrame([("o", "r", "t", list(runs), at(cutoff), "c", "1")], request)
    build = lambda r: versions.build_manifest(r, versions.commits(history), ledger, history).collect()
    (one,), (two,) = build(ask("run-2", "run-1")), build(ask("run-1", "run-2"))
    assert one.manifest_id == two.manifest_id and one.successful_run_ids == ["run-1", "run-2"] and one.bronze_version == 2
    assert build(ask("run-1"))[0].manifest_id != one.manifest_id
    assert build(ask("run-3")) == [] and build(ask("run-9")) == [] and build(ask("run-2", cutoff="2026-01-01")) == []
    asked = spark.createDataFrame([("run-1",), ("run-2",), ("run-3",), ("run-9",)], "run_id string")
    got = {r.run_id: r.reason for r in versions.ineligible_runs(asked, ledger, F.lit("2026-01-01").cast("timestamp")).collect()}
    assert got == {"run-2": "finished after the cutoff", "run-3": "not succeeded", "run-9": "unknown"}
    from obslog.operators.contracts import invalid

    bad = manifest(spark, -1, ("a", "a", " ")).withColumn("code_commit", F.lit(""))
    assert invalid(bad, versions.MANIFEST_RULES).first().violations == ["code_commit blank", "bronze_version negative", "runs repeat", "run blank"]


def test_a_manifest_needs_readable_rows_and_keeps_apart_what_differs(spark, history, tmp_path):
    from obslog.sources.store import VersionedTable

    ledger = spark.createDataFrame([(r, "succeeded", at("2026-01-01"), at("2026-01-01"), None, None) for r in ("run-1", "run-2", "run-3", "empty")], LEDGER)
    request = "repository_owner string, repository_name string, bronze_table string, run_ids array<string>, cutoff_at timestamp, code_commit string, transformation_version string"
    row = lambda runs=("run-1",), owner="o", table="t", commit="c", version="1", cutoff=at("2026-01-02"): (owner, "r", table, list(runs), cutoff, commit, version)
    build = lambda *rows: versions.build_manifest(spark.createDataFrame(list(rows), request), versions.commits(history), ledger, history)
    assert build(row(("run-1", "empty"))).collect() == []  # succeeded, but without rows
    assert build(row(("run-1", "run-3"))).collect() == []  # rows only after the version
    assert build(row(owner="other")).collect() == [] and build(row(())).collect() == []
    asked = spark.createDataFrame([row(("run-1", "run-3", "empty"))], request)
    assert sorted(r.run_id for r in versions.unreadable_runs(asked, versions.commits(history), history).collect()) == ["empty", "run-3"]
    apart = [row(table="t|c", commit="d"), row(table="t", commit="c|d"), row(cutoff=at("2026-01-02T00:00:00.000001")), row(), row(("run-1", "run-2")), row(commit="")]
    built = build(*apart)
    assert len({r.manifest_id for r in built.collect()}) == len(apart)
    assert [r.bronze_version for r in build(row(cutoff=at("2026-01-01"))).collect()] == [1] and build(row(cutoff=at("2025-12-31"))).collect() == []
    table = VersionedTable(spark, f"{tmp_path}/manifests", built.schema, ["manifest_id"], buckets=2)
    assert versions.store_manifests(table, built, "2026-01-03T00:00:00Z") == 6 and versions.store_manifests(table, built, "2026-01-03T00:00:00Z") == 0
    assert table.versions() == [1] and versions.store_manifests(table, built.limit(0), "2026-01-03T00:00:00Z") == 0
    other = built.limit(1).withColumn("code_commit", F.lit("changed"))
    with pytest.raises(versions.ManifestConflict, match="other content"):
        versions.store_manifests(table, other.union(build(row(version="2"))), "2026-01-04T00:00:00Z")
    assert table.versions() == [1] and table.read().count() == 6


def test_versions_are_found_without_pairs(spark, history):
    commits = spark.createDataFrame([("a", 1, at("2026-01-01")), ("a", 2, at("2026-01-03")), ("b", 7, at("2026-01-02"))], "bronze_table string, version long, committed_at timestamp")
    asked = spark.createDataFrame([("a", at("2026-01-03"), 1), ("a", at("2026-01-02"), 2), ("b", at("2026-01-01"), 3), ("c", at("2026-01-09"), 4), ("a", at("2026-01-03"), 5)], "bronze_table string, cutoff_at timestamp, n int")
    df = versions.versions_at(asked, commits)
    assert {r.n: r.bronze_version for r in df.collect()} == {1: 2, 2: 1, 3: None, 4: None, 5: 2}
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_a_manifest_prunes_the_log(spark, history, tmp_path):
    path = str(tmp_path / "log")
    for v in (1, 2, 3):
        log.append(history.where(F.col("_commit_version") == v), path, v)
    manifest(spark, 2, ("run-2",)).write.parquet(f"{tmp_path}/manifest")
    df = versions.frozen_input(log.read_log(spark, path), spark.read.parquet(f"{tmp_path}/manifest"))
    assert [(r.issue_id, r._run_id) for r in df.collect()] == [(1, "run-2")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "_run_id" in plan.split("PartitionFilters")[1].split("]")[0]
    assert log.of_run(log.read_log(spark, path), "run-3").select(F.input_file_name().alias("f")).where("f LIKE '%_run_id=run-3%'").count() == 1


def test_comparison_by_checksums(spark):
    from obslog.operators import compare

    rows = [(i, None if i % 3 else "x", "x" if i % 2 else None, f"run {i % 4}") for i in range(300)] + [(5, "twice", None, "r")] * 2
    ddl = "k long, a string, b string, run string"
    left, other = spark.createDataFrame(rows, ddl), spark.createDataFrame([(*r[:3], "elsewhere") for r in reversed(rows)], ddl)
    assert compare.differing_buckets(left, other, ["k"], ["run"], 16).count() == 0 and compare.diff_by_buckets(left, other, ["k"], ["run"]).count() == 0
    changed = [(7, "x", None, "r") if r[0] == 7 else r for r in rows if r[0] != 9][:-1] + [(999, None, None, "r")]  # 7: what a hash that passes over nulls wouldn't tell
    right = spark.createDataFrame(changed, ddl)
    assert compare.differing_buckets(left, right, ["k"], ["run"], 64).count() <= 4
    told = lambda df: sorted(map(str, df.select("k", "a", "b", "side", "n").collect()))
    assert told(compare.diff_by_buckets(left, right, ["k"], ["run"], 16)) == told(compare.diff_both_ways(left, right, ["run"])) != []
    grouped = [line for line in compare.differing_buckets(left, other, ["k"])._jdf.queryExecution().executedPlan().toString().splitlines() if "HashAggregate(keys=" in line]
    assert grouped and all("keys=[_groupingexpression" in g or "keys=[bucket" in g or "keys=[pmod" in g for g in grouped)
    report = {r.table_name: tuple(r)[1:] for r in compare.compare_report({"t": left, "u": left}, {"t": other, "u": right}, {"t": ["k"], "u": ["k"]}, {"t": ["run"], "u": ["run"]}).collect()}
    assert report == {"t": (302, 302, 0, 0), "u": (302, 301, 3, 2)}
    with pytest.raises(ValueError, match="tables differ"):
        compare.compare_report({"t": left}, {}, {})
    with pytest.raises(ValueError, match="columns differ"):
        compare.differing_buckets(left, left.drop("a"), ["k"])


def test_log_on_disk(spark, history, tmp_path):
    path = str(tmp_path / "log")
    assert log.append(history.where("_commit_version = 1"), path, 1) == 2
    assert log.append(history.where("_commit_version = 9"), path, 2) == 0
    assert log.append(history.where("_commit_version = 2"), path, 2) == 1
    with pytest.raises(Exception, match="(?i)exists"):
        log.append(history, path, 1)
    df = log.read_log(spark, path)
    assert df.columns == [*[f.name for f in OBSERVATION], "_commit_version"]
    assert sorted(r._commit_version for r in df.collect()) == [1, 1, 2]
    assert "PartitionFilters: [isnotnull(_commit_version" in versions.as_of(df, 1)._jdf.queryExecution().executedPlan().toString()


def test_freeze_checks_before_it_writes(spark, history, tmp_path):
    tables = {"a": history, "b": history}
    with pytest.raises(ValueError, match=r"\['b'\]"):
        versions.freeze(tables, {"a": 1, "b": 77}, str(tmp_path / "x"))
    assert not (tmp_path / "x").exists()
    assert versions.freeze(tables, {"a": 1, "b": 3}, str(tmp_path / "x")) == {"a": 2, "b": 1}
    with pytest.raises(Exception, match="(?i)exists"):
        versions.freeze(tables, {"a": 1, "b": 3}, str(tmp_path / "x"))


def test_watermarks(history):
    assert log.incremental(history, "2026-01-02 00:05:00", 300).count() == 2
    assert log.incremental(history, None).count() == 4
    assert log.candidate_watermark(history, "2027-01-01").first().candidate.year == 2027
    assert tuple(log.candidate_watermark(history.where("false"), "2027-01-01").first()) == (None, 0)
    assert log.of_run(history, "run-1").count() == 2 and log.of_run(history, None).count() == 4
    with pytest.raises(ValueError):
        log.of_run(history, " ")


EVENTS = "run_id string, status string, at timestamp, candidate_watermark_value timestamp, error_message string"


def test_first_terminal_event_stays(spark):
    t = [at(f"2026-01-0{i}") for i in range(1, 8)]
    rows = [("a", "running", t[0], None, None), ("a", "running", t[1], t[0], None), ("a", "succeeded", t[2], None, None), ("a", "failed", t[3], None, "late"), ("b", "running", t[4], None, None), ("c", "succeeded", t[1], None, None)]
    got = {r.run_id: (r.status, r.started_at.day, r.finished_at and r.finished_at.day, r.candidate_watermark_value and r.candidate_watermark_value.day, r.error_message) for r in control.run_ledger(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got == {"a": ("succeeded", 1, 3, 1, None), "b": ("running", 5, None, None, None)}


def test_watermark_never_goes_back_and_failures_leave_it(spark):
    stored = spark.createDataFrame([("s", "issues", "updated_at", at("2026-01-05"), 300, "r0", at("2026-01-05"))], "source_name string, entity_name string, watermark_column string, watermark_value timestamp, overlap_seconds long, last_successful_run_id string, updated_at timestamp")
    ledger = lambda *rows: spark.createDataFrame([(r, s, at("2026-01-01"), at("2026-01-06"), c and at(c), None) for r, s, c in rows], LEDGER)
    commit = lambda df, table=stored: control.commit_watermark(table, df, "s", "issues", "updated_at").first()
    assert commit(ledger(("r1", "succeeded", "2026-01-04"))).last_successful_run_id == "r0"
    assert commit(ledger(("r1", "failed", "2026-01-09"), ("r2", "running", "2026-01-09"))).last_successful_run_id == "r0"
    assert commit(ledger(("r1", "succeeded", None))).last_successful_run_id == "r0"
    done = control.commit_watermark(stored, ledger(("r1", "succeeded", "2026-01-08"), ("r2", "succeeded", "2026-01-07")), "s", "issues", "updated_at")
    assert done.first().last_successful_run_id == "r1" and done.first().watermark_value.day == 8
    assert commit(ledger(("r1", "succeeded", "2026-01-08")), done) == done.first()


def test_positions_move_together_and_never_back(spark):
    s = "consumer_name string, source_table string, last_version long, last_run_id string, updated_at timestamp"
    stored = spark.createDataFrame([("c", "a", 5, "r1", at("2026-01-01")), ("c", "b", 5, "r1", at("2026-01-01"))], s)
    reached = spark.createDataFrame([("c", "a", 9, "r2", at("2026-01-02")), ("c", "b", 4, "r2", at("2026-01-02")), ("c", "d", 1, "r2", at("2026-01-02"))], s)
    assert sorted((r.source_table, r.last_version) for r in control.commit_positions(stored, reached).collect()) == [("a", 9), ("b", 5), ("d", 1)]


def test_daily_snapshot_of_the_two_run_example(spark):
    runs = spark.createDataFrame([(at("2026-10-10T18:00:00"),), (at("2026-10-12T18:00:00"),)], "finished_at timestamp")
    coverage = snapshots.day_coverage(runs, "2026-10-10", "2026-10-12")
    assert [r.coverage for r in coverage.orderBy("snapshot_date").collect()] == ["observed", "missing", "observed"]
    s = "repository_owner string, repository_name string, issue_id long, state string, created_at timestamp, labels array<struct<id:long>>, updated_at timestamp, source_run_id string, _ingested_at timestamp"
    rows = [("psf", "requests", 1, "open", at("2026-10-09T08:00:00"), [(100,)], at("2026-10-10"), "run_a", at("2026-10-10T17:50:00")), ("psf", "requests", 1, "closed", at("2026-10-09T08:00:00"), [], at("2026-10-12"), "run_b", at("2026-10-12T17:50:00"))]
    picked = snapshots.as_of_days(spark.createDataFrame(rows, s), coverage.where("coverage = 'observed'"), ISSUE_KEY, ["_ingested_at", "updated_at", "source_run_id"], "_ingested_at")
    got = [(r.snapshot_date.day, r.state, r.age_days, r.observation_run_id, r.issue_key, r.repository_key) for r in snapshots.fact_daily(picked).orderBy("snapshot_date").collect()]
    key, repo = "067e6f7a3b5d955aa90b63e8feed956b85156b0d26cfd699e1eccb2572cfca4a", "cfca81838540c7f2327a1d4bc9b802d9c88e41fae787f2abd27938605baa3f35"
    assert got == [(10, "open", 1, "run_a", key, repo), (12, "closed", 3, "run_b", key, repo)]
    (label,) = snapshots.labels_daily(picked).collect()
    assert (label.snapshot_date.day, label.label_key) == (10, "ebabc6453fff58613477d3111d0a1894f14e30cea3c2e0e9b4bd7301e0228d0a")
    assert "NestedLoop" not in picked._jdf.queryExecution().executedPlan().toString()


def test_interval_form_equals_theta_form(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.randrange(9), at(f"2026-01-{rng.randrange(1, 20):02d}T{rng.randrange(24):02d}:00:00"), i) for i in range(300)]
    obs = spark.createDataFrame(rows, "k long, at timestamp, n long")
    days = spark.createDataFrame([(d,) for d in rng.sample(range(1, 25), 12)], "d int").select(F.make_date(F.lit(2026), F.lit(1), F.col("d")).alias("snapshot_date"))
    got = {(r.snapshot_date, r.k): r.n for r in snapshots.as_of_days(obs, days, ["k"], ["at", "n"], "at").collect()}
    want = {}
    for d in days.collect():
        for k, when, n in rows:
            if when.date() <= d.snapshot_date:
                want[d.snapshot_date, k] = max(want.get((d.snapshot_date, k), (when, n)), (when, n))
    assert got == {x: n for x, (_, n) in want.items()}


ISSUE = "repository_owner string, repository_name string, issue_id long, issue_number long, title string, state string, is_pull_request boolean, author_user_id long, created_at timestamp, updated_at timestamp, closed_at timestamp, source_run_id string"


def test_incremental_models_touch_the_workset_only(spark):
    row = lambda i, state, closed=None: ("psf", "requests", i, i, "t", state, False, 7, at("2026-10-09T08:00:00"), at("2026-10-12"), closed and at(closed), "r2")
    issues = spark.createDataFrame([row(1, "closed", "2026-10-12"), row(5, "open")], ISSUE)
    key = "repository_owner string, repository_name string, issue_id long"
    work = spark.createDataFrame([("psf", "requests", 1)], key)
    empty = star.fact_issue(issues).where("false")
    (fact,) = incremental.fact_incremental(empty, issues, work).collect()
    assert (fact.issue_id, fact.created_date_key, fact.updated_date_key, fact.closed_date_key) == (1, 20261009, 20261012, 20261012)
    rel = spark.createDataFrame([("psf", "requests", 1, 100), ("psf", "requests", 5, 100)], f"{key}, label_id long")
    stored = star.bridge_issue_label(spark.createDataFrame([("psf", "requests", 2, 9), ("psf", "requests", 8, 9)], f"{key}, label_id long"))
    work2 = spark.createDataFrame([("psf", "requests", 1), ("psf", "requests", 2)], key)
    assert sorted((r.issue_id, r.label_id) for r in incremental.bridge_incremental(stored, rel, work2).collect()) == [(1, 100), (8, 9)]
    assert star.fact_issue(issues.where("issue_id = 5")).first().closed_date_key is None


def test_a_batch_plans_compares_and_commits_last(spark, tmp_path):
    from obslog.operators import changes, state
    from obslog.schemas import ISSUES, RELATIONS

    row = lambda i, name: ("o", "r", i, i, name, "open", False, 7, at("2026-10-09"), at("2026-10-12"), None, "r2")
    old = spark.createDataFrame([row(1, "a"), row(2, "b"), row(3, "c")], ISSUE)
    issues, feed = state.guarded_upsert(old, spark.createDataFrame([row(1, "new")], ISSUE), ISSUES, 2, F.lit("2026-10-12"))
    rel = "repository_owner string, repository_name string, issue_id long, label_id long, observed_at timestamp, source_run_id string"
    had = spark.createDataFrame([("o", "r", 2, 5, at("2026-10-01"), "r1")], rel)
    scope = spark.createDataFrame([("o", "r", 2, at("2026-10-12"), "r2")], "repository_owner string, repository_name string, issue_id long, observed_at timestamp, source_run_id string")
    relations, rfeed = state.reconcile(had, scope, had.where("false"), ISSUE_KEY, RELATIONS, 2, F.lit("2026-10-12"))
    p = "consumer_name string, source_table string, last_version long, last_run_id string, updated_at timestamp"
    stored = spark.createDataFrame([("c", "issues", 1, "r1", at("2026-10-01")), ("other", "issues", 9, "r1", at("2026-10-01"))], p)
    base = spark.createDataFrame([("relations", 1)], "source_table string, version long")
    ask = lambda positions, baselines, fact=star.fact_issue(old): incremental.run_batch(fact, star.bridge_issue_label(had), issues, relations, feed, rfeed, positions, baselines, "c", "r2", F.lit("2026-10-12").cast("timestamp"))
    batch, after = ask(stored, base)
    assert sorted((r.issue_id, r.title) for r in batch.fact.collect()) == [(1, "new"), (2, "b"), (3, "c")] and batch.bridge.count() == 0
    assert sorted((r.consumer_name, r.source_table, r.last_version) for r in after.collect()) == [("c", "issues", 2), ("c", "relations", 2), ("other", "issues", 9)]
    with pytest.raises(incremental.RefusedBatch, match="relations: no start"):
        ask(stored, base.where("false"))
    with pytest.raises(incremental.RefusedBatch, match="issues: two starts"):
        ask(stored, base.union(spark.createDataFrame([("issues", 1)], base.schema)))
    with pytest.raises(incremental.RefusedBatch, match="fact differs"):
        ask(stored, base, star.fact_issue(old.where("issue_id < 3")))
    path = str(tmp_path / "work")
    assert changes.write_workset(batch.workset.union(batch.workset), path, ISSUE_KEY) == 2
    assert changes.write_workset(batch.workset.limit(1), path, ISSUE_KEY) == 1 == spark.read.parquet(path).count()


def test_batches_number_a_run_across_tasks(spark, history):
    rows = spark.createDataFrame([(r, i * 37 % 1000) for r in ("a", "b", None) for i in range(500)], "_run_id string, k long")
    got = {(r._run_id, r.k): r.batch for r in log.batches(rows, 50, "k").collect()}
    for run in ("a", "b", None):
        keys = sorted(k for x, k in got if x == run)
        assert [got[run, k] for k in keys] == [f"batch-{i // 50 + 1}" for i in range(500)]


def test_a_small_batch_rewrites_its_buckets_only(spark, tmp_path):
    schema = "k long, at timestamp"
    table = VersionedTable(spark, f"{tmp_path}/state", spark.createDataFrame([], schema).schema, ["k"], buckets=8)
    add = ingest.upsert_batch(table, EntitySpec("s", ("k",), "at", (), ()))
    for n in range(6):
        add(spark.createDataFrame([(k, at(f"2026-01-{n + 1:02d}")) for k in (range(100) if n == 0 else [n])], schema), n)
    assert {r.k: r.at.day for r in table.read().collect()} == {k: k + 1 if 1 <= k <= 5 else 1 for k in range(100)}
    held = [table.manifest(v) for v in table.versions()]
    assert len(held[-1]["buckets"]) == 8 and [len(m["touched"]) for m in held] == [8, 1, 1, 1, 1, 1] and table.versions() == list(range(6))


def test_calendar(spark):
    days = star.dim_date(spark)
    assert days.count() == 10227
    sunday = days.where("date_key = 20261129").first()
    assert (sunday.day_name, sunday.iso_day_of_week_number, sunday.is_weekend, sunday.calendar_quarter, sunday.month_name) == ("Sunday", 7, True, 4, "November")


def test_stream_converges_whatever_the_order_and_skips_known_batches(spark, tmp_path):
    spec = EntitySpec("events", ("k",), "at", ("n",), ())
    schema = "k long, at timestamp, n long"
    rows = [(i % 5, at(f"2026-01-{1 + (i * 7) % 28:02d}"), i) for i in range(60)]
    df = spark.createDataFrame(rows, schema)
    for name, order in (("up", F.asc("at")), ("down", F.desc("at"))):
        source = f"{tmp_path}/{name}"
        df.repartitionByRange(4, order).write.parquet(source)
        table = VersionedTable(spark, f"{tmp_path}/{name}-state", df.schema, spec.keys, buckets=4)
        ingest.stream_latest_state(ingest.files(spark, source, df.schema), table, spec, f"{tmp_path}/{name}-check").awaitTermination()
        got = {r.k: (r.at.replace(tzinfo=None)) for r in table.read().collect()}
        assert got == {k: max(w.replace(tzinfo=None) for x, w, _ in rows if x == k) for k in range(5)}
        before = table.versions()
        ingest.upsert_batch(table, spec)(df, before[-1])
        assert table.versions() == before
    assert VersionedTable(spark, f"{tmp_path}/none", df.schema, spec.keys).read().count() == 0


def test_streaming_days_close_behind_the_watermark(spark, tmp_path):
    rows = [(1, at(f"2026-01-0{d}"), "open" if d % 2 else "closed") for d in (1, 1, 2, 3, 6)]
    spark.createDataFrame(rows, "k long, at timestamp, state string").write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema("k long, at timestamp, state string").parquet(f"{tmp_path}/in")
    q = ingest.daily_activity(source).writeStream.format("memory").queryName("days").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    assert {(r.day.day, r.n) for r in spark.table("days").collect()} == {(1, 2), (2, 1), (3, 1)}
