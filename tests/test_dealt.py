"""Tables in Spark's buckets of their keys, which are folded, compared and joined without an exchange."""

import random

import pytest
from pyspark.sql import functions as F
from test_folds import COMMITTED, PARENT, SPEC, START, timedelta, told
from test_state import log, payload  # noqa: F401

from obslog.operators import compare, entities, incremental, star, state, versions
from obslog.schemas import ISSUES, LABELS, RELATIONS, USERS
from obslog.sources.folder import cut, discard
from obslog.sources.store import VersionedTable

SPECS = {"issues": ISSUES, "labels": LABELS, "users": USERS}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def label(name, i=301):
    return {"id": i, "name": name, "color": "ABCDEF", "default": False}


def seen_twice(log):  # noqa: F811
    """Two runs of two issues; in the second run a label is named twice at one time."""
    return log(
        {"p": payload(5, labels=[label("b"), label("z", 302)]), "issue": 5, "run": "run-1"},
        {"p": payload(6, labels=[label("a")]), "issue": 6, "run": "run-1"},
        {"p": payload(5, labels=[label("c")]), "issue": 5, "run": "run-2"},
        {"p": payload(6, labels=[label("d")]), "issue": 6, "run": "run-2"},
    )


def test_one_ranking_gives_the_newest_of_each_run_and_of_all(spark, log):  # noqa: F811
    for rows in (seen_twice(log), seen_twice(log).where("issue_id = 5")):  # with tied rows that differ, and without
        each = entities.newest_written(rows, within="source_run_id")
        for kind in entities.KINDS:
            whole = entities.entity_table(entities.newest_of_each(rows), kind)
            assert told(entities.entity_table(each.where("_newest"), kind)) == told(whole) != []
            for run in ("run-1", "run-2"):
                of_run = entities.entity_table(entities.newest_of_each(rows.where(F.col("_run_id") == run)), kind)
                assert told(entities.entity_table(each.where(F.col("source_run_id") == run), kind)) == told(of_run)
    for kind in ("issues", "labels"):
        found = entities.entity_table(each, kind).withColumn("_version", F.right("source_run_id", F.lit(1)).cast("int"))
        folded, _ = state.fold_upserts(found, SPECS[kind], {1: "2026-02-01", 2: "2026-02-02"})
        assert "Exchange" not in plan(folded) and told(folded) == told(entities.entity_table(each.where("_newest"), kind))


@pytest.mark.parametrize("seed", range(2))
def test_states_at_each_version_are_those_of_the_versions_so_far(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(k, START + timedelta(days=rng.randrange(5)), f"{v}-{k}", v) for v in COMMITTED for k in rng.sample(range(12), 7)]
    df = spark.createDataFrame(rows, "k long, at timestamp, x string, _version int")
    folded = state.folded_upserts(df, SPEC, COMMITTED, keep=lambda d: cut(d, ["k"]))
    scopes = [("o", "r", i, START + timedelta(days=rng.randrange(4)), f"run {v}", rng.sample(range(1, 6), rng.randrange(4)), v) for v in COMMITTED for i in rng.sample(range(6), 4)]
    seen = spark.createDataFrame(scopes, "repository_owner string, repository_name string, issue_id long, observed_at timestamp, source_run_id string, label_ids array<long>, _version int")
    relations = state.folded_reconciles(seen, "label_ids", "label_id", COMMITTED, PARENT, keep=lambda d: cut(d, PARENT))
    table = VersionedTable(spark, f"{tmp_path}/t", relations.state.schema, RELATIONS.keys, buckets=3, keep=9, bucket_by=PARENT, gathered=False)
    for v in COMMITTED:
        so_far = F.col("_version") <= v
        assert told(folded.at(v)) == told(state.fold_upserts(df.where(so_far), SPEC, COMMITTED)[0]) != []
        now = relations.at(v)
        assert "Exchange" not in plan(now)
        table.commit(now, None, v, COMMITTED[v])
        want = told(state.fold_reconciles(seen.where(so_far), "label_ids", "label_id", COMMITTED, PARENT)[0])
        assert told(now) == told(table.read(v)) == want != []
    twice = spark.createDataFrame([(1, START, "a", 1), (1, START, "b", 1)], df.schema)
    with pytest.raises(Exception, match="t: duplicate keys k"):
        state.folded_upserts(twice, SPEC, COMMITTED, keep=lambda d: cut(d, ["k"]))


def test_a_batch_of_issues_in_buckets_exchanges_neither_model_nor_differences(spark, log):  # noqa: F811
    rows = entities.newest_written(log({"p": payload(5, labels=[label("a")]), "issue": 5}, {"p": payload(6, labels=[]), "issue": 6}))
    issues, relations = [cut(entities.entity_table(rows, kind), star.ISSUE_KEY) for kind in ("issues", "relations")]
    feeds = [df.limit(1).withColumns({"_change_type": F.lit("insert"), "_commit_version": F.lit(2).cast("long"), "_commit_timestamp": F.current_timestamp()}) for df in (issues, relations)]
    fact, bridge = star.fact_issue(issues.where("issue_id < 0")), star.bridge_issue_label(relations.where("issue_id < 0"))
    batch = incremental.incremental_batch(fact, bridge, issues, relations, *feeds, {"issues": (2, 2), "relations": (2, 2)})
    assert batch.workset.count() in (1, 2) and batch.bridge.count() == 1 and batch.bridge_differences.count() == 0
    assert batch.fact_differences.count() == 2 - batch.fact.count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        batch = incremental.incremental_batch(fact, bridge, issues, relations, *feeds, {"issues": (2, 2), "relations": (2, 2)})
        for df in (batch.fact, batch.bridge, batch.bridge_differences):
            assert "Exchange" not in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_marked_and_whole_replays_come_from_one_ranking(spark, log):  # noqa: F811
    rows = seen_twice(log).withColumn("_commit_version", F.right("_run_id", F.lit(1)).cast("long"))
    manifest = rows.limit(1).select("repository_owner", "repository_name", F.lit("m").alias("manifest_id"), F.lit(1).cast("long").alias("bronze_version"), F.array(F.lit("run-1"), F.lit("run-2")).alias("successful_run_ids"))
    ids = F.lit("m"), F.lit("x")
    again, live = versions.replay_marked(versions.marked_input(rows, manifest), "frozen", *ids)
    keys = {k: SPECS.get(k, RELATIONS).keys for k in live}
    want = versions.replay(versions.frozen_input(rows, manifest), *ids)
    assert {k: told(v) for k, v in again.items()} == {k: told(v) for k, v in want.items()}
    report = {r.table_name: (r.left_only, r.right_only) for r in compare.compare_report(again, live, keys, {k: ("source_run_id",) for k in keys}).collect()}
    for name in keys:
        both = compare.diff_both_ways(again[name], live[name], ("source_run_id",)).collect()
        assert report[name] == tuple(sum(r.n for r in both if r.side == side) for side in ("left", "right")), name
    assert report["relations"] != (0, 0) == report["users"]
    one = cut(entities.entity_table(entities.newest_written(rows, within="source_run_id"), "relations"), star.ISSUE_KEY)
    net = compare.count_differences(one, one.where("label_id > 301"), RELATIONS.keys, dealt=True)
    assert plan(net).count("Exchange hashpartitioning") == 0 and tuple(net.first()) == (one.where("label_id = 301").count(), 0)


def test_rankings_carry_what_is_asked_for(spark, log):  # noqa: F811
    rows = seen_twice(log)
    newest = entities.newest_written(rows, kinds=("issues", "labels", "relations"), columns={"issues": [], "labels": ["name"]})
    whole = entities.newest_of_each(rows)
    for kind, columns in (("issues", ["issue_id", "updated_at"]), ("labels", ["label_id", "name"]), ("relations", ["issue_id", "label_id"])):
        assert told(entities.entity_table(newest, kind).select(columns)) == told(entities.entity_table(whole, kind).select(columns)) != []
    assert "title" not in newest.columns and newest.schema["issues"].dataType.names == ["there"] and newest.schema["labels"].dataType.names == ["name"]
    counts = star.issues_per_label(star.bridge_issue_label(entities.entity_table(newest, "relations")), entities.entity_table(newest, "labels"))
    assert "sha2" not in plan(counts) and sorted((r.label_id, r.issues) for r in counts.collect()) == [(301, 2)]


def test_a_bucketed_table_goes_when_it_is_discarded(spark):
    before = {t.name for t in spark.catalog.listTables()}
    df = cut(spark.range(10), ["id"])
    assert df.count() == 10
    discard(df)
    assert {t.name for t in spark.catalog.listTables()} == before
