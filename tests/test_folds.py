"""Many versions at once against one after another."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from obslog.operators import state
from obslog.schemas import RELATIONS, EntitySpec

START = datetime(2026, 1, 1, tzinfo=UTC)
COMMITTED = {v: f"2026-02-0{v} 00:00:00" for v in range(1, 6)}
SPEC = EntitySpec("t", ("k",), "at")
PARENT = ["repository_owner", "repository_name", "issue_id"]


def told(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("seed", range(2))
def test_folded_upserts_are_those_of_each_version(spark, seed):
    rng = random.Random(seed)
    rows = [(k, START + timedelta(days=rng.randrange(5)), f"{v}-{k}" if rng.random() < 0.9 else None, v) for v in COMMITTED for k in rng.sample(range(12), 7)]
    df = spark.createDataFrame(rows, "k long, at timestamp, x string, _version int")
    now, feed = df.drop("_version").where("false"), None
    for v, at in COMMITTED.items():
        now, changes = state.guarded_upsert(now, df.where(F.col("_version") == v).drop("_version"), SPEC, v, F.lit(at), keep=lambda d: spark.createDataFrame(d.collect(), d.schema))
        feed = changes if feed is None else feed.unionByName(changes)
    folded, all_changes = state.fold_upserts(df, SPEC, COMMITTED)
    assert told(folded) == told(now) and told(all_changes) == told(feed) != []


@pytest.mark.parametrize("seed", range(2))
def test_folded_reconciliations_are_those_of_each_version(spark, seed):
    rng = random.Random(seed)
    rows = [("o", "r", i, START + timedelta(days=rng.randrange(4)), f"run {v}", rng.sample(range(1, 6), rng.randrange(4)), v) for v in COMMITTED for i in rng.sample(range(6), 4)]
    df = spark.createDataFrame(rows, "repository_owner string, repository_name string, issue_id long, observed_at timestamp, source_run_id string, label_ids array<long>, _version int")
    relations = df.select(*PARENT, F.explode("label_ids").alias("label_id"), "observed_at", "source_run_id", "_version")
    now, feed = relations.drop("_version").where("false"), None
    for v, at in COMMITTED.items():
        scope, mine = df.where(F.col("_version") == v), relations.where(F.col("_version") == v).drop("_version")
        now, changes = state.reconcile(now, scope, mine, PARENT, RELATIONS, v, F.lit(at), keep=lambda d: spark.createDataFrame(d.collect(), d.schema))
        feed = changes if feed is None else feed.unionByName(changes)
    folded, all_changes = state.fold_reconciles(df, "label_ids", "label_id", COMMITTED, PARENT)
    assert told(folded) == told(now) and told(all_changes) == told(feed) != []
    assert {r._change_type for r in all_changes.collect()} == {"insert", "delete", "update_preimage", "update_postimage"}


def test_folds_of_nothing_and_of_repeated_keys(spark):
    df = spark.createDataFrame([], "k long, at timestamp, x string, _version int")
    assert [x.count() for x in state.fold_upserts(df, SPEC, COMMITTED)] == [0, 0]
    twice = spark.createDataFrame([(1, START, "a", 1), (1, START, "b", 1)], df.schema)
    for x in state.fold_upserts(twice, SPEC, COMMITTED):
        with pytest.raises(Exception, match="t: duplicate keys k"):
            x.where("k = 2").collect()
