"""Rankings that leave the payload's text behind, and ask for it only where rows tie."""

import pytest
from pyspark.sql import functions as F
from test_state import log, payload  # noqa: F401

from obslog.operators import changes, entities, state, versions
from obslog.schemas import RELATIONS, EntitySpec


def label(name, i=301):
    return {"id": i, "name": name, "color": "ABCDEF", "default": False}


def told(df, *columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_the_text_decides_where_tied_rows_differ(spark, log):  # noqa: F811
    """Two observations of one time, run and batch name a label differently; a third ties and is the same."""
    rows = log(
        {"p": payload(5, labels=[label("b"), label("z", 302)]), "issue": 5},
        {"p": payload(6, labels=[label("a"), label("z", 302)]), "issue": 6},
        {"p": payload(7, labels=[label("a")]), "issue": 7},
    )
    plain = entities.newest_of_each(rows)
    written = entities.newest_written(rows)
    for kind in entities.KINDS:
        a, b = entities.entity_table(plain, kind), entities.entity_table(written, kind)
        assert told(a, *a.columns) == told(b, *a.columns), kind
    want = max((r.raw_json, r.issue_id) for r in rows.collect())[1]
    name = {5: "b", 6: "a", 7: "a"}[want]
    assert sorted((r.label_id, r.name) for r in entities.latest_labels(rows).collect()) == [(301, name), (302, "z")]


def test_one_table_of_a_replay_is_the_same_and_judges_all_rules(spark, log):  # noqa: F811
    rows = log({"p": payload(5, labels=[label("a")]), "issue": 5}, {"p": payload(6), "issue": 6})
    whole = versions.replay(rows, F.lit("m"), F.lit("x"))
    for kind, df in whole.items():
        one = versions.replay(rows, F.lit("m"), F.lit("x"), (kind,))
        assert list(one) == [kind] and told(one[kind], *df.columns) == told(df, *df.columns)
    bad = log({"p": payload(5, labels=[label(" ")]), "issue": 5})
    with pytest.raises(Exception, match="a label is malformed"):
        versions.replay(bad, F.lit("m"), F.lit("x"), ("users",))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_fold_of_upserts_is_one_exchange_and_relations_compare_no_images(spark):
    df = spark.createDataFrame([(1, 1, "a", 1), (1, 2, "b", 2)], "k long, at long, x string, _version int")
    folded, _ = state.fold_upserts(df, EntitySpec("t", ("k",), "at"), {1: "2026-02-01", 2: "2026-02-02"})
    assert plan(folded).count("Exchange hashpartitioning") == 1 and [tuple(r) for r in folded.collect()] == [(1, 2, "b")]
    feed = spark.createDataFrame(
        [("o", "r", 1, k, None, "run", kind, v, None) for k, kind, v in ((1, "insert", 2), (2, "delete", 2), (3, "update_preimage", 2), (3, "update_postimage", 2), (1, "delete", 3))],
        "repository_owner string, repository_name string, issue_id long, label_id long, observed_at timestamp, source_run_id string, _change_type string, _commit_version long, _commit_timestamp timestamp",
    )
    real = changes.real_changes(feed, RELATIONS)
    assert "SortAggregate" not in plan(real)
    assert sorted((r.label_id, r._commit_version, r.change) for r in real.collect()) == [(1, 2, "insert"), (1, 3, "delete"), (2, 2, "delete")]
