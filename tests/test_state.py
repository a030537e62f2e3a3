import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from obslog.operators import contracts, entities, state
from obslog.operators.changes import UnreadableRange, business_columns, change_range, changed_keys, plan_ranges, real_changes
from obslog.operators.compare import diff_both_ways, lineage_differences, moved_inputs, unexplained
from obslog.operators.star import ISSUE_KEY
from obslog.schemas import ISSUES, RELATIONS, USERS, enforce_schema, missing_columns, require_utc

LOG = "repository_owner string, repository_name string, issue_id long, source_updated_at timestamp, raw_json string, _run_id string, _ingested_at timestamp, _page_or_batch_reference string"


def at(text):
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def payload(issue=1001, **change):
    body = {
        "id": issue, "number": 42, "title": "Replay lesson", "state": "open", "user": {"id": 2001, "login": "alice", "type": "User"},
        "labels": [{"id": 301, "name": "bug", "color": "D73A4A", "description": "b", "default": True}],
        "created_at": "2026-09-20T10:00:00Z", "updated_at": "2026-09-20T11:00:00Z", "closed_at": None,
    }
    return body | change


@pytest.fixture
def log(spark):
    def make(*rows):
        full = []
        for r in rows:
            body = r["p"] if isinstance(r["p"], str) else json.dumps(r["p"])
            when = r.get("updated", "2026-09-20T11:00:00")
            full.append(("o", "r", r.get("issue", 1001), at(when), body, r.get("run", "run-1"), at(r.get("ingested", "2026-09-20T11:01:00")), r.get("batch", "batch-1")))
        return spark.createDataFrame(full, LOG)

    return make


def issues_of(df):
    return entities.issues(entities.parsed(df))


def test_latest_row_wins_and_pull_requests_are_told(log):
    newer = payload(title="edited", state="closed", updated_at="2026-09-21T09:00:00Z", closed_at="2026-09-21T09:00:00Z", pull_request={"url": "u"})
    df = log({"p": payload()}, {"p": newer, "updated": "2026-09-21T09:00:00", "run": "run-2"}, {"p": payload(1002, pull_request=None), "issue": 1002})
    got = {r.issue_id: r for r in entities.latest_issues(df).collect()}
    assert (got[1001].title, got[1001].state, got[1001].is_pull_request, got[1001].source_run_id) == ("edited", "closed", True, "run-2")
    assert got[1002].is_pull_request is False and got[1002].closed_at is None


def test_batches_break_ties_as_text(log):
    df = log({"p": payload(title="ten"), "batch": "batch-10"}, {"p": payload(title="nine"), "batch": "batch-9"})
    assert [r.title for r in entities.latest_issues(df).collect()] == ["nine"]


@pytest.mark.parametrize(
    "bad, rule",
    [
        (payload(created_at="2026-09-20T10:00:00"), "_created_raw without zone"),
        (payload(created_at="2026-09-20T10:00:00+0200"), "_created_raw without zone"),
        (payload(closed_at=""), "_closed_raw without zone"),
        (payload(user=None), "author_user_id not positive"),
        (payload(title=" "), "title blank"),
        (payload(7), "_payload_id differs from issue_id"),
        (payload(updated_at="2026-09-20T12:00:00Z"), "updated_at differs from _source_updated_at"),
        ("not-json", "issue_number not positive"),
        (payload(number=1.5), "issue_number not positive"),
    ],
)
def test_bad_issues_fail_the_batch(log, bad, rule):
    rows = issues_of(log({"p": payload()}, {"p": bad}))
    told = [r.violations for r in contracts.invalid(rows, contracts.ISSUE_RULES).collect()]
    assert len(told) == 1 and rule in told[0]
    assert contracts.valid(rows, contracts.ISSUE_RULES).count() == 1
    with pytest.raises(contracts.InvalidRows):
        contracts.require_valid(rows, contracts.ISSUE_RULES)


def test_an_older_malformed_row_fails_what_is_built_of_the_newest(log):
    bad_label = [{"id": 301, "name": "bug", "color": "nope", "default": True}]
    newer = payload(updated_at="2026-09-21T09:00:00Z")
    rows = log({"p": payload(labels=bad_label, title=" ", user={"id": 2001, "login": "", "type": "User"})}, {"p": newer, "updated": "2026-09-21T09:00:00", "run": "run-2"})
    for make, what in ((entities.latest_issues, "title blank"), (entities.latest_labels, "color not six"), (entities.latest_users, "login blank"), (entities.observed_scope, "label is malformed")):
        with pytest.raises(Exception, match=what):
            make(rows).collect()
        assert make(rows, check=False).count() == 1
    with pytest.raises(contracts.InvalidRows):
        entities.check_observations(rows)
    entities.check_observations(log({"p": payload()}))


def test_gates_stop_what_follows(log):
    rows = entities.latest_issues(log({"p": payload()}))
    good = contracts.gate_report(rows, "issues", ["title"], [["issue_id"]], {"state": ["open"]})
    contracts.require_gates(good)
    with pytest.raises(contracts.InvalidRows, match="issues accepted_values state: 1"):
        contracts.require_gates(good, contracts.gate_report(rows, "issues", accepted={"state": ["closed"]}))


def test_canonical_text_keeps_every_field(spark):
    rows = spark.createDataFrame([('{"b":1, "a":{"d":null,"c":[true, "é\\n"]}, "pull_request":null}',), ("nope",), (None,)], "t string")
    from obslog.sources.log import canonical_json

    assert [r[0] for r in rows.select(canonical_json(F.col("t"))).collect()] == ['{"a":{"c":[true,"é\\n"],"d":null},"b":1,"pull_request":null}', None, None]


def test_null_ids_are_flagged(log):
    rows = issues_of(log({"p": payload()}).withColumn("issue_id", F.lit(None).cast("long")))
    assert "issue_id not positive" in contracts.invalid(rows, contracts.ISSUE_RULES).first().violations


@pytest.mark.parametrize("labels, rule", [(None, "labels missing"), ([{"id": 1}, {"id": 1}], "labels repeat an id")])
def test_bad_envelopes(log, labels, rule):
    rows = entities.envelopes(entities.parsed(log({"p": payload(labels=labels)})))
    assert rule in contracts.invalid(rows, contracts.ENVELOPE_RULES).first().violations


@pytest.mark.parametrize("color", ["not-a-color", "d73a4a\n", None, "d73a4"])
def test_bad_colours(log, color):
    rows = entities.labels(entities.envelopes(entities.parsed(log({"p": payload(labels=[{"id": 1, "name": "x", "color": color, "default": False}])}))))
    assert contracts.invalid(rows, contracts.LABEL_RULES).first().violations == ["color not six hex digits"]


def test_labels_of_all_issues_compete_and_empty_arrays_give_none(log):
    later = [{"id": 301, "name": "renamed", "color": "FFFFFF", "default": False}]
    df = log({"p": payload()}, {"p": payload(1002, labels=later), "issue": 1002, "updated": "2026-09-22T00:00:00"}, {"p": payload(1003, labels=[]), "issue": 1003})
    assert [(r.label_id, r.name, r.color) for r in entities.latest_labels(df).collect()] == [(301, "renamed", "ffffff")]
    scope = entities.observed_scope(df)
    assert scope.count() == 3 and {r.issue_id for r in entities.relations_of(scope).collect()} == {1001, 1002}


def test_users_are_global(log):
    df = log({"p": payload()}, {"p": payload(1002, user={"id": 2001, "login": "al", "type": "Bot"}), "issue": 1002, "updated": "2026-09-23T00:00:00"})
    assert [(r.login, r.user_type) for r in entities.latest_users(df).collect()] == [("al", "Bot")]


STATE = "user_id long, login string, user_type string, observed_at timestamp, source_run_id string"


def users(spark, *rows):
    return spark.createDataFrame([(i, n, "User", at(w), r) for i, n, w, r in rows], STATE)


def test_guarded_upsert(spark):
    old = users(spark, (1, "a", "2026-01-02", "r1"), (2, "b", "2026-01-02", "r1"), (3, "c", "2026-01-02", "r1"))
    new = users(spark, (1, "A", "2026-01-03", "r2"), (2, "B", "2026-01-01", "r2"), (3, "c", "2026-01-02", "r2"), (4, "D", "2026-01-01", "r2"))
    after, changes = state.guarded_upsert(old, new, USERS, 7)
    assert sorted((r.user_id, r.login, r.source_run_id) for r in after.collect()) == [(1, "A", "r2"), (2, "b", "r1"), (3, "c", "r2"), (4, "D", "r2")]
    kinds = sorted((r.user_id, r._change_type, r.login) for r in changes.collect())
    assert kinds == [(1, "update_postimage", "A"), (1, "update_preimage", "a"), (3, "update_postimage", "c"), (3, "update_preimage", "c"), (4, "insert", "D")]
    assert {r._commit_version for r in changes.collect()} == {7}
    with pytest.raises(contracts.InvalidRows):
        contracts.require_unique(new.union(new), USERS.keys)
    with pytest.raises(Exception, match="users: duplicate keys user_id"):
        state.guarded_upsert(old, new.union(new), USERS)[0].collect()
    with pytest.raises(ValueError):
        contracts.duplicate_keys(new, [])


def test_any_order_of_batches_ends_in_the_same_state(spark):
    parts = [users(spark, (1, "a", "2026-01-01", "r1")), users(spark, (1, "b", "2026-01-03", "r2"), (2, "x", "2026-01-01", "r2")), users(spark, (1, "c", "2026-01-02", "r3"))]
    ends = set()
    for order in ((0, 1, 2), (2, 1, 0), (1, 0, 2)):
        df = spark.createDataFrame([], STATE)
        for i in order:
            df, _ = state.guarded_upsert(df, parts[i], USERS)
        ends.add(tuple(sorted((r.user_id, r.login) for r in df.collect())))
    assert ends == {((1, "b"), (2, "x"))}


SCOPE = "repository_owner string, repository_name string, issue_id long, observed_at timestamp, source_run_id string"
REL = "repository_owner string, repository_name string, issue_id long, label_id long, observed_at timestamp, source_run_id string"


def scope(spark, *rows):
    return spark.createDataFrame([("o", "r", i, at(w), "run") for i, w in rows], SCOPE)


def relations(spark, *rows):
    return spark.createDataFrame([("o", "r", i, x, at(w), "run") for i, x, w in rows], REL)


def test_reconcile(spark):
    stored = relations(spark, (1001, 2001, "2026-01-01T10:00:00"), (1002, 5, "2026-01-01T10:00:00"), (1003, 6, "2026-01-01T12:00:00"))
    seen = scope(spark, (1001, "2026-01-01T11:00:00"), (1003, "2026-01-01T11:00:00"), (1004, "2026-01-01T11:00:00"))
    now = relations(spark, (1004, 9, "2026-01-01T11:00:00"))
    after, changes = state.reconcile(stored, seen, now, ISSUE_KEY, RELATIONS, 3)
    assert sorted((r.issue_id, r.label_id) for r in after.collect()) == [(1002, 5), (1003, 6), (1004, 9)]
    assert sorted((r.issue_id, r._change_type) for r in changes.collect()) == [(1001, "delete"), (1004, "insert")]
    assert [(r.issue_id, r.label_id) for r in state.stale_relations(stored, seen, now, ISSUE_KEY, RELATIONS.keys).collect()] == [(1001, 2001)]
    for bad in ((7, 3, "2026-01-01T11:00:00"), (1004, 9, "2026-01-01T10:59:00")):
        with pytest.raises(Exception, match="outside the observed scope"):
            state.reconcile(stored, seen, relations(spark, bad), ISSUE_KEY, RELATIONS)[0].collect()
    outside = relations(spark, (1001, 1, "2026-01-01T11:00:00"), (1001, 2, "2026-01-01T10:59:00"), (7, 3, "2026-01-01T11:00:00"))
    assert sorted(r.label_id for r in state.orphan_relations(outside, seen, ISSUE_KEY).collect()) == [2, 3]


def test_old_run_brings_relations_back_unless_parents_are_asked(spark):
    stored = relations(spark)
    seen, had = scope(spark, (1, "2026-01-01")), relations(spark, (1, 5, "2026-01-01"))
    parents = spark.createDataFrame([("o", "r", 1, at("2026-01-02"))], "repository_owner string, repository_name string, issue_id long, updated_at timestamp")
    assert state.reconcile(stored, seen, had, ISSUE_KEY, RELATIONS)[0].count() == 1
    assert state.reconcile(stored, seen, had, ISSUE_KEY, RELATIONS, parent_state=parents)[0].count() == 0


def test_first_write_wins_and_conflicts_are_told(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1)], "k long, v string, n long")
    b = spark.createDataFrame([(1, "x", None), (2, "z", 1), (3, "n", 2)], "k long, v string, n long")
    assert sorted(map(tuple, state.insert_only(a, b, ["k"]).collect())) == [(1, "x", None), (2, "y", 1), (3, "n", 2)]
    assert [r.v for r in state.conflicts(a, b, ["k"]).collect()] == ["z"]


FEED = "repository_owner string, repository_name string, issue_id long, label_id long, state string, source_run_id string, _change_type string, _commit_version long, _commit_timestamp timestamp"


def feed(spark, *rows):
    return spark.createDataFrame([("o", "r", i, x, s, run, kind, v, at("2026-01-01")) for i, x, s, run, kind, v in rows], FEED)


def test_real_changes(spark):
    spec = ISSUES
    df = feed(
        spark,
        (1, None, "open", "a", "insert", 1), (2, None, "open", "a", "delete", 1),
        (3, None, "open", "a", "update_preimage", 2), (3, None, "closed", "b", "update_postimage", 2),
        (4, None, "open", "a", "update_preimage", 2), (4, None, "open", "b", "update_postimage", 2),
        (5, None, None, "a", "update_preimage", 2), (5, None, None, "b", "update_postimage", 2),
        (6, None, "open", "a", "update_preimage", 3), (6, None, "closed", "a", "update_postimage", 3),
        (6, None, "closed", "a", "update_preimage", 4), (6, None, "open", "a", "update_postimage", 4),
    )
    assert sorted((r.issue_id, r._commit_version) for r in real_changes(df, spec).collect()) == [(1, 1), (2, 1), (3, 2), (6, 3), (6, 4)]
    assert 4 in {r.issue_id for r in real_changes(df, spec, lineage=[]).collect()}
    assert sorted(r.issue_id for r in changed_keys([(change_range(df, 2, 3), spec)], ISSUE_KEY).collect()) == [3, 6]
    with pytest.raises(ValueError, match="nope"):
        business_columns(df, ["nope"])
    with pytest.raises(UnreadableRange, match="issues.*1 to 9"):
        change_range(df, 1, 9, "issues", check=True)
    assert change_range(df, 1, 4, check=True).count() == df.count()


def test_real_relation_changes_pair_by_row_key(spark):
    rows = [(7, 100, "x", "a", "update_preimage", 1), (7, 100, "x", "b", "update_postimage", 1), (7, 101, "x", "a", "update_preimage", 1), (7, 101, "y", "b", "update_postimage", 1)]
    rows += [(8, x, "x", r, k, 1) for x in (100, 101) for r, k in (("a", "update_preimage"), ("b", "update_postimage"))]
    got = real_changes(feed(spark, *rows).withColumn("observed_at", F.lit(None).cast("timestamp")), RELATIONS)
    assert [(r.issue_id, r.label_id) for r in got.collect()] == [(7, 101)]


def test_plan_ranges(spark):
    s = "source_table string, version long"
    current = spark.createDataFrame([("a", 9), ("b", 5), ("c", 3), ("d", 4), ("e", 2)], s)
    got = {r.source_table: (r.start_version, r.end_version, r.status) for r in plan_ranges(spark.createDataFrame([("a", 4), ("b", 5), ("c", 1), ("z", 1), ("e", 7)], s), spark.createDataFrame([("c", 0)], s), current).collect()}
    assert got == {"a": (5, 9, "ready"), "b": (6, 5, "idle"), "c": (2, 3, "two starts"), "d": (None, 4, "no start"), "z": (2, None, "not current"), "e": (8, 2, "behind")}


def test_compare(spark):
    a = spark.createDataFrame([(1, "x", "r1"), (1, "x", "r1"), (2, None, "r1")], "k long, v string, run string")
    b = spark.createDataFrame([(1, "x", "r2"), (2, None, "r2"), (3, "q", "r2")], "k long, v string, run string")
    assert sorted((r.k, r.side, r.n) for r in diff_both_ways(a, b, ["run"]).collect()) == [(1, "left", 1), (3, "right", 1)]
    found = lineage_differences(a.distinct(), b, ["k"], "run")
    assert [(r.left_run, r.right_run, r.n) for r in found.collect()] == [("r1", "r2", 2)]
    assert unexplained(found, spark.createDataFrame([("r2",)], "run_id string")).count() == 0
    with pytest.raises(ValueError):
        diff_both_ways(a, b.drop("v"))
    v = "source_table string, version long"
    assert [r.source_table for r in moved_inputs(spark.createDataFrame([("a", 1), ("b", 1)], v), spark.createDataFrame([("a", 1), ("b", 2)], v)).collect()] == ["b"]


def test_schemas(spark):
    df = spark.createDataFrame([(1,)], "user_id int")
    assert missing_columns(df, ["b", "user_id", "a"]) == ["a", "b"]
    from pyspark.sql import types as T

    wide = T.StructType([T.StructField("user_id", T.LongType(), False), T.StructField("note", T.StringType())])
    assert enforce_schema(df, wide).dtypes == [("user_id", "bigint"), ("note", "string")]
    with pytest.raises(ValueError, match="missing"):
        enforce_schema(df.select(F.lit(1).alias("x")), wide)
    require_utc(spark)
