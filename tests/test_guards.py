"""Guards that no later condition moves, weakens or sets off."""

import pytest
from pyspark.sql import functions as F
from test_state import log, payload  # noqa: F401

from obslog.operators import contracts, entities, state
from obslog.schemas import ISSUES, RELATIONS

KEYS = ["repository_owner", "repository_name", "issue_id"]
MAKERS = {"issues": entities.latest_issues, "labels": entities.latest_labels, "users": entities.latest_users, "scope": entities.observed_scope}
#: What each maker's rows are asked for: a key column and the values of the two sound observations.
KEY = {"issues": ("issue_id", 5), "labels": ("label_id", 301), "users": ("user_id", 2001), "scope": ("issue_id", 5)}


def asks(spark, column, value):
    """Conditions that an optimizer would like to move down."""
    wanted = spark.createDataFrame([(value,)], f"{column} long")
    yield "equality", lambda df: df.where(F.col(column) == value)
    yield "in", lambda df: df.where(F.col(column).isin(value, value + 10_000))
    yield "semi join", lambda df: df.join(wanted, column, "left_semi")
    yield "broadcast join", lambda df: df.join(F.broadcast(wanted), column)
    yield "not null", lambda df: df.where(F.col(column).isNotNull() & (F.col(column) == value))
    yield "one column", lambda df: df.where(F.col(column) == value).select(column)


@pytest.mark.parametrize("name", sorted(MAKERS))
def test_a_sound_log_is_not_refused_by_a_condition(spark, log, name):  # noqa: F811
    rows = log({"p": payload(5), "issue": 5}, {"p": payload(6), "issue": 6})
    column, value = KEY[name]
    for what, ask in asks(spark, column, value):
        assert ask(MAKERS[name](rows)).count() == 1, what


@pytest.mark.parametrize("name", sorted(MAKERS))
def test_a_bad_row_is_not_hidden_by_a_condition(spark, log, name):  # noqa: F811
    """Bad rows that the condition would leave out: another key, and a null one."""
    column, value = KEY[name]
    spoil = {"title": " ", "user": {"id": 9, "login": "", "type": "User"}, "labels": [{"id": 9, "name": " ", "color": "x", "default": True}]}
    other = log({"p": payload(5), "issue": 5}, {"p": payload(6, **spoil), "issue": 6})
    null = log({"p": payload(5), "issue": 5}, {"p": payload(None, **spoil), "issue": None})
    for rows in (other, null):
        for what, ask in asks(spark, column, value):
            with pytest.raises(Exception, match="blank|not positive|malformed|differs"):
                ask(MAKERS[name](rows)).collect()
                pytest.fail(what)


def test_duplicate_keys_are_not_hidden_by_a_condition(spark):
    rows = spark.createDataFrame([(5, "a"), (6, "b"), (6, "c")], "issue_id long, x string")
    once = spark.createDataFrame([(5, "a"), (6, "b")], "issue_id long, x string")
    for what, ask in asks(spark, "issue_id", 5):
        with pytest.raises(Exception, match="duplicate keys issue_id"):
            ask(contracts.checked_unique(rows, ["issue_id"])).collect()
            pytest.fail(what)
        assert ask(contracts.checked_unique(once, ["issue_id"])).count() == 1
    with pytest.raises(Exception, match="duplicate keys"):
        contracts.checked_unique(rows, ["issue_id"]).count()


def test_no_condition_stands_below_the_guard(spark, log):  # noqa: F811
    df = entities.latest_issues(log({"p": payload(5), "issue": 5})).where("issue_id = 5")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.rindex("Generate inline") :]
    assert "= 5" in plan[: plan.index("Generate inline")] and "= 5" not in below


@pytest.fixture
def upsert(spark):
    ddl = "repository_owner string, repository_name string, issue_id long, updated_at timestamp, title string"
    rows = lambda *r: spark.sql("SELECT 1").sparkSession.createDataFrame([("o", "r", k, None, t) for k, t in r], ddl.replace("timestamp", "string")).withColumn("updated_at", F.to_timestamp(F.lit("2026-01-01"))).select("repository_owner", "repository_name", "issue_id", "updated_at", "title")
    return lambda target, source: state.guarded_upsert(rows(*target), rows(*source), ISSUES, 2, F.current_timestamp())


def test_an_upsert_of_repeated_keys_fails_whatever_is_asked(spark, upsert):
    for of in (0, 1):
        for what, ask in asks(spark, "issue_id", 5):
            with pytest.raises(Exception, match="issues: duplicate keys"):
                ask(upsert([(5, "old"), (7, "other")], [(5, "new"), (6, "a"), (6, "b")])[of]).collect()
                pytest.fail(what)
        with pytest.raises(Exception, match="issues: duplicate keys"):
            upsert([], [(None, "a"), (None, "b")])[of].where("issue_id = 5").collect()
    new, feed = upsert([(5, "old"), (7, "other")], [(5, "new"), (6, "a")])
    assert [r.title for r in new.where("issue_id = 5").collect()] == ["new"]
    assert sorted(r._change_type for r in feed.where("issue_id = 5").collect()) == ["update_postimage", "update_preimage"]


@pytest.fixture
def child(spark):
    times = F.to_timestamp(F.lit("2026-01-02"))

    def relations(*rows):
        return spark.createDataFrame([("o", "r", i, k, "run") for i, k in rows], "repository_owner string, repository_name string, issue_id long, label_id long, source_run_id string").withColumn("observed_at", times)

    def scope(*rows):
        return spark.createDataFrame([("o", "r", i, "run") for i in rows], "repository_owner string, repository_name string, issue_id long, source_run_id string").withColumn("observed_at", times)

    return relations, scope


@pytest.mark.parametrize("parents", [False, True])
def test_a_reconciliation_fails_whatever_is_asked(spark, child, parents):
    relations, scope = child
    now = scope(5, 6).select(*KEYS, (F.col("observed_at") - F.expr("INTERVAL 1 DAY")).alias("updated_at")) if parents else None
    stored = relations((5, 1), (7, 1))
    cases = [
        (scope(5), relations((5, 2), (6, 1)), "outside the observed scope"),
        (scope(5), relations((5, 2), (None, 1)), "outside the observed scope"),
        (scope(5, 6), relations((5, 2), (6, 1), (6, 1)), "relations: duplicate keys"),
        (scope(5, 6, 6), relations((5, 2)), "scope: duplicate keys"),
    ]
    for seen, found, told in cases:
        for of in (0, 1):
            for what, ask in list(asks(spark, "issue_id", 5))[::2]:
                with pytest.raises(Exception, match=told):
                    ask(state.reconcile(stored, seen, found, KEYS, RELATIONS, 2, parent_state=now)[of]).collect()
                    pytest.fail(what)
    new, feed = state.reconcile(stored, scope(5, 6), relations((5, 2), (6, 1)), KEYS, RELATIONS, 2, parent_state=now)
    assert [(r.issue_id, r.label_id) for r in new.where("issue_id = 5").collect()] == [(5, 2)]
    assert sorted(r._change_type for r in feed.where("issue_id = 5").collect()) == ["delete", "insert"]


def test_observations_older_than_their_parents_change_nothing(spark, child):
    relations, scope = child
    ahead = scope(5).select(*KEYS, (F.col("observed_at") + F.expr("INTERVAL 1 DAY")).alias("updated_at"))
    new, feed = state.reconcile(relations((5, 1), (6, 3)), scope(5, 6), relations((5, 2), (6, 4)), KEYS, RELATIONS, 2, parent_state=ahead)
    assert sorted((r.issue_id, r.label_id) for r in new.collect()) == [(5, 1), (6, 4)]
    assert {r.issue_id for r in feed.collect()} == {6}
