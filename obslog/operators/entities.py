"""Entities out of observation payloads, and the newest version of each."""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslog.operators import contracts as C
from obslog.schemas import ISSUES, LABELS, PAYLOAD, USERS, EntitySpec
from obslog.sources.folder import cut, dealt, view_of
from obslog.sources.log import instant


def parsed(observations: DataFrame) -> DataFrame:
    """Observations with their payload as a struct, parsed once for all entities that read it.

    What is no JSON object gives a null struct. A number in a text field is taken as text;
    a fraction or boolean in a number field is a null. Parsed rows come back as they are."""
    return observations if "_p" in observations.columns else observations.withColumn("_p", F.from_json("raw_json", PAYLOAD))


_TEXT, _INSTANT = "text", "instant"

# The output columns and the payload fields that they come from.
ISSUE_FIELDS = [
    ("issue_number", "number", _TEXT),
    ("title", "title", _TEXT),
    ("state", "state", _TEXT),
    ("author_user_id", "user.id", _TEXT),
    ("created_at", "created_at", _INSTANT),
    ("updated_at", "updated_at", _INSTANT),
    ("closed_at", "closed_at", _INSTANT),
    ("_payload_id", "id", _TEXT),
    ("_created_raw", "created_at", _TEXT),
    ("_updated_raw", "updated_at", _TEXT),
    ("_closed_raw", "closed_at", _TEXT),
]
USER_FIELDS = [("user_id", "user.id", _TEXT), ("login", "user.login", _TEXT), ("user_type", "user.type", _TEXT), ("_payload_id", "id", _TEXT)]
LABEL_FIELDS = [("label_id", "id"), ("name", "name"), ("color", "color"), ("description", "description"), ("is_default", "default")]
ISSUE_COLUMNS = ["repository_owner", "repository_name", "issue_id", "issue_number", "title", "state", "is_pull_request", "author_user_id", "created_at", "updated_at", "closed_at", "source_run_id"]
LABEL_COLUMNS = ["repository_owner", "repository_name", "label_id", "name", "color", "description", "is_default", "observed_at", "source_run_id"]
USER_COLUMNS = ["user_id", "login", "user_type", "observed_at", "source_run_id"]
RELATION_COLUMNS = ["repository_owner", "repository_name", "issue_id", "label_id", "observed_at", "source_run_id"]

_ORIGIN = ["_ingested_at", "_page_or_batch_reference", "raw_json"]


def _fields(table: list[tuple[str, str, str]]) -> list[Column]:
    """The columns that a table of (column, payload field, kind) names."""
    return [(instant(F.col(f"_p.{path}")) if kind == _INSTANT else F.col(f"_p.{path}")).alias(name) for name, path, kind in table]


def issues(parsed_rows: DataFrame) -> DataFrame:
    """One row per observation: typed columns, and the raw ones that the rules look at.

    An issue is a pull request if its payload has a `pull_request` that isn't null."""
    own = [_pull(parsed_rows), F.col("_run_id").alias("source_run_id"), F.col("source_updated_at").alias("_source_updated_at")]
    return parsed_rows.select(*ISSUES.keys, *_fields(ISSUE_FIELDS), *own, *_origin(parsed_rows))


def is_pull_request(raw_json: Column) -> Column:
    return F.get_json_object(raw_json, "$.pull_request").isNotNull()


def without_text(parsed_rows: DataFrame) -> DataFrame:
    """Parsed rows without the payload's text, which `_p` and is_pull_request stand for from here on."""
    return parsed_rows.withColumn("is_pull_request", is_pull_request(F.col("raw_json"))).drop("raw_json")


def _pull(parsed_rows: DataFrame) -> Column:
    return F.col("is_pull_request") if "is_pull_request" in parsed_rows.columns else is_pull_request(F.col("raw_json")).alias("is_pull_request")


def _origin(rows: DataFrame) -> list[str]:
    return [c for c in _ORIGIN if c in rows.columns]


_OBSERVED = [("source_updated_at", "observed_at"), ("_run_id", "source_run_id")]


def _observed() -> list[Column]:
    return [F.col(a).alias(b) for a, b in _OBSERVED]


def envelopes(parsed_rows: DataFrame) -> DataFrame:
    """One row per observation with its label array, before it is taken apart."""
    return parsed_rows.select(*ISSUES.keys, F.col("_p.id").alias("_payload_id"), F.col("_p.labels").alias("labels"), *_observed(), *_origin(parsed_rows))


def labels(envelope_rows: DataFrame) -> DataFrame:
    """One row per label of each observation; colours in lower case. No labels, no rows."""
    one = envelope_rows.withColumn("_x", F.explode("labels"))
    fields = [(F.lower(f"_x.{path}") if name == "color" else F.col(f"_x.{path}")).alias(name) for name, path in LABEL_FIELDS]
    return one.select(*ISSUES.keys[:2], *fields, F.col("issue_id").alias("source_issue_id"), "observed_at", "source_run_id", *_origin(envelope_rows))


def users(parsed_rows: DataFrame) -> DataFrame:
    """The author of each observation; a user is the same in all repositories."""
    return parsed_rows.select(*_fields(USER_FIELDS), F.col("issue_id").alias("source_issue_id"), *_observed(), *_origin(parsed_rows))


def latest(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is last in the given order, all columns descending.

    Written as a rank compared with 1, which Spark limits to one row per key in each task
    before it shuffles: a hot key is no hot task."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order]))
    return rows.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def latest_of(rows: DataFrame, spec: EntitySpec, order: str | None = None) -> DataFrame:
    return latest(rows, spec.keys, [order or spec.order, *spec.ties])


def newest(observations: DataFrame, make: Callable[[DataFrame], DataFrame], keys: Sequence[str], order: Sequence[str], columns: Sequence[str], within: str | None = None, by: Sequence[str] = ()) -> DataFrame:
    """`columns` of what `latest` keeps of `make`'s rows, written on the way, for orders that end with the payload's text.

    The text is by far the widest column and decides only between rows that are equal in all
    that comes before it. So rows are ranked, sorted and exchanged without it: of those that
    tie, equal ones are one row, and only keys whose tied rows differ are ranked once more, with the text.
    `make` gets parsed rows with and without it.

    within: a column; the newest of each of its values is kept, and _newest tells which is the newest of the key. by: columns, the
    keys or some of them, in whose buckets the result is written; they are what rows are exchanged by, once."""
    *before, text = order
    if text != "raw_json":
        raise ValueError(f"the order must end with raw_json, not with {text}")
    by = list(by or (keys if within else ()))
    each, told, kept = [*([within] if within else []), *keys], ["_newest"] if within else [], list(dict.fromkeys([*columns, *([within] if within else [])]))

    def placed(of: Sequence[str], order: Sequence[str]) -> Window:
        return Window.partitionBy(*of).orderBy(*[F.desc(c) for c in order])

    def differs(of: Sequence[str]) -> Column:
        """Whether a row is another one than the first of those that tie with it."""
        return ~F.struct(*columns).eqNullSafe(F.first(F.struct(*columns)).over(placed(of, before).rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    rows = make(without_text(parsed(observations))).select(list(dict.fromkeys([*each, *before, *kept])))
    top = (dealt(rows, by) if by else rows).withColumn("_rank", F.rank().over(placed(each, before))).where("_rank = 1").drop("_rank")
    top = top.withColumn("_n", F.row_number().over(placed(each, before))).withColumn("_differs", differs(each)).where("_n = 1 OR _differs")
    if within:
        first = (F.rank().over(placed(keys, before)) == 1) & ~F.col("_differs")
        top = top.withColumn("_newest", F.row_number().over(placed(keys, before)) == 1).withColumn("_differs", F.col("_differs") | (first & differs(keys)))
    found = cut(top.select(*dict.fromkeys([*keys, *kept]), *told, "_n", "_differs"), by, "zstd")
    if found.where("_differs").isEmpty():
        return view_of(found, found.select(*kept, *told))
    tied = found.where("_differs").select(*[F.col(k).alias(f"_tied_{k}") for k in keys]).distinct()
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_tied_{k}")) for k in keys])
    again = latest(make(parsed(observations)).join(tied, same, "left_semi"), each, order)
    again = again.withColumn("_newest", F.row_number().over(placed(keys, order)) == 1) if within else again
    return found.join(tied, same, "left_anti").select(*kept, *told).unionByName(again.select(*kept, *told))


def everything(parsed_rows: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """One row per observation with the columns of its issue, its author and its label envelope; what they share has one column."""
    of_user = [f for f in USER_FIELDS if f[0] != "_payload_id"]
    own = [_pull(parsed_rows), F.col("source_updated_at").alias("_source_updated_at"), F.col("issue_id").alias("source_issue_id")]
    return parsed_rows.select(*ISSUES.keys, *_fields(ISSUE_FIELDS), *_fields(of_user), F.col("_p.labels").alias("labels"), *own, *_observed(), *also, *_origin(parsed_rows))


#: What `everything` must meet: the rules of all entities, each once.
ALL_RULES = list({name: (name, bad) for name, bad in (*C.ISSUE_RULES, *C.USER_RULES, *C.ENVELOPE_RULES, *C.ELEMENT_RULES)}.values())


def check_observations(observations: DataFrame) -> None:
    """An error if any observation is malformed as an issue, a user or a label envelope: one read judges all rules."""
    C.require_valid(everything(parsed(observations)), ALL_RULES, "observations")


#: What an observation tells of, and the entity that each table is read off.
KINDS = {"issues": "issues", "users": "users", "labels": "labels", "relations": "envelopes"}
_KEY = ["_owner", "_name", "_key"]
_TAGGED = (["entity", *_KEY], ["_order", *ISSUES.ties], ["entity", *_KEY, "_order", "source_run_id", "issues", "users", "labels", "label_ids"])
# The columns of an entity, and those of them that a tagged row has for all entities.
_OF = {"issues": ISSUE_COLUMNS, "users": USER_COLUMNS, "labels": LABEL_COLUMNS, "envelopes": [*ISSUES.keys, "label_ids", "observed_at", "source_run_id"]}
_PLACE = {"repository_owner": "_owner", "repository_name": "_name", "source_run_id": "source_run_id"}
_SHARED = {
    "issues": {**_PLACE, "issue_id": "_key", "updated_at": "_order"},
    "users": {"user_id": "_key", "observed_at": "_order", "source_run_id": "source_run_id"},
    "labels": {**_PLACE, "label_id": "_key", "observed_at": "_order"},
    "envelopes": {**_PLACE, "issue_id": "_key", "observed_at": "_order", "label_ids": "label_ids"},
}


def newest_of_each(observations: DataFrame, check: bool = True) -> DataFrame:
    """The newest issues, users, labels and label envelopes of observations, as tagged rows.

    One scan and one parse: a generator gives out an observation's entities as tagged rows, and
    one ranking by tag and key, limited in each task before the one exchange, keeps the
    newest of each. `entity_table` reads a kind off it."""
    keys, order, columns = _TAGGED
    return latest(_tagged(parsed(observations), check), keys, order).select(*columns)


def newest_written(observations: DataFrame, check: bool = True, kinds: Sequence[str] = tuple(KINDS), within: str | None = None, columns: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """What `newest_of_each` gives, or the kinds of it that are asked for, ranked without the payload's text and written (`newest`).

    within: source_run_id or a column that observations have besides, such as one that marks a frozen input; the
    newest of each of its values, in buckets of the key, with _newest for the newest of all. columns: what is asked for of
    some kinds, besides what all rows have. Whatever the kinds, all rules judge every observation."""
    keys, order, out = _TAGGED
    return newest(observations, lambda rows: _tagged(rows, check, kinds, columns or {}, within), keys, order, out, within, _KEY if within else ())


def _tagged(parsed_rows: DataFrame, check: bool, kinds: Sequence[str] = tuple(KINDS), columns: dict[str, Sequence[str]] | None = None, also: str | None = None) -> DataFrame:
    """A row for each entity of an observation: its tag, its key, its order and, in the column of its tag, what it is besides.

    Checked rows have one time of updating and observing, so that an issue and its envelope are one row where both are asked for."""
    extra = [also] if also in parsed_rows.columns else []
    wide = everything(parsed_rows, extra)
    wide = C.checked(wide, ALL_RULES, "observations") if check else wide
    wide = wide.withColumn("label_ids", F.transform("labels", lambda x: x["id"]))
    no_text, no_ids = F.lit(None).cast("string"), F.lit(None).cast("array<bigint>")
    asked = {KINDS[k] for k in kinds}

    def rest(kind: str) -> list[str]:
        return [c for c in (columns or {}).get(kind, _OF[kind]) if c not in _SHARED[kind]]

    def struct(kind: str, value: Callable[[str], Column] = F.col) -> Column:
        return F.struct(*[value(c).alias(c) for c in rest(kind)] or [F.lit(True).alias("there")])

    def field(x: Column) -> Callable[[str], Column]:
        path = dict(LABEL_FIELDS)
        return lambda name: F.lower(x[path[name]]) if name == "color" else x[path[name]]

    no_label = F.get(F.transform(F.filter("labels", lambda x: F.lit(False)), lambda x: struct("labels", field(x))), F.lit(0))
    none = {"issues": F.when(F.lit(False), struct("issues")), "users": F.when(F.lit(False), struct("users")), "labels": no_label, "label_ids": no_ids}

    def tagged(kind: str, owner: Column, name: Column, key: Column, order: Column, **value: Column) -> Column:
        parts = none | value
        return F.struct(F.lit(kind).alias("entity"), owner.alias("_owner"), name.alias("_name"), key.alias("_key"), order.alias("_order"), *[v.alias(k) for k, v in parts.items()])

    place, seen = (F.col("repository_owner"), F.col("repository_name")), F.col("observed_at")
    both = check and {"issues", "envelopes"} <= asked
    single = []
    if "issues" in asked:
        single.append(tagged("issues", *place, F.col("issue_id"), F.col("updated_at"), issues=struct("issues"), **({"label_ids": F.col("label_ids")} if both else {})))
    if "users" in asked:
        single.append(tagged("users", no_text, no_text, F.col("user_id"), seen, users=struct("users")))
    if "envelopes" in asked and not both:
        single.append(tagged("envelopes", *place, F.col("issue_id"), seen, label_ids=F.col("label_ids")))
    parts = [F.array(*single)] if single else []
    parts += [F.transform("labels", lambda x: tagged("labels", *place, x["id"], seen, labels=struct("labels", field(x))))] if "labels" in asked else []
    return wide.select("source_run_id", *extra, *_origin(wide), F.inline(F.concat(*parts)))


def entity_table(newest: DataFrame, entity: str) -> DataFrame:
    """One kind of `newest_of_each`: issues, users, labels, or the relations of its envelopes."""
    kind = KINDS[entity]
    if kind == "envelopes":
        rows = newest.where("label_ids IS NOT NULL")
        return rows.select(*[F.col(_SHARED[kind][c]).alias(c) for c in ISSUES.keys], F.explode("label_ids").alias("label_id"), F.col("_order").alias("observed_at"), "source_run_id")
    has = newest.schema[kind].dataType.names
    return newest.where(F.col("entity") == kind).select(*[F.col(_SHARED[kind].get(c, f"{kind}.{c}")).alias(c) for c in _OF[kind] if c in _SHARED[kind] or c in has])


def latest_issues(observations: DataFrame, check: bool = True) -> DataFrame:
    """The newest row of each issue. As in all of these, one malformed observation, however old, fails the plan; a caller that has checked may turn that off."""
    rows = issues(parsed(observations))
    return latest_of(C.checked(rows, C.ISSUE_RULES, "issues") if check else rows, ISSUES).select(*ISSUE_COLUMNS)


def latest_labels(observations: DataFrame, check: bool = True) -> DataFrame:
    """The newest row of each label. It is written: a label's row has the text of its whole observation, which is left behind (`newest`)."""

    def rows(parsed_rows: DataFrame) -> DataFrame:
        seen = envelopes(parsed_rows)
        out = labels(C.checked(seen, C.ENVELOPE_RULES, "label envelopes") if check else seen)
        return C.checked(out, C.LABEL_RULES, "labels") if check else out

    return newest(observations, rows, LABELS.keys, [LABELS.order, *LABELS.ties], LABEL_COLUMNS)


def latest_users(observations: DataFrame, check: bool = True) -> DataFrame:
    rows = users(parsed(observations))
    return latest_of(C.checked(rows, C.USER_RULES, "users") if check else rows, USERS).select(*USER_COLUMNS)


def observed_scope(observations: DataFrame, check: bool = True) -> DataFrame:
    """The newest envelope of each issue with its labels, an empty array included."""
    rows = envelopes(parsed(observations))
    rows = C.checked(rows, [*C.ENVELOPE_RULES, *C.ELEMENT_RULES], "label envelopes") if check else rows
    return latest(rows, ISSUES.keys, ["observed_at", *ISSUES.ties])


def relations_of(scope: DataFrame) -> DataFrame:
    """(issue, label) pairs of newest envelopes."""
    return scope.select("repository_owner", "repository_name", "issue_id", F.explode("labels.id").alias("label_id"), "observed_at", "source_run_id")
