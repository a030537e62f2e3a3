"""Validation: named rules over rows, evaluated for all rules in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslog.schemas import require_columns
from obslog.sources.log import ZONED

#: A name, and what gives the condition that a bad row meets; columns need a session, which rules don't.
Rule = tuple[str, Callable[[], Column]]


def absent(c: str) -> Rule:
    return f"{c} missing", lambda: F.col(c).isNull()


def blank(c: str) -> Rule:
    return f"{c} blank", lambda: F.col(c).isNull() | (F.length(F.trim(c)) == 0)


def not_positive(c: str) -> Rule:
    return f"{c} not positive", lambda: F.col(c).isNull() | (F.col(c) <= 0)


def differs(a: str, b: str) -> Rule:
    return f"{a} differs from {b}", lambda: ~F.col(a).eqNullSafe(F.col(b))


def not_zoned(raw: str) -> Rule:
    return f"{raw} without zone", lambda: F.col(raw).isNull() | ~F.col(raw).rlike(ZONED) | F.col(raw).contains("\n")


_ENVELOPE = [blank("repository_owner"), blank("repository_name"), blank("source_run_id"), absent("_ingested_at")]

ISSUE_RULES: list[Rule] = [
    *_ENVELOPE,
    not_positive("issue_id"),
    differs("_payload_id", "issue_id"),
    not_positive("issue_number"),
    blank("title"),
    blank("state"),
    not_positive("author_user_id"),
    absent("_source_updated_at"),
    not_zoned("_created_raw"),
    absent("created_at"),
    not_zoned("_updated_raw"),
    differs("updated_at", "_source_updated_at"),
    ("_closed_raw without zone", lambda: F.col("_closed_raw").isNotNull() & (F.col("closed_at").isNull() | ~F.col("_closed_raw").rlike(ZONED))),
]

ENVELOPE_RULES: list[Rule] = [
    *_ENVELOPE,
    not_positive("issue_id"),
    differs("_payload_id", "issue_id"),
    absent("observed_at"),
    absent("labels"),
    ("labels repeat an id", lambda: F.coalesce(F.size("labels") != F.size(F.array_distinct(F.transform("labels", lambda x: x["id"]))), F.lit(False))),
]

def _bad_label(x: Column) -> Column:
    blank_name = x["name"].isNull() | (F.length(F.trim(x["name"])) == 0)
    color = F.lower(x["color"])
    return x["id"].isNull() | (x["id"] <= 0) | blank_name | color.isNull() | ~color.rlike("^[0-9a-f]{6}$") | (F.length(color) != 6) | x["default"].isNull()


#: The rules of single labels, for envelopes that are not taken apart.
ELEMENT_RULES: list[Rule] = [("a label is malformed", lambda: F.coalesce(F.exists("labels", _bad_label), F.lit(False)))]

LABEL_RULES: list[Rule] = [
    *_ENVELOPE,
    not_positive("label_id"),
    blank("name"),
    ("color not six hex digits", lambda: F.col("color").isNull() | ~F.col("color").rlike("^[0-9a-f]{6}$") | (F.length("color") != 6)),
    absent("is_default"),
    not_positive("source_issue_id"),
    absent("observed_at"),
]

USER_RULES: list[Rule] = [
    blank("source_run_id"),
    absent("_ingested_at"),
    not_positive("source_issue_id"),
    differs("_payload_id", "source_issue_id"),
    not_positive("user_id"),
    blank("login"),
    blank("user_type"),
    absent("observed_at"),
]

OBSERVATION_RULES: list[Rule] = [blank("repository_owner"), blank("repository_name"), not_positive("issue_id"), absent("source_updated_at"), absent("raw_json"), blank("_run_id"), absent("_ingested_at"), blank("_page_or_batch_reference")]


def worked_out(rows: DataFrame) -> DataFrame:
    """`rows`, with each column computed once however often what follows reads it.

    A filter moves below the projection that makes its columns and takes their expressions
    along: two dozen rules over a payload would parse it two dozen times. None moves below a
    generator of the columns it reads."""
    return rows.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))))


def judged(rows: DataFrame, rules: Sequence[Rule], into: str = "violations") -> DataFrame:
    """`rows` with the names of the rules that each breaks, in the rules' order. A rule that evaluates to null is kept."""
    return worked_out(rows).withColumn(into, F.array_compact(F.array(*[F.when(bad(), F.lit(name)) for name, bad in rules])))


def invalid(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return judged(rows, rules).where(F.size("violations") > 0)


def valid(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """The rows that break no rule (quarantine mode: `invalid` has the rest)."""
    return judged(rows, rules).where(F.size("violations") == 0).drop("violations")


class InvalidRows(ValueError):
    """Rows that break a rule, where the whole batch must then be refused."""


def require_valid(rows: DataFrame, rules: Sequence[Rule], what: str = "rows") -> DataFrame:
    """`rows`, if all of them are valid; older versions count as well, so this comes before any reduction."""
    first = invalid(rows, rules).select("violations").limit(1).collect()
    if first:
        raise InvalidRows(f"{what}: {', '.join(first[0][0])}")
    return rows


def refused(rows: DataFrame, bad: Column, told: Column, besides: Sequence[str] = ()) -> DataFrame:
    """`rows`, in a plan that fails with `told` on the first row for which `bad` holds.

    The failure stands inside the value that a generator gives out, in place of the row: a
    filter or semi-join on the rows that come out is no filter of the generator's, so that no
    later condition moves below it, keeps a bad row from it, or is put into the rules. What
    such a plan writes is not committed. It costs no job of its own.

    besides: columns that stay beside the generator, so that rows are still known to be dealt out by them. A condition on
    these can move below the guard: for rows that are all written before anything is asked of them."""
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c not in besides])
    return rows.select(*besides, F.inline(F.array(F.when(F.coalesce(bad, F.lit(False)), F.raise_error(told)).otherwise(row))))


def checked(rows: DataFrame, rules: Sequence[Rule], what: str = "rows") -> DataFrame:
    """`rows`, in a plan that fails if any of them breaks a rule; `require_valid` tells before the plan runs."""
    found = judged(rows, rules, "_broken")
    return refused(found, F.size("_broken") > 0, F.concat(F.lit(f"{what}: "), F.array_join("_broken", ", "))).drop("_broken")


def copies(keys: Sequence[str]) -> Column:
    """How many rows share a row's key."""
    return F.count(F.lit(1)).over(Window.partitionBy(*keys))


def repeated(keys: Sequence[str], what: str) -> Column:
    return F.lit(f"{what}: duplicate keys {', '.join(keys)}")


def checked_unique(rows: DataFrame, keys: Sequence[str], what: str = "rows") -> DataFrame:
    """`rows`, in a plan that fails if a key occurs more than once, whatever is asked of the rows afterwards."""
    return refused(rows.withColumn("_copies", copies(keys)), F.col("_copies") > 1, repeated(keys, what)).drop("_copies")


def any_invalid(rows: DataFrame, rules: Sequence[Rule]) -> bool:
    """Whether any row breaks a rule; the search ends with the first one."""
    return not invalid(rows, rules).limit(1).isEmpty()


def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, n) of the keys that occur more than once."""
    if not keys:
        raise ValueError("no key columns")
    return require_columns(rows, list(keys)).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(rows: DataFrame, keys: Sequence[str], what: str = "rows") -> DataFrame:
    if not duplicate_keys(rows, keys).isEmpty():
        raise InvalidRows(f"{what}: duplicate keys {', '.join(keys)}")
    return rows


def gate_report(df: DataFrame, table: str, not_null: Sequence[str] = (), unique: Sequence[Sequence[str]] = (), accepted: dict[str, Sequence] | None = None) -> DataFrame:
    """(table_name, gate, subject, failures) of the quality gates of a table.

    Null counts and value checks of all columns share one pass; each uniqueness gate is one
    aggregation and counts the keys that repeat."""
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null]
    checks += [("accepted_values", c, F.col(c).isNotNull() & ~F.col(c).isin(list(v))) for c, v in (accepted or {}).items()]
    parts = []
    if checks:
        counts = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, (_, _, bad) in enumerate(checks)])
        rows = F.array(*[F.struct(F.lit(g).alias("gate"), F.lit(s).alias("subject"), F.col(f"c{i}").cast("long").alias("failures")) for i, (g, s, _) in enumerate(checks)])
        parts.append(counts.select(F.inline(rows)))
    for keys in unique:
        parts.append(duplicate_keys(df, keys).agg(F.count("*").alias("failures")).select(F.lit("unique").alias("gate"), F.lit(",".join(keys)).alias("subject"), "failures"))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.select(F.lit(table).alias("table_name"), "gate", "subject", "failures")


def gate_failures(report: DataFrame) -> DataFrame:
    """The gates of a report that don't hold."""
    return report.where("failures > 0")


def require_gates(*reports: DataFrame) -> None:
    """An error that names the gates which don't hold; what follows a gate comes after this."""
    failed = [f"{r.table_name} {r.gate} {r.subject}: {r.failures}" for report in reports for r in gate_failures(report).limit(50).collect()]
    if failed:
        raise InvalidRows("gates failed: " + "; ".join(failed))


def orphans(child: DataFrame, parent: DataFrame, column: str, parent_column: str) -> DataFrame:
    """Distinct non-null foreign keys without a parent row."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).select(column).distinct().join(keys, column, "left_anti")
