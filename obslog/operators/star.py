"""The star schema: a fact, four dimensions, a bridge, and the questions they answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslog.functions.keys import date_key, hash_key
from obslog.operators.entities import ISSUE_COLUMNS

ISSUE_KEY = ("repository_owner", "repository_name", "issue_id")
CALENDAR = ("2008-01-01", "2035-12-31")


LABEL_KEY = ("repository_owner", "repository_name", "label_id")


def issue_key() -> Column:
    return hash_key(*ISSUE_KEY).alias("issue_key")


def label_key() -> Column:
    return hash_key(*LABEL_KEY).alias("label_key")


def repository_key() -> Column:
    return hash_key("repository_owner", "repository_name").alias("repository_key")


def fact_columns() -> list[Column]:
    """The columns of the issue fact; the full and the incremental build both take them from here."""
    return [
        issue_key(),
        repository_key(),
        hash_key("author_user_id").alias("author_key"),
        date_key("created_at").alias("created_date_key"),
        date_key("updated_at").alias("updated_date_key"),
        date_key("closed_at").alias("closed_date_key"),
        *[F.col(c) for c in ISSUE_COLUMNS],
    ]


def fact_issue(issues: DataFrame) -> DataFrame:
    return issues.select(*fact_columns())


def bridge_columns() -> list[Column]:
    return [issue_key(), label_key(), *[F.col(c) for c in (*ISSUE_KEY, "label_id")]]


def bridge_issue_label(relations: DataFrame) -> DataFrame:
    return relations.select(*bridge_columns())


def dim_repository(issues: DataFrame) -> DataFrame:
    return issues.select("repository_owner", "repository_name").distinct().select(repository_key(), "repository_owner", "repository_name")


def dim_user(users: DataFrame) -> DataFrame:
    return users.select(hash_key("user_id").alias("user_key"), "user_id", "login", "user_type")


def dim_label(labels: DataFrame) -> DataFrame:
    return labels.select(label_key(), *LABEL_KEY, "name", "color", "description", "is_default")


def dim_date(spark: SparkSession, start: str = CALENDAR[0], end: str = CALENDAR[1]) -> DataFrame:
    """One row per day; weeks begin on Monday (1) and end on Sunday (7)."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("calendar_date"))
    d = F.col("calendar_date")
    iso = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).alias("calendar_year"),
        F.quarter(d).alias("calendar_quarter"),
        F.month(d).alias("month_number"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso.alias("iso_day_of_week_number"),
        F.date_format(d, "EEEE").alias("day_name"),
        (iso >= 6).alias("is_weekend"),
    )


def open_backlog(fact: DataFrame) -> DataFrame:
    return fact.where("state = 'open'").groupBy("repository_owner", "repository_name").agg(F.count("*").alias("open_issues"))


def top_authors(fact: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """The n authors of most issues, ties by id. Counted before the join, so that it moves one row per author."""
    counts = fact.groupBy("author_key").agg(F.count("*").alias("issues"))
    named = counts.join(users.select("user_key", "user_id", "login"), F.col("author_key") == F.col("user_key"))
    return named.select("user_id", "login", "issues").orderBy(F.desc("issues"), "user_id").limit(n)


def issues_per_label(bridge: DataFrame, labels: DataFrame) -> DataFrame:
    """Counted and joined by the columns that the label's key is a digest of, which are an eighth of its length."""
    counts = bridge.groupBy(*LABEL_KEY).agg(F.count("*").alias("issues"))
    return counts.join(labels.select(*LABEL_KEY, "name"), list(LABEL_KEY)).select(*LABEL_KEY, "name", "issues")


def issues_per_month(fact: DataFrame, calendar: DataFrame, role: str = "created_date_key") -> DataFrame:
    """Issues by calendar month of a date role (created, updated or closed)."""
    counts = fact.where(F.col(role).isNotNull()).groupBy(role).agg(F.count("*").alias("n"))
    months = counts.join(F.broadcast(calendar.select("date_key", "calendar_year", "month_number")), F.col(role) == F.col("date_key"))
    return months.groupBy("calendar_year", "month_number").agg(F.sum("n").alias("issues"))
