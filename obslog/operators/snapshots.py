"""Daily snapshots: the state of each entity on each day that was observed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslog.functions.keys import hash_key
from obslog.operators.entities import latest
from obslog.operators.star import ISSUE_KEY


def day_coverage(runs: DataFrame, start: str, end: str) -> DataFrame:
    """(snapshot_date, coverage): observed if a run finished on that UTC day, else missing. A gap is not a zero."""
    spark = runs.sparkSession
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("snapshot_date"))
    seen = runs.select(F.to_date("finished_at").alias("snapshot_date")).distinct().withColumn("_seen", F.lit(True))
    return days.join(seen, "snapshot_date", "left").select("snapshot_date", F.when(F.col("_seen"), "observed").otherwise("missing").alias("coverage"))


def as_of_days(observations: DataFrame, covered: DataFrame, keys: Sequence[str], order: Sequence[str], at: str) -> DataFrame:
    """snapshot_date and the newest observation of each key before the end of each covered day.

    Not a join of days with all earlier observations: of each key and day the last
    observation is kept, and holds until the day before the key's next one. Each row then
    meets the covered days in its interval only. `at` is the observation's time, `order` the
    columns that make one newer, most significant first. The covered days, one array of a
    few thousand dates for a decade, come in as a scalar subquery."""
    per_day = observations.withColumn("_day", F.to_date(at))
    last = latest(per_day, [*keys, "_day"], order)
    until = F.date_sub(F.lead("_day").over(Window.partitionBy(*keys).orderBy("_day")), 1)
    held = last.withColumn("_until", until)
    days = covered.select("snapshot_date").distinct().agg(F.array_sort(F.collect_list("snapshot_date"))).scalar()
    inside = F.filter("_days", lambda d: (d >= F.col("_day")) & (F.col("_until").isNull() | (d <= F.col("_until"))))
    return held.withColumn("_days", days).withColumn("snapshot_date", F.explode(inside)).drop("_day", "_until", "_days")


def fact_daily(picked: DataFrame) -> DataFrame:
    """The daily issue fact out of the picked observations (parsed issues with run and ingest time)."""
    return picked.select(
        hash_key(*ISSUE_KEY).alias("issue_key"),
        hash_key("repository_owner", "repository_name").alias("repository_key"),
        "snapshot_date",
        *ISSUE_KEY,
        "state",
        (F.col("state") == "open").alias("is_open_on_date"),
        F.date_diff("snapshot_date", F.to_date("created_at")).alias("age_days"),
        F.col("source_run_id").alias("observation_run_id"),
        F.col("_ingested_at").alias("observed_at"),
    )


def labels_daily(picked: DataFrame) -> DataFrame:
    """(issue, day, label) of the same observations; they carry their labels, so nothing is joined back."""
    key = ("repository_owner", "repository_name", "label_id")
    rows = picked.select("snapshot_date", *ISSUE_KEY, F.explode("labels.id").alias("label_id"))
    return rows.select(hash_key(*ISSUE_KEY).alias("issue_key"), hash_key(*key).alias("label_key"), "snapshot_date", *ISSUE_KEY, "label_id")


def backlog_by_day(fact: DataFrame) -> DataFrame:
    return fact.groupBy("snapshot_date").agg(F.count_if("is_open_on_date").alias("open_issues"), F.count("*").alias("known_issues"))
