"""Observation logs, ledgers and change feeds derived from the relational test tables.

Orders become issues and parts become labels; four runs observe them. Events become a
second log. Everything is a deterministic function of the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The four runs of the order log.
RUNS = {
    "run_1": (1, "2001-09-01 22:00:00", "2001-09-01 23:00:00", "succeeded"),
    "run_2": (2, "2001-09-03 23:50:00", "2001-09-04 00:10:00", "succeeded"),
    "run_3": (3, "2001-09-05 10:00:00", "2001-09-05 10:05:00", "failed"),
    "run_4": (4, "2001-09-06 10:00:00", "2001-09-06 11:00:00", "succeeded"),
}
WINDOW = ("2001-08-31", "2001-09-07")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table with its zone-less timestamps as UTC instants."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*[F.col(c).cast("timestamp").alias(c) if t == "timestamp_ntz" else F.col(c) for c, t in df.dtypes])


def _iso(when: Column) -> Column:
    return F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _moment(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def label_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey and its distinct parts as an array of labels."""
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey").distinct()
    label = F.struct(
        (F.col("p_partkey") + 1).alias("id"),
        F.col("p_name").alias("name"),
        F.upper(F.substring(F.md5(F.col("p_brand").cast("binary")), 1, 6)).alias("color"),
        F.col("p_type").alias("description"),
        (F.col("p_size") > 25).alias("default"),
    )
    return pairs.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(label)).alias("labels"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their repository, author and labels."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.join(label_sets(spark, sf_dir), F.col("o_orderkey") == F.col("l_orderkey"), "left").withColumn("labels", F.coalesce("labels", F.expr("filter(array(labels[0]), x -> false)")))


def _looks() -> Column:
    """Per order, the array of what each run saw of it."""
    key, status, day = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderdate")
    days = lambda n: day + F.make_dt_interval(days=F.lit(n))
    usual = F.concat(F.lit("batch-"), (key % 12 + 1).cast("string"))
    title = F.concat(F.lit("order "), key.cast("string"))
    nothing = F.lit(None).cast("timestamp")

    def look(run: str, state: str | Column, updated: Column, closed: Column, labelled: bool | Column, batch: Column = usual, name: Column = title) -> Column:
        lit = lambda x: x if isinstance(x, Column) else F.lit(x)
        return F.struct(F.lit(run).alias("run"), lit(state).alias("state"), updated.alias("updated"), closed.alias("closed"), lit(labelled).alias("labelled"), batch.alias("batch"), name.alias("title"))

    late = key % 13 == 0
    twice = key % 17 == 0
    shut = status == "F"
    emptied = (status == "O") & (key % 5 == 0)
    second = look(
        "run_2",
        F.when(shut, "closed").otherwise("open"),
        F.when(shut, days(30)).when(emptied, days(10)).otherwise(day),
        F.when(shut, days(30)),
        ~emptied,
    )
    return F.array_compact(
        F.array(
            F.when(~late, look("run_1", "open", day, nothing, True, F.when(twice, F.lit("batch-10")).otherwise(usual))),
            F.when(~late & twice, look("run_1", "open", day, nothing, True, F.lit("batch-9"), F.concat(title, F.lit(" dup")))),
            F.when(status.isin("F", "P") | (key % 5 == 0) | late, second),
            F.when(key % 97 == 0, look("run_3", "open", days(40), nothing, True, usual, F.concat(title, F.lit(" edited")))),
            F.when(key % 11 == 0, look("run_4", "open", days(-1), nothing, True)),
        )
    )


def payloads(spark: SparkSession, sf_dir: str, flawed: bool = False) -> DataFrame:
    """payload (JSON text) with owner, name, run, batch and version, as an API would have given them.

    flawed: of the orders divisible by 101 every third has a blank title, a creation time
    without a zone, or no user; every other one repeats its labels or has none, and all have
    a bad colour and a blank login in the rest."""
    seen = orders(spark, sf_dir).withColumn("look", F.explode(_looks()))
    look = F.col("look")
    key = F.col("o_orderkey")
    bad = (key % 101 == 0) if flawed else F.lit(False)
    labels = F.when(look["labelled"], F.col("labels")).otherwise(F.expr("filter(labels, x -> false)"))
    if flawed:
        labels = (
            F.when(bad & (key % 4 == 0), F.lit(None))
            .when(bad & (key % 4 == 1), F.concat(labels, labels))
            .when(bad & (key % 4 == 2), F.transform(labels, lambda x: x.withField("color", F.lit("not-a-color"))))
            .otherwise(labels)
        )
    user = F.struct((F.col("o_custkey") + 1).alias("id"), F.when(bad & (key % 3 == 0), F.lit("  ")).otherwise(F.col("c_name")).alias("login"), F.col("c_mktsegment").alias("type"))
    created = _iso(F.col("o_orderdate") - F.make_dt_interval(days=F.lit(2)))
    body = F.struct(
        (key + 1).alias("id"),
        (key + 1).alias("number"),
        F.when(bad & (key % 3 == 0), F.lit("  ")).otherwise(look["title"]).alias("title"),
        look["state"].alias("state"),
        F.when(~(bad & (key % 3 == 2)), user).alias("user"),
        labels.alias("labels"),
        F.when(bad & (key % 3 == 1), F.regexp_replace(created, "Z$", "")).otherwise(created).alias("created_at"),
        _iso(look["updated"]).alias("updated_at"),
        _iso(look["closed"]).alias("closed_at"),
    )
    return seen.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"), F.col("r_name").alias("owner"), F.col("n_name").alias("name"), look["run"].alias("run"), look["batch"].alias("batch"), look["updated"].alias("updated"), (key + 1).alias("issue_id"))


def run_value(run: Column, i: int, kind: str) -> Column:
    """A fixed value of a run, looked up by its id."""
    return F.element_at(F.create_map(*[x for r, v in RUNS.items() for x in (F.lit(r), F.lit(v[i]))]), run).cast(kind)


def observations(spark: SparkSession, sf_dir: str, flawed: bool = False) -> DataFrame:
    """The order log: observation rows with _commit_version."""
    p = payloads(spark, sf_dir, flawed)
    return p.select(
        F.col("owner").alias("repository_owner"),
        F.col("name").alias("repository_name"),
        "issue_id",
        F.col("updated").alias("source_updated_at"),
        F.col("payload").alias("raw_json"),
        F.col("run").alias("_run_id"),
        run_value(F.col("run"), 1, "timestamp").alias("_ingested_at"),
        F.col("batch").alias("_page_or_batch_reference"),
        run_value(F.col("run"), 0, "bigint").alias("_commit_version"),
    )


def ledger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lifecycle events of the four runs, with the candidate each found in the log, a start and an end twice, and a run that is still going."""
    log = observations(spark, sf_dir)
    found = log.groupBy(F.col("_run_id").alias("run_id")).agg(F.max("source_updated_at").alias("candidate_watermark_value"))
    rows = found.withColumn("start", run_value(F.col("run_id"), 1, "timestamp")).withColumn("end", run_value(F.col("run_id"), 2, "timestamp")).withColumn("last", run_value(F.col("run_id"), 3, "string"))
    none = F.lit(None).cast("timestamp")
    event = lambda status, at, candidate, message=F.lit(None).cast("string"): F.struct(status.alias("status"), at.alias("at"), candidate.alias("candidate_watermark_value"), message.alias("error_message"))
    again = F.col("end") + F.make_dt_interval(hours=F.lit(1))
    events = F.array(
        event(F.lit("running"), F.col("start"), none),
        event(F.lit("running"), F.col("start") + F.make_dt_interval(mins=F.lit(1)), F.col("candidate_watermark_value")),
        event(F.col("last"), F.col("end"), F.col("candidate_watermark_value"), F.when(F.col("last") == "failed", F.lit("boom"))),
        event(F.lit("failed"), again, none, F.lit("too late")),
    )
    open_run = log.agg(F.max("_ingested_at").alias("m")).select(F.lit("run_5").alias("run_id"), F.lit("running").alias("status"), (F.col("m") + F.make_dt_interval(days=F.lit(1))).alias("at"), none.alias("candidate_watermark_value"), F.lit(None).cast("string").alias("error_message"))
    return rows.select("run_id", F.explode(events).alias("e")).select("run_id", "e.*").unionByName(open_run)


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One manifest per repository: version 4, the three runs that succeeded."""
    places = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return places.select(
        F.concat(F.lit("manifest-"), F.col("n_nationkey").cast("string")).alias("manifest_id"),
        F.col("r_name").alias("repository_owner"),
        F.col("n_name").alias("repository_name"),
        F.lit("observations").alias("bronze_table"),
        F.lit(4).cast("long").alias("bronze_version"),
        F.array(F.lit("run_1"), F.lit("run_2"), F.lit("run_4")).alias("successful_run_ids"),
        _moment("2001-09-07 00:00:00").alias("cutoff_at"),
        F.lit("abc123").alias("code_commit"),
        F.lit("1").alias("transformation_version"),
    )


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log: entity_id, at, state, value of the payload, and event_id to break ties."""
    e = table(spark, sf_dir, "events")
    return e.select((F.col("user_id") + 1).alias("entity_id"), F.col("ts").alias("at"), F.col("event_type").alias("state"), F.get_json_object("props", "$.k").cast("long").alias("k"), "event_id")


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Covered days of the event log: days with a signup."""
    e = table(spark, sf_dir, "events").where("event_type = 'signup'")
    return e.select(F.to_date("ts").alias("snapshot_date")).distinct()
