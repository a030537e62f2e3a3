"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import without


def uniform(*cols, seed: int) -> Column:
    """A hash-seeded number strictly between 0 and 1: the upper 52 bits of the hash and a half."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.shiftrightunsigned(h, 12).cast("double") + 0.5) / F.lit(float(1 << 52))


def poisson_count(mean: Column, u: Column) -> Column:
    """The smallest k at which the Poisson distribution function with this mean reaches u.

    The sum runs over twelve standard deviations past the mean, where the rest of the
    distribution is less than a double can hold; it suits means up to some hundreds."""
    last = (F.ceil(mean + 12 * F.sqrt(mean)) + 20).cast("int")
    start = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("cdf"))

    def step(acc, i):
        p = acc["p"] * mean / i
        return F.when(acc["cdf"] >= u, acc).otherwise(F.struct((acc["k"] + 1).alias("k"), p.alias("p"), (acc["cdf"] + p).alias("cdf")))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["k"])


#: Means above this are split into equal parts, each drawn on its own: a sum of Poisson numbers is one.
PART = 64.0
#: A rate table of at most so many rows is broadcast.
BROADCAST_SOURCES = 100_000


def replication_counts(mean: Column, *key, seed: int) -> Column:
    """How often to repeat a row whose mean repetition rate is `mean`; 0 for a null or no positive mean."""
    parts = F.greatest(F.ceil(mean / PART), F.lit(1)).cast("int")
    drawn = F.aggregate(
        F.sequence(F.lit(1), parts),
        F.lit(0),
        lambda acc, i: acc + poisson_count(mean / parts, uniform(*key, i, seed=seed)),
    )
    return F.when(mean > 0, drawn).otherwise(F.lit(0))


def source_rates(docs: DataFrame, source_col: str = "source", weights: DataFrame | None = None, total: float | None = None, alpha: float = 0.5) -> DataFrame:
    """(source, n_docs, rate): the mean repetition rate that brings each source to its target weight.

    weights: a table of source and weight (not negative; they needn't sum to 1). A source
    that it lacks gets 0. Without it, a source's weight is its row count to the power
    `alpha`, which lifts small sources. total: the expected number of rows of the mixture,
    by default as many as there are. A null source is a source of its own."""
    counts = docs.groupBy(F.col(source_col).alias("source")).agg(F.count("*").alias("n_docs"))
    if weights is None:
        weighted = counts.withColumn("weight", F.pow(F.col("n_docs").cast("double"), F.lit(alpha)))
    else:
        w = weights.select(F.col("source").alias("__s"), F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight"))
        w = w.groupBy("__s").agg(F.max("weight").alias("weight"))
        weighted = counts.join(w, F.col("source").eqNullSafe(F.col("__s")), "left").select("source", "n_docs", F.coalesce("weight", F.lit(0.0)).alias("weight"))
    sums = weighted.agg(F.sum("weight").alias("__w"), F.sum("n_docs").alias("__n"))
    w, n = sums.first()
    n = total if total is not None else n
    rate = F.col("weight") * F.lit(float(n or 0) / float(w)) / F.col("n_docs") if w else F.lit(0.0)
    return weighted.select("source", "n_docs", rate.alias("rate"))


def mix_sources(docs: DataFrame, rates: DataFrame, id_col: str = "doc_id", source_col: str = "source", seed: int = 17, mark: bool = True) -> DataFrame:
    """`docs` with each row repeated by a Poisson number of its source's rate, in random order.

    The draw depends on the id, the text's hash where there is a `text`, and the seed alone,
    so that a lost task draws the same again; rows that are equal in these are drawn alike.
    Every copy goes to a random partition and random place in it, by hash: one exchange,
    in which a hot source or a much repeated row spreads over all partitions. With `mark`,
    columns replica (1, 2, ...) and rate are added, replacing columns of these names.
    The rates, one row per source, are counted: up to BROADCAST_SOURCES of them are broadcast,
    more are joined by a shuffle whose skewed partitions Spark splits. Null sources are a
    source; rows of a source without a rate go. Long texts move as they are. Columns named
    like the inner ones, which begin with two underscores, are left out. No rows give no rows."""
    key = [F.col(f"`{id_col}`"), *([F.xxhash64("text")] if "text" in docs.columns else [])]
    inner = ("__source", "__rate", "__n", "__copy", "__place")
    names = [c for c in without(docs, *inner).columns if not mark or c.lower() not in ("replica", "rate")]
    r = rates.select(F.col("source").alias("__source"), F.col("rate").alias("__rate"))
    if r.count() <= BROADCAST_SOURCES:
        r = F.broadcast(r)
    drawn = (
        without(docs, *inner)
        .join(r, F.col(f"`{source_col}`").eqNullSafe(F.col("__source")))
        .withColumn("__n", replication_counts(F.col("__rate"), *key, seed=seed))
        .where("__n > 0")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__n"))))
        .withColumn("__place", F.xxhash64(F.lit(seed + 1), *key, "__copy"))
        .repartition("__place")
        .sortWithinPartitions("__place")
    )
    out = [F.col(f"`{c}`") for c in names]
    return drawn.select(*out, *([F.col("__copy").alias("replica"), F.col("__rate").alias("rate")] if mark else []))
