"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import cut


def connected_components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of a link between two different ids; the component is its smallest node.

    Each round points every node at the smallest neighbour it knows, as table joins: no
    neighbourhood is gathered in a task and only a row count and a checksum reach the
    driver. Smallest neighbours are summed up in each task first and written as a table, so
    that Spark can split the join where a node has very many links. Null ends and self links
    are ignored; no links give no rows. Links that repeat or come in both directions count
    once."""
    edges = cut(
        links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("hi") != F.col("lo")))
        .distinct()
    )
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select("lo", "hi"))
        least = cut(both.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("u"), F.least("hi", "m").alias("m")))
        large = both.join(least, both.hi == least.u).where((F.col("lo") > F.col("hi")) & (F.col("lo") != F.col("m"))).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        large = cut(large.union(edges.groupBy("hi").agg(F.min("lo").alias("lo"))).distinct())
        least = cut(large.groupBy("hi").agg(F.min("lo").alias("m")).select(F.col("hi").alias("u"), "m"))
        small = large.join(least, large.hi == least.u).where(F.col("lo") != F.col("m")).select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = cut(small.union(least.select("u", "m")).distinct())
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    stars = edges.groupBy("hi").agg(F.min("lo").alias("component")).select(F.col("hi").alias("node"), "component")
    return stars.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
