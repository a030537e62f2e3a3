"""Two-way comparison of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslog.sources.folder import cut


def diff_both_ways(left: DataFrame, right: DataFrame, without: Sequence[str] = ()) -> DataFrame:
    """Rows of either side that the other lacks, duplicates counted, with side and n.

    One aggregation over both sides in place of two EXCEPT ALL: each distinct row has the
    difference of its counts. Columns named in `without` (lineage) are left out; the others
    must agree."""
    a, b = [[c for c in x.columns if c not in without] for x in (left, right)]
    if sorted(a) != sorted(b):
        raise ValueError(f"columns differ: {sorted(set(a) ^ set(b))}")
    both = left.select(*a, F.lit(1).alias("_n")).unionByName(right.select(*a, F.lit(-1).alias("_n")))
    net = both.groupBy(*a).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return net.withColumn("side", F.when(F.col("_n") > 0, "left").otherwise("right")).withColumn("n", F.abs("_n")).drop("_n")


def bucket_sums(df: DataFrame, keys: Sequence[str], columns: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, n, a, b): for each bucket of the keys' hash the number of its rows, and two sums of hashes of them, in which their order makes no difference.

    Rows are summed up in the tasks that read them: only `buckets` rows a task are shuffled. Which
    columns are null is hashed as well, since a hash passes over nulls."""
    a, b = [F.sum(h.cast("decimal(38,0)")) for h in _hashes(columns)]
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
    return df.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), a.alias("a"), b.alias("b"))


def _hashes(columns: Sequence[str]) -> list[Column]:
    """Two hashes of a row, a and b."""
    whole = [x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return [F.xxhash64(F.lit(seed), *whole).alias(name) for seed, name in ((1, "a"), (2, "b"))]


def differing_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], without: Sequence[str] = (), buckets: int = 1024) -> DataFrame:
    """(bucket): the buckets of the keys' hash in which two tables don't hold the same rows, duplicates counted. At most `buckets` rows.

    That they do is as sure as two 64-bit hashes of each row are."""
    a, b = [[c for c in x.columns if c not in without] for x in (left, right)]
    if sorted(a) != sorted(b):
        raise ValueError(f"columns differ: {sorted(set(a) ^ set(b))}")
    one, two = bucket_sums(left, keys, a, buckets), bucket_sums(right, keys, a, buckets)
    both = one.select("bucket", F.struct("n", "a", "b").alias("l")).join(two.select("bucket", F.struct("n", "a", "b").alias("r")), "bucket", "full_outer")
    return both.where(~F.col("l").eqNullSafe(F.col("r"))).select("bucket")


def diff_by_buckets(left: DataFrame, right: DataFrame, keys: Sequence[str], without: Sequence[str] = (), buckets: int = 1024) -> DataFrame:
    """What `diff_both_ways` gives, found by checksums: whole rows are grouped only in buckets that differ, so that equal tables cost one read of each."""
    differ = cut(differing_buckets(left, right, keys, without, buckets))
    if differ.isEmpty():
        return diff_both_ways(left, right, without).limit(0)
    return diff_both_ways(_in_buckets(left, keys, differ, buckets), _in_buckets(right, keys, differ, buckets), without)


def _in_buckets(df: DataFrame, keys: Sequence[str], differ: DataFrame, buckets: int) -> DataFrame:
    bucket = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(buckets)).cast("int")
    few = F.broadcast(differ.withColumnRenamed("bucket", "_in"))  # at most `buckets` rows
    return df.withColumn("_in", bucket).join(few, "_in", "left_semi").select(df.columns)


def count_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], without: Sequence[str] = (), buckets: int = 1024, dealt: bool = False) -> DataFrame:
    """One row (left_only, right_only): how many rows of `diff_both_ways` each side has, duplicates counted.

    In buckets that differ two 64-bit hashes of each row meet, and no row itself; of sides that are `dealt` alike by keys (as two
    views of one table that `folder.cut` wrote by them are) not even these are exchanged."""
    none = F.lit(0).cast("long")
    differ = cut(differing_buckets(left, right, keys, without, buckets))
    if differ.isEmpty():
        return left.sparkSession.range(1).select(none.alias("left_only"), none.alias("right_only"))
    columns = [c for c in left.columns if c not in without]
    of_key = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)] if dealt else []
    hashed = lambda df, n: _in_buckets(df, keys, differ, buckets).select(*of_key, *_hashes(columns), F.lit(n).alias("_n"))
    net = hashed(left, 1).unionByName(hashed(right, -1)).groupBy(*[f"_k{i}" for i in range(len(of_key))], "a", "b").agg(F.sum("_n").alias("_n"))
    of = lambda n: F.coalesce(F.sum(F.greatest(n, none)), none)
    return net.agg(of(F.col("_n")).alias("left_only"), of(-F.col("_n")).alias("right_only"))


def compare_report(left: dict[str, DataFrame], right: dict[str, DataFrame], keys: dict[str, Sequence[str]], without: dict[str, Sequence[str]] | None = None, buckets: int = 1024, dealt: bool = False) -> DataFrame:
    """(table_name, left_rows, right_rows, left_only, right_only) of the tables of two sides, such as a replay and a live state, or two replays.

    Both sides must have the same tables. dealt: as in `count_differences`. Columns named in `without` (lineage) are left out of a table's comparison."""
    if set(left) != set(right):
        raise ValueError(f"tables differ: {sorted(set(left) ^ set(right))}")
    out = None
    for name in sorted(left):
        found = count_differences(left[name], right[name], keys[name], (without or {}).get(name, ()), buckets, dealt)
        rows = [df.agg(F.count("*").alias("n")).scalar() for df in (left[name], right[name])]
        part = found.select(F.lit(name).alias("table_name"), rows[0].alias("left_rows"), rows[1].alias("right_rows"), "left_only", "right_only")
        out = part if out is None else out.unionByName(part)
    return out


def lineage_differences(left: DataFrame, right: DataFrame, keys: Sequence[str], column: str = "source_run_id") -> DataFrame:
    """(left_run, right_run, n) of keys on both sides whose lineage differs."""
    a = left.select(*keys, F.col(column).alias("left_run"))
    b = right.select(*keys, F.col(column).alias("right_run"))
    return a.join(b, list(keys)).where(~F.col("left_run").eqNullSafe(F.col("right_run"))).groupBy("left_run", "right_run").agg(F.count("*").alias("n"))


def unexplained(differences: DataFrame, failed_runs: DataFrame) -> DataFrame:
    """Lineage differences whose live (right) run did not fail."""
    return differences.join(failed_runs.select(F.col("run_id").alias("right_run")), "right_run", "left_anti")


def moved_inputs(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tables whose version changed between two looks (source_table, version): a comparison over them is void."""
    b = before.select("source_table", F.col("version").alias("before_version"))
    a = after.select("source_table", F.col("version").alias("after_version"))
    return b.join(a, "source_table", "full_outer").where(~F.col("before_version").eqNullSafe(F.col("after_version")))
