import math
import zlib

import pytest
from pyspark.sql import functions as F

from obslog.llm.mixing import mix_sources, replication_counts, source_rates, uniform
from obslog.llm.sharding import HistogramSort, shard_by_bytes


def inverse(mean, u):
    k, p = 0, math.exp(-mean)
    total = p
    while total < u:
        k += 1
        p *= mean / k
        total += p
    return k


@pytest.mark.parametrize("mean", [0.0, 0.01, 1.0, 3.5, 40.0])
def test_counts_invert_the_distribution(spark, mean):
    df = spark.range(2000).select("id", uniform("id", F.lit(1), seed=3).alias("u"), replication_counts(F.lit(mean), "id", seed=3).alias("n"))
    rows = df.collect()
    assert all(r.n == (inverse(mean, r.u) if mean else 0) for r in rows)
    average = sum(r.n for r in rows) / len(rows)
    assert abs(average - mean) <= 5 * math.sqrt(max(mean, 1e-9) / len(rows)) + 1e-9


def test_large_means_are_sums(spark):
    n = [r.n for r in spark.range(500).select(replication_counts(F.lit(300.0), "id", seed=1).alias("n")).collect()]
    assert abs(sum(n) / 500 - 300) < 5 * math.sqrt(300 / 500)
    rows = spark.createDataFrame([(1, None), (2, -1.0)], "id long, m double").select(replication_counts(F.col("m"), "id", seed=1).alias("n")).collect()
    assert [r.n for r in rows] == [0, 0]


def test_rates_and_mix(spark, table):
    docs = table([(i, f"text {i}", "en", "hot" if i % 3 else None if i % 2 else "cold", 6) for i in range(3000)])
    rates = {r.source: (r.n_docs, r.rate) for r in source_rates(docs).collect()}
    assert sum(n * x for n, x in rates.values()) == pytest.approx(3000)
    assert rates["hot"][1] < 1 < rates["cold"][1] == pytest.approx(rates[None][1])
    weights = spark.createDataFrame([("cold", 3.0), ("hot", 1.0)], "source string, weight double")
    given = {r.source: r.rate * r.n_docs for r in source_rates(docs, weights=weights, total=400).collect()}
    assert given == {"cold": pytest.approx(300), "hot": pytest.approx(100), None: 0.0}
    rates_df = source_rates(docs)
    mixed = mix_sources(docs.withColumn("replica", F.lit(9)), rates_df)
    assert mixed.columns == [*docs.columns, "replica", "rate"]
    rows = mixed.collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix_sources(docs.repartition(7), rates_df).collect()))
    copies = {}
    for r in rows:
        copies.setdefault(r.doc_id, []).append(r.replica)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    want = {r.doc_id: r.n for r in docs.join(rates_df.withColumnRenamed("source", "s"), docs.source.eqNullSafe(F.col("s"))).select("doc_id", replication_counts(F.col("rate"), "doc_id", F.xxhash64("text"), seed=17).alias("n")).collect()}
    assert {d: len(c) for d, c in copies.items()} == {d: n for d, n in want.items() if n}
    assert mix_sources(docs, rates_df, mark=False).columns == docs.columns
    ids = [r.doc_id for r in rows]
    assert ids != sorted(ids)


def test_a_mix_equals_a_plain_one(table):
    """Rates and counts by hand, with only the draws' uniform numbers from Spark; nulls, repeated rows, long texts and the inner names as columns."""
    rows = [(i % 400, f"text {i % 50}", "en", ["hot", "hot", "hot", "cold", None, ""][i % 6], i) for i in range(900)]
    rows += [(None, None, None, None, None), (None, "no id", "en", "hot", 1), (5, None, "en", "cold", 0), (5, None, "en", "cold", 0), (7, "long " * 100_000, "en", "hot", 2)]
    docs = table(rows)
    for name in ("__source", "__rate", "__n", "__copy", "__place"):
        docs = docs.withColumn(name, F.lit("mine"))
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + 1
    weight = sum(math.sqrt(n) for n in sizes.values())
    rate = {s: math.sqrt(n) / weight * len(rows) / n for s, n in sizes.items()}
    drawn = docs.select("doc_id", "text", "source", uniform("doc_id", F.xxhash64("text"), F.lit(1), seed=17).alias("u")).collect()
    want = sorted(str((r.doc_id, r.source, hash(r.text))) for r in drawn for _ in range(inverse(rate[r.source], r.u)))
    mixed = mix_sources(docs, source_rates(docs), mark=False)
    assert mixed.columns == ["doc_id", "text", "lang", "source", "n_chars"] and len(want) > 500
    assert sorted(str((r.doc_id, r.source, hash(r.text))) for r in mixed.select("doc_id", "source", "text").collect()) == want


def test_mix_of_nothing(table):
    docs = table([])
    assert mix_sources(docs, source_rates(docs)).collect() == []


@pytest.fixture(scope="module")
def sized():
    rows = [(i, "x" * (i * 37 % 400) + str(i)) for i in range(900)] + [(2000 + i, "same text, " * 9) for i in range(700)]
    return rows + [(5000, ""), (5001, None), (5002, ""), (None, "null id"), (None, None), (1, "x" * 37 + "1"), (6000, "é" * 5000)]


@pytest.mark.parametrize("p", [HistogramSort(), HistogramSort(shards=5, probes=3, piece_rows=20)])
def test_shards(table, sized, p):
    out = shard_by_bytes(table(sized).withColumn("slot", F.lit("old")), p)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "size", "text_crc32", "shard", "slot"]
    rows = out.collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in rows) == sorted((str(a), str(b)) for a, b in sized)
    assert all(r["size"] == len((r.text or "").encode()) + 1 and r.text_crc32 == zlib.crc32((r.text or "").encode()) for r in rows)
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(p.shards))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / p.shards) <= largest + p.tolerance * total
    where = {}
    for r in rows:
        where.setdefault(r.text, set()).add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 1  # only the group that exceeds a shard is cut


def test_shards_are_cuts_of_one_sorted_list(table, sized):
    """Against a sort of everything: shards are runs of the order by (hash, id), cut where the bytes are nearest to even; a text of a megabyte among them."""
    rows = [*sized, (9000, "long " * 200_000)]
    p = HistogramSort(shards=6)
    docs = table(rows).withColumn("h", F.xxhash64(F.coalesce("text", F.lit(""))))
    got = sorted(((r.h, r.doc_id or 0), r.shard, r.slot, r["size"]) for r in shard_by_bytes(docs, p).collect())
    assert [g[1] for g in got] == sorted(g[1] for g in got)
    keys, sizes = [g[0] for g in got], [g[3] for g in got]
    below = [0]
    for x in sizes:
        below.append(below[-1] + x)
    for shard in range(p.shards):
        mine = [i for i, g in enumerate(got) if g[1] == shard]
        assert sorted(got[i][2] for i in mine) == list(range(len(mine)))
        for i in mine:  # slots follow the order, but for rows equal in it
            same = [j for j in mine if keys[j] == keys[i]]
            assert same[0] - mine[0] <= got[i][2] <= same[-1] - mine[0]
    cuts = [0, *[i for i in range(len(keys) + 1) if 0 < i < len(keys) and keys[i] != keys[i - 1]], len(keys)]
    for shard in range(1, p.shards):
        target = below[-1] * shard / p.shards
        first = next((i for i, g in enumerate(got) if g[1] >= shard), len(got))
        best = min(abs(below[c] - target) for c in cuts)
        assert abs(below[first] - target) <= max(best, p.tolerance * below[-1] / p.shards) + 1e-6


def test_few_or_no_rows(table):
    assert shard_by_bytes(table([])).collect() == []
    rows = shard_by_bytes(table([(1, "a"), (2, "b")])).collect()
    assert sorted(r.slot for r in rows) in ([0, 0], [0, 1])
