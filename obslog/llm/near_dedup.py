"""Near-duplicate documents: MinHash bands find candidates, odd sketches screen them, full sets confirm."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import cut
from obslog.llm.components import connected_components
from obslog.llm.kernels import NON_SPACE, mix, ngram_hashes, sequence_hash, slices, word_hashes, words


@dataclass(frozen=True)
class NearDedup:
    """Parameters. A pair at the threshold misses every band with probability (1 - t**rows)**bands (7e-9 here).

    `sketch_floor` is the odd-sketch estimate under which a candidate is dropped unseen; at
    160 samples and 512 bits it lies over five standard deviations below a similarity of 0.85."""

    shingle: int = 3
    threshold_percent: int = 85
    bands: int = 32
    rows: int = 5
    sketch_bits: int = 512
    sketch_floor: float = 0.55
    block: int = 140

    @property
    def samples(self) -> int:
        return self.bands * self.rows


_rng = np.random.Generator(np.random.PCG64(7))
_XOR = _rng.integers(0, 2**64, 4096, dtype=np.uint64)
_MUL = _rng.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(first row, end row, sorted distinct shingle hashes of each row) for runs of rows."""
    for lo, hi, data, offsets in slices(column):
        starts, ends, first = words(data, offsets, NON_SPACE)
        hashes = word_hashes(data, starts, ends)
        grams = ngram_hashes(hashes, n)
        out = []
        for a, b in zip(first[:-1], first[1:], strict=True):
            if b - a >= n:
                out.append(np.unique(grams[a : b - n + 1]))
            else:
                out.append(np.array([sequence_hash(hashes[a:b])], np.uint64) if b > a else np.zeros(0, np.uint64))
        yield lo, hi, out


def min_samples(items: np.ndarray, k: int) -> np.ndarray:
    """The k MinHash samples of a non-empty set."""
    out = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 512):
        part = (items[at : at + 512, None] ^ _XOR[:k]) * _MUL[:k]
        np.minimum(out, part.min(axis=0), out=out)
    return out


def odd_sketches(samples: np.ndarray, bits: int) -> np.ndarray:
    """One parity bitmap a row of samples: each sample flips one bit."""
    at = mix(samples ^ (np.arange(samples.shape[1], dtype=np.uint64) << np.uint64(40))) % np.uint64(bits)
    at = at.astype(np.int64) + np.arange(len(samples))[:, None] * bits
    odd = np.bincount(at.ravel(), minlength=len(samples) * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(len(samples), bits), axis=1)


def sketch_similarity(differing, samples: int, bits: int):
    """Jaccard estimate from the number of differing bits of two odd sketches."""
    share = np.minimum(2 * differing / bits, 1 - 1e-9)
    return 1 + bits / (4 * samples) * np.log1p(-share)


def _most_differing(p: NearDedup) -> int:
    z = np.arange(p.sketch_bits // 2)
    return int(z[sketch_similarity(z, p.samples, p.sketch_bits) >= p.sketch_floor].max())


def _features(p: NearDedup):
    def run(batches):
        for batch in batches:
            for lo, hi, sets in shingle_sets(batch.column(1), p.shingle):
                sizes = np.array([len(s) for s in sets])
                full = np.flatnonzero(sizes)
                samples = np.array([min_samples(sets[i], p.samples) for i in full], np.uint64).reshape(len(full), p.samples)
                bands = np.empty((len(full), p.bands), np.uint64)
                for b in range(p.bands):
                    bands[:, b] = ngram_hashes_rows(samples[:, b * p.rows : (b + 1) * p.rows], b)
                digests = np.zeros((len(sets), 2), np.uint64)
                for i in full:
                    digests[i] = mix(sets[i]).sum(), mix(sets[i] ^ _XOR[4095]).sum()
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, p.bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests[:, 0].view(np.int64)),
                        pa.array(digests[:, 1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands.ravel().view(np.int64))),
                    ],
                    ["doc_id", "n_shingles", "digest1", "digest2", "bands"],
                )

    return run


def ngram_hashes_rows(rows: np.ndarray, salt: int) -> np.ndarray:
    """One hash for each row of a matrix."""
    out = np.full(len(rows), salt + 1, np.uint64)
    for c in range(rows.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, c])
    return out


def _sets(p: NearDedup):
    def run(batches):
        for batch in batches:
            for lo, hi, sets in shingle_sets(batch.column(1), p.shingle):
                full = [s for s in sets if len(s)]
                samples = np.array([min_samples(s, p.samples) for s in full], np.uint64).reshape(len(full), p.samples)
                sketches = iter(odd_sketches(samples, p.sketch_bits))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array([s.tobytes() for s in sets], pa.binary()), pa.array([next(sketches).tobytes() if len(s) else b"" for s in sets], pa.binary())],
                    ["doc_id", "items", "sketch"],
                )

    return run


def links_of_block(ids: np.ndarray, sets: list[np.ndarray], sketches: np.ndarray, first: np.ndarray, p: NearDedup, of: np.ndarray | None = None, only_first: bool = False) -> list[tuple[int, int]]:
    """Links that join the block's documents into the components that all its links would.

    The rows `first` are compared with all others that are not yet in their component, which
    `of` numbers at the start; then, unless `only_first`, so are the other rows. A pair is
    measured on the full sets unless the sizes alone or the odd sketches rule it out."""
    t, n = p.threshold_percent, len(ids)
    sizes = np.array([len(s) for s in sets])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.concatenate(sets)
    of = np.arange(n) if of is None else of.copy()
    out = []
    limit = _most_differing(p)
    rest_of = [] if only_first else np.setdiff1d(np.arange(n), first)
    for a in [*first, *rest_of]:
        rest = np.flatnonzero((of != of[a]) & (100 * np.minimum(sizes, sizes[a]) >= t * np.maximum(sizes, sizes[a])))
        if len(rest):
            rest = rest[np.bitwise_count(sketches[rest] ^ sketches[a]).sum(axis=1) <= limit]
        if not len(rest):
            continue
        if len(rest) * 4 < n:
            common = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for b in rest])
        else:
            at = np.minimum(np.searchsorted(sets[a], flat), len(sets[a]) - 1)
            common = np.add.reduceat((sets[a][at] == flat).astype(np.int64), bounds[:-1])[rest]
        for b in rest[100 * common >= t * (sizes[rest] + sizes[a] - common)]:
            if of[b] != of[a]:
                out.append((ids[a], ids[b]))
                of[of == of[b]] = of[a]
    return out


def _of_blocks(keys: int, links):
    """Rows in the order of their first `keys` columns, which name a block, to the links of each block of two rows or more."""

    def told(found):
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    def run(batches):
        held, key = [], None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            out = []
            for row in zip(*columns, strict=True):
                if row[:keys] != key:
                    if len(held) > 1:
                        out += links(held)
                    held, key = [], row[:keys]
                held.append(row)
            yield told(out)
        if len(held) > 1:
            yield told(links(held))

    return run


def _arrays(rows) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Ids, sets and sketches of rows that end with them."""
    return np.array([r[-3] for r in rows]), [np.frombuffer(r[-2], np.uint64) for r in rows], np.frombuffer(b"".join(r[-1] for r in rows), np.uint64).reshape(len(rows), -1)


def _led(p: NearDedup):
    """Links of blocks (leader, chunk): of the leader, and of pairs of the chunk that are then still apart."""

    def links(rows):
        ids, sets, sketches = _arrays(rows)
        return links_of_block(ids, sets, sketches, np.flatnonzero(ids == rows[0][0])[:1], p)

    return _of_blocks(2, links)


def _across(p: NearDedup):
    """Links of blocks (leader, chunk of members that are apart from most, chunk of all): of the former with the latter."""

    def links(rows):
        ids, sets, sketches = _arrays(rows)
        of = np.unique(np.array([r[4] for r in rows]), return_inverse=True)[1]
        return links_of_block(ids, sets, sketches, np.flatnonzero([r[3] for r in rows]), p, of, only_first=True)

    return _of_blocks(3, links)


def _apart(clusters: DataFrame, chunks: DataFrame, found: DataFrame, p: NearDedup) -> DataFrame | None:
    """Blocks (leader, i, j, apart, of, doc_id) of the pairs of clusters of several chunks that are in different components.

    Of each cluster, members outside its largest component meet all members; the others
    needn't meet one another. None if there are no such members."""
    joined = clusters.join(chunks, "leader").join(found.hint("merge"), F.col("doc_id") == F.col("node"), "left")
    placed = cut(joined.select("leader", "doc_id", "chunks", F.coalesce("component", "doc_id").alias("of")))
    parts = cut(placed.groupBy("leader", "of").agg(F.count("*").alias("n")))
    largest = parts.groupBy("leader").agg(F.max(F.struct("n", (-F.col("of")).alias("minus"))).alias("best"), F.sum("n").alias("all"))
    largest = cut(largest.where("all > best.n").select("leader", (-F.col("best.minus")).alias("main"), F.ceil((F.col("all") - F.col("best.n")) / F.lit(p.block)).cast("int").alias("minors")))
    if largest.isEmpty():
        return None
    rows = placed.join(largest, "leader").withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
    mine = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.col("minors")).cast("int")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    few = rows.where("of <> main").select("leader", mine.alias("i"), numbers(F.col("chunks")).alias("j"), F.lit(True).alias("apart"), "of", "doc_id")
    many = rows.select("leader", numbers(F.col("minors")).alias("i"), F.col("own").alias("j"), F.lit(False).alias("apart"), "of", "doc_id")
    return few.union(many)


def near_duplicates(docs: DataFrame, p: NearDedup = NearDedup(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable over links), kept.

    Documents with equal shingle sets form one class, which its smallest id stands for from
    then on. The 5-row bands of its MinHash samples put a class in buckets; each bucket
    names as leader its member with the most companions over all buckets, and a leader's
    cluster is the union of the buckets it leads, so that any two classes that share a
    bucket share a cluster. A cluster's members are dealt into chunks of about `block`, each
    of which also gets the leader: most members of a group of near copies link with it or in
    their chunk, by work in proportion to the group. Then components are taken, and of
    clusters of several chunks those members that are not in the largest component are
    compared, chunk by chunk, with all members of other components. No task holds more than
    two chunks, whatever the cluster's size, and a block returns at most as many links as it
    has members.

    A null or wordless text has an empty set and links with nothing. A null id is never
    linked; its component is null and it is kept. Rows that share an id are one node: they
    are linked through it. An empty table gives no rows. Other columns are not read."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    feats = cut(docs.mapInArrow(_features(p), "doc_id long, n_shingles long, digest1 long, digest2 long, bands array<long>"))
    filled = feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
    digest = ["digest1", "digest2", "n_shingles"]
    classes = filled.groupBy(*digest).agg(F.min("doc_id").alias("stands"))
    stands = filled.join(classes.select(F.col("stands").alias("doc_id")), "doc_id", "left_semi")
    entries = stands.select("doc_id", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    shared = cut(entries.join(buckets, "bucket"))
    central = shared.groupBy("doc_id").agg(F.sum("members").alias("companions"))
    leaders = shared.join(central, "doc_id").groupBy("bucket").agg(F.max(F.struct("companions", (-F.col("doc_id")).alias("minus"))).alias("best"))
    clusters = cut(shared.join(leaders.select("bucket", (-F.col("best.minus")).alias("leader")), "bucket").select("leader", "doc_id").distinct())
    sizes = clusters.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(p.block)).cast("int").alias("chunks"))
    chunks = cut(sizes.where("chunks > 1"))  # a table, so that Spark can split the large clusters in the join
    own = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    wanted = clusters.select("doc_id").distinct().hint("merge")  # grows with the documents: never a broadcast
    sets = docs.join(wanted, "doc_id", "left_semi").mapInArrow(_sets(p), "doc_id long, items binary, sketch binary")

    def compared(dealt: DataFrame, keys: list[str], order: list[str], links) -> DataFrame:
        rows = dealt.join(sets, "doc_id").select(*keys, *order, "doc_id", "items", "sketch")
        return rows.repartition(*keys).sortWithinPartitions(*keys, *order, "doc_id").mapInArrow(links, "a long, b long")

    dealt = (
        clusters.join(chunks, "leader", "left")
        .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        .withColumn("i", F.explode(F.when(F.col("doc_id") == F.col("leader"), F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(own))))
        .select("leader", "i", (F.col("doc_id") != F.col("leader")).alias("late"), "doc_id")
    )
    found = connected_components(compared(dealt, ["leader", "i"], ["late"], _led(p)), "a", "b")
    blocks = None if chunks.isEmpty() else _apart(clusters, chunks, found, p)
    if blocks is not None:
        more = compared(blocks, ["leader", "i", "j"], ["apart", "of"], _across(p))
        found = connected_components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), "a", "b")
    result = (
        feats.select("doc_id", *digest)
        .join(classes.join(found, classes.stands == found.node, "left").select(*digest, F.coalesce("component", "stands").alias("of")), digest, "left")
        .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("of")).alias("of"))
        .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("of", "doc_id")).alias("component_id"))
    )
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, p: NearDedup = NearDedup()) -> DataFrame:
    """`docs` without the documents that another of their component stands for; all columns stay."""
    verdicts = near_duplicates(docs, p)
    return docs.join(verdicts.where("NOT kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
