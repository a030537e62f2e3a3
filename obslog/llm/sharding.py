"""Shards of near-equal bytes by histogram sort: exact counts below probes, refined until splitters fit, one exchange."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslog.llm.common import cut, without


@dataclass(frozen=True)
class HistogramSort:
    """Parameters. A splitter is settled once the bytes below it are within `tolerance` of a
    shard's share, or no key lies between it and its neighbours. `probes` is how many new boundaries each open
    splitter tries a round. A shard moves in pieces of about `piece_rows` rows, but in no more than
    `pieces` unless they would exceed `most_rows`."""

    shards: int = 8
    tolerance: float = 0.0005
    probes: int = 32
    pieces: int = 64
    piece_rows: int = 2000
    most_rows: int = 1_000_000
    max_rounds: int = 256


_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def _below(probes: list[tuple[int, int]]):
    """Rows and bytes between consecutive probes, summed in each task: cell i holds the keys k with probes[i-1] <= k < probes[i]."""

    def run(batches):
        n, size = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            cell = cells(batch.column(0).to_numpy(), batch.column(1).to_numpy(), probes)
            n += np.bincount(cell, minlength=len(n))
            np.add.at(size, cell, batch.column(2).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)), pa.int32()), pa.array(n), pa.array(size)], ["cell", "n", "bytes"])

    return run


def cells(first: np.ndarray, second: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """How many of the sorted probes are not above each key (first, second)."""
    at, inverse = np.unique(np.array([a for a, _ in probes], np.int64), return_inverse=True)
    out = np.searchsorted(np.array([a for a, _ in probes], np.int64), first, "left")
    same = np.searchsorted(at, first)
    hit = np.flatnonzero((same < len(at)) & (at[np.minimum(same, len(at) - 1)] == first)) if len(at) else np.zeros(0, np.int64)
    if len(hit):
        for g in np.unique(same[hit]):
            rows = hit[same[hit] == g]
            second_probes = np.array([b for (_, b), i in zip(probes, inverse, strict=True) if i == g], np.int64)
            out[rows] += np.searchsorted(second_probes, second[rows], "right")
    return out


def _between(lo: tuple[int, int], hi: tuple[int, int], n: int) -> list[tuple[int, int]]:
    """Up to n keys spread over the open interval of two keys: over the first part, or over the second where the first is settled."""
    if hi[0] - lo[0] > 1:
        k = min(n, hi[0] - lo[0] - 1)
        return [(lo[0] + (hi[0] - lo[0]) * i // (k + 1), _LOW) for i in range(1, k + 1)] + [(hi[0], _LOW)] * (hi[1] > _LOW)
    if hi[0] > lo[0]:
        if hi[1] > _LOW:
            return [(hi[0], _LOW)]
        hi = (lo[0], _HIGH)
    k = min(n, max(0, hi[1] - lo[1] - 1))
    return [(lo[0], lo[1] + (hi[1] - lo[1]) * i // (k + 1)) for i in range(1, k + 1)]


def splitters(keyed: DataFrame, targets: list[float], p: HistogramSort, slack: float) -> list[tuple[tuple[int, int], int, int]]:
    """(key, rows below it, bytes below it) for each target number of bytes, by repeated exact histograms.

    keyed: long columns first, second, bytes. The driver holds, each round, a few counts
    for each open target; the keys themselves stay where they are."""
    total = keyed.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    known = {(_LOW, _LOW): (0, 0), (_HIGH, _HIGH): tuple(total)}
    for _ in range(p.max_rounds):
        probes: set[tuple[int, int]] = set()
        order = sorted(known)
        sizes = [known[k][1] for k in order]
        for t in targets:
            i = min(max(1, int(np.searchsorted(sizes, t, "right"))), len(order) - 1)
            if min(abs(sizes[i] - t), abs(sizes[i - 1] - t)) > slack:
                probes.update(k for k in _between(order[i - 1], order[i], p.probes) if k not in known)
        if not probes:
            break
        asked = sorted(probes)
        rows = keyed.mapInArrow(_below(asked), "cell int, n long, bytes long").groupBy("cell").agg(F.sum("n"), F.sum("bytes")).collect()
        n, size = np.zeros(len(asked) + 1, np.int64), np.zeros(len(asked) + 1, np.int64)
        for cell, a, b in rows:
            n[cell], size[cell] = a, b
        n, size = np.cumsum(n), np.cumsum(size)
        known.update({k: (int(n[i]), int(size[i])) for i, k in enumerate(asked)})
    else:
        raise RuntimeError(f"splitters are still apart from their targets after {p.max_rounds} rounds")
    order = sorted(known)
    sizes = np.array([known[k][1] for k in order])
    out = [order[int(np.argmin(np.abs(sizes - t)))] for t in targets]
    return [(k, *known[k]) for k in sorted(out)]


def shard_by_bytes(docs: DataFrame, p: HistogramSort = HistogramSort(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with size, text_crc32, shard and slot, which replace columns of these names.

    size is the text's UTF-8 bytes (null: none) plus 1; the shards' sums of sizes are equal
    within the tolerance, or as near as whole rows allow. The sort key is the text's hash,
    then the id: equal texts lie together, in one shard unless a splitter must cut a group
    too large for the balance. Histograms run on (hash, id, size), kept as a small table.
    Splitters cut the key range into shards and each shard into pieces; the rows with all
    columns then move once, each to its piece, and slot counts a piece's rows on from the
    exact number of rows below it. A null id takes a place in its text's group by a hash of
    nothing; rows equal in key share a piece and take slots in any order. A null text has the
    size 1. A long text is one row of its shard, however far that takes it over its share. No
    rows give none; fewer rows than shards leave shards empty."""
    names = ("size", "text_crc32", "shard", "slot", "__first", "__second", "__piece")
    data = without(docs, *names)
    sized = (
        data.withColumn("size", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1)
        .withColumn("text_crc32", F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
        .withColumn("__first", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
        .withColumn("__second", F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(0)))
    )
    keyed = cut(sized.select(F.col("__first").alias("first"), F.col("__second").alias("second"), F.col("size").alias("bytes")))
    rows, total = keyed.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    per_shard = max(1, min(p.pieces, -(-rows // (p.shards * p.piece_rows))), -(-rows // (p.shards * p.most_rows)))
    share = total / p.shards
    main = splitters(keyed, [share * i for i in range(1, p.shards)], p, p.tolerance * share)
    fine = splitters(keyed, [share * (i + j / per_shard) for i in range(p.shards) for j in range(1, per_shard)], p, share / per_shard / 4) if per_shard > 1 else []
    cuts = sorted({k: n for k, n, _ in [*main, *fine]}.items())
    probes = [k for k, _ in cuts]
    bounds = [k for k, _, _ in main]
    shard_of = [0] + [sum(b <= k for b in bounds) for k in probes]
    below = [0] + [n for _, n in cuts]
    starts = [0] + [n for _, n, _ in main]
    offset = [below[i] - starts[s] for i, s in enumerate(shard_of)]

    @F.arrow_udf("int")
    def piece(first: pa.Array, second: pa.Array) -> pa.Array:
        return pa.array(cells(first.to_numpy(), second.to_numpy(), probes), pa.int32())

    out = sized.withColumn("__piece", piece("__first", "__second")).repartition(len(probes) + 1, "__piece")
    return _slotted(out, shard_of, offset).drop("__first", "__second", "__piece")


def _slotted(pieces: DataFrame, shard_of: list[int], offset: list[int]) -> DataFrame:
    pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("__piece") + 1)
    rank = F.row_number().over(Window.partitionBy("__piece").orderBy("__first", "__second"))
    return pieces.withColumn("shard", pick(shard_of).cast("int")).withColumn("slot", (pick(offset) + rank - 1).cast("long"))
