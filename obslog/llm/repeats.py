"""Removal of repeated byte strings by longest previous factors in suffix order.

A string of `length` bytes that starts earlier in the corpus too is repeated: at its start
the longest previous factor (LPF) is at least `length`. The LPF of a suffix is the longer
of its common prefixes with two neighbours in suffix order: the nearest one before it and
the nearest one after it that start earlier (previous and next smaller positions).

A corpus-wide suffix array in one place is out of the question, so suffixes meet in buckets:

1. Each window of `length` bytes has one anchor, its least k-gram hash (the leftmost of
   equal ones). Anchor and offset depend on the window's bytes alone, so that equal windows
   have equal anchors, and the suffixes that start at them belong to one bucket.
2. The context of an anchor is all that its windows cover. Of identical contexts only the
   first can start something new; all others are repeats entirely, and only the first
   one's suffixes enter the suffix order.
3. A bucket with different contexts gets its suffixes sorted, their common prefixes taken
   and the LPF of each worked out. A bucket that doesn't fit is refined first: its contexts
   are cut where the windows' offset to the anchor passes a multiple of a width, and the
   pieces meet by the bytes that all windows of a piece share. Copies that differ elsewhere
   then become identical pieces, of which again only the first goes on, and a piece that
   meets no other is done. Widths fall from round to round, so that few pieces are left for
   the narrower ones, and at a width of 1 all that meet are identical: no bucket stays too
   large, whatever the copies in it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import cut
from obslog.llm.kernels import Hashes, mix, slices


@dataclass(frozen=True)
class Repeats:
    """Parameters. `local_contexts` (2 or more): of one anchor's contexts in a slice of documents, so
    many go to the anchor's bucket to be counted, which tells that it has several; the rest, and
    that anchor's contexts in later slices of the task, are known to need the suffix order and
    bypass it. A bucket of over `bucket_rows` contexts is refined, by each of `widths` in turn.
    A task of the exchanges gets what comes of about `task_bytes` of text, or one bucket."""

    length: int = 100
    gram: int = 32
    local_contexts: int = 8
    bucket_rows: int = 2000
    widths: tuple[int, ...] = (16, 4, 1)
    chunk_windows: int = 150_000
    task_bytes: int = 32 << 20

    def __post_init__(self):
        if self.local_contexts < 2 or not 0 < self.gram <= self.length <= 128 or self.widths[-1:] != (1,):
            raise ValueError("local_contexts must be 2 or more, gram at most length, length at most 128, and the last width 1")


_PLACE = np.uint64((1 << 31) - 1)  # Spark's texts are shorter
_ANCHOR, _REPEATED, _SORT = 0, 1, 2


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of x[i : i + width] at i, by doubling."""
    out, have = x, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(data: np.ndarray, offsets: np.ndarray, p: Repeats):
    """For each run of windows with one anchor: row, anchor place, first and last window start
    (all in the slice), context bounds, anchor hash and context hash."""
    n, length, k = len(data), p.length, p.gram
    if n < length:
        return [np.zeros(0, np.int64)] * 6 + [np.zeros(0, np.uint64)] * 2
    hashes = Hashes(data)
    at = np.arange(n - k + 1)
    gram = mix(hashes.raw(at, at + k))
    least = sliding_minimum((gram & ~_PLACE) | at.astype(np.uint64), length - k + 1) & _PLACE
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = np.flatnonzero(np.arange(n - length + 1) + length <= offsets[row[: n - length + 1] + 1])
    place = least[start].astype(np.int64)
    new = np.ones(len(start), bool)
    new[1:] = (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(start))[: len(head)] - 1
    place, s, e = place[head], start[head], start[last] if len(head) else start[:0]
    row = row[place]
    lo = np.maximum(offsets[row], place + k - length)
    hi = np.minimum(offsets[row + 1], place + length)
    context = mix(hashes.raw(lo, hi) + ((place - lo) * 1024 + (hi - lo)).astype(np.uint64))
    return row, place, s, e, lo, hi, gram[place], context


def _ranks(doc, twin):
    """A number for each row that orders rows as (doc, twin) does. twin tells texts of one id apart and is 0 where none has two."""
    if not twin.any():
        return doc
    order = np.lexsort((twin, doc))
    new = np.ones(len(order), np.int64)
    new[1:] = (doc[order][1:] != doc[order][:-1]) | (twin[order][1:] != twin[order][:-1])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new)
    return out


def _first_of(key1, key2, doc, twin, place):
    """Order by (key1, key2, doc, twin, place), and in that order: a new key1, a new (key1, key2), and whether the row is as early as the first of its group."""
    who = _ranks(doc, twin)
    order = np.lexsort((place, who, key2, key1))
    a, b, d, x = key1[order], key2[order], who[order], place[order]
    new1 = np.ones(len(order), bool)
    new1[1:] = a[1:] != a[:-1]
    new2 = new1.copy()
    new2[1:] |= b[1:] != b[:-1]
    head = np.maximum.accumulate(np.where(new2, np.arange(len(order)), 0))
    first = (d == d[head]) & (x == x[head])
    return order, new1, new2, first


def _merged(doc, twin, s, e):
    """Runs of window starts of one document that touch, joined."""
    who = _ranks(doc, twin)
    order = np.lexsort((s, who))
    doc, twin, who, s, e = doc[order], twin[order], who[order], s[order], e[order]
    if not len(doc):
        return doc, twin, s, e
    new = np.ones(len(doc), bool)
    new[1:] = who[1:] != who[:-1]
    base = np.cumsum(new) << 32  # keeps documents apart in one running maximum
    new[1:] |= (s + base)[1:] > np.maximum.accumulate(e + base)[:-1] + 1
    head = np.flatnonzero(new)
    return doc[head], twin[head], s[head], np.maximum.reduceat(e, head)


def _spread(doc, place):
    """Any number, for rows that may go to any task."""
    return mix((doc * 1_000_003 + place).view(np.uint64)).view(np.int64)


def _collect(p: Repeats):
    """Documents to rows (bucket, context, doc, twin, packed). packed: kind, anchor place, and how far before it the first and last window start.

    A repeated run has its last window start in `context`; a context that bypasses its bucket
    has its anchor's hash there. Both are spread over all tasks by their place."""

    def run(batches):
        crowded = np.zeros(0, np.uint64)  # anchors that this task has sent enough contexts of
        for batch in batches:
            ids, twins = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for lo, hi, data, offsets in slices(batch.column(2)):
                row, place, s, e, _, _, anchor, context = anchors(data, offsets, p)
                doc, twin = ids[lo:hi][row], twins[lo:hi][row]
                place, s, e = place - offsets[row], s - offsets[row], e - offsets[row]
                order, new1, new2, first = _first_of(anchor, context, doc, twin, place)
                distinct = new2 & first
                rank = np.cumsum(distinct)
                rank = rank - np.maximum.accumulate(np.where(new1, rank - distinct, 0))
                place, s, e, doc, twin, anchor, context = (x[order] for x in (place, s, e, doc, twin, anchor, context))
                bypass = (rank > p.local_contexts) | np.isin(anchor, crowded)
                crowded = np.unique(np.concatenate([crowded, anchor[rank > p.local_contexts]]))[: 1 << 16]
                kind = np.where(first, np.where(bypass, _SORT, _ANCHOR), _REPEATED)
                live = kind != _REPEATED
                packed = (kind << 60) | (place << 16) | ((place - s) << 8) | (place - e)
                d, t, a, b = _merged(doc[~live], twin[~live], s[~live], e[~live])
                sort = kind == _SORT
                bucket = np.where(sort, _spread(doc, place), anchor.view(np.int64))
                context = np.where(sort, anchor.view(np.int64), context.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([bucket[live], _spread(d, a)])),
                        pa.array(np.concatenate([context[live], b])),
                        pa.array(np.concatenate([doc[live], d])),
                        pa.array(np.concatenate([twin[live], t])),
                        pa.array(np.concatenate([packed[live], (np.int64(_REPEATED) << 60) | (a << 16)])),
                    ],
                    ["bucket", "context", "doc", "twin", "packed"],
                )

    return run


def _resolve(p: Repeats):
    """The rows of whole buckets to marks (doc, twin, kind, bucket, place, s, e): repeated runs, and contexts whose suffixes must be sorted."""

    def run(batches):
        held = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if not held:
            return
        bucket, context, doc, twin, packed = (np.concatenate(x) for x in zip(*held, strict=True))
        kind, place = packed >> 60, (packed >> 16) & ((1 << 44) - 1)
        s, e = place - ((packed >> 8) & 255), place - (packed & 255)
        known = kind == _REPEATED
        s, e = np.where(known, place, s), np.where(known, context, e)
        out = [np.flatnonzero(known)]
        sort = [np.flatnonzero(kind == _SORT)]
        at = np.flatnonzero(kind == _ANCHOR)
        if len(at):
            order, new1, new2, first = _first_of(bucket[at], context[at], doc[at], twin[at], place[at])
            at = at[order]
            group = np.cumsum(new1) - 1
            several = (np.bincount(group, new2) > 1)[group]
            out.append(at[~first])
            sort.append(at[first & new2 & several])
        o = np.concatenate(out)
        d, t, a, b = _merged(doc[o], twin[o], s[o], e[o])
        i = np.concatenate(sort)
        bucket = np.where(kind == _SORT, context, bucket)
        zero = np.zeros(len(d), np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([d, doc[i]])),
                pa.array(np.concatenate([t, twin[i]])),
                pa.array(np.concatenate([zero + _REPEATED, np.full(len(i), _SORT)]), pa.int32()),
                pa.array(np.concatenate([zero, bucket[i]])),
                pa.array(np.concatenate([zero, place[i]])),
                pa.array(np.concatenate([a, s[i]])),
                pa.array(np.concatenate([b, e[i]])),
            ],
            ["doc", "twin", "kind", "bucket", "place", "s", "e"],
        )

    return run


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and offsets of an Arrow column of texts or binaries."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8), offsets


def _cuts(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    whole = memoryview(data)
    return pa.array([bytes(whole[i:j]) for i, j in zip(begin.tolist(), end.tolist(), strict=True)], pa.binary())


_CONTEXT = "bucket long, off long, doc long, twin long, s long, e long, windows binary"


def _contexts(p: Repeats):
    """(doc, twin, text, marks) to contexts: bucket, how far before the anchor the first window starts, and the bytes from the first window's start to the last one's end."""

    def run(batches):
        for batch in batches:
            doc, twin, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            data, offsets = _bytes_of(batch.column(2))
            n = np.diff(marks.offsets.to_numpy())
            flat = marks.flatten()
            bucket, place, s, e = (flat.field(i).to_numpy() for i in range(4))
            begin = np.repeat(offsets[:-1], n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(place - s), pa.array(np.repeat(doc, n)), pa.array(np.repeat(twin, n)), pa.array(s), pa.array(e), _cuts(data, begin + s, begin + e + p.length)],
                ["bucket", "off", "doc", "twin", "s", "e", "windows"],
            )

    return run


def longest_previous_factors(position: np.ndarray, lcp: np.ndarray, enough: int) -> np.ndarray:
    """LPF of the suffixes in suffix order, where it is at least `enough`; else something less.

    position: where each suffix starts in the corpus. lcp[r]: common prefix of suffixes r-1
    and r (lcp[0] = 0). Each suffix walks over suffixes that start no earlier, by their own
    walks, to its previous and its next smaller position; it gives up once the common
    prefix falls under `enough`."""
    n = len(position)

    def nearest(forward: bool) -> np.ndarray:
        link = np.arange(n) + (1 if forward else -1)
        common = np.append(lcp[1:], 0) if forward else lcp.copy()
        open_ = np.flatnonzero(common >= enough)
        while len(open_):
            open_ = open_[position[link[open_]] >= position[open_]]
            via = link[open_]
            common[open_] = np.minimum(common[open_], common[via])
            link[open_] = link[via]
            open_ = open_[common[open_] >= enough]
        return common

    return np.maximum(nearest(False), nearest(True))


def repeated_windows(key: np.ndarray, who: np.ndarray, start: np.ndarray, flat: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether the `length` bytes at flat[at] also start earlier, among windows of equal key."""
    wide = -(-length // 8) * 8
    padded = np.concatenate([flat, np.zeros(wide, np.uint8)])
    rows = np.lib.stride_tricks.sliding_window_view(padded, wide)[at].copy()
    rows[:, length:] = 0
    text = rows.view(">u8").astype(np.uint64)
    order = np.lexsort((start, who, *text.T[::-1], key))
    rows, k, d, x = rows[order], key[order], who[order], start[order]
    differ = rows[1:, :length] != rows[:-1, :length]
    lcp = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    lcp = np.concatenate([[0], np.where(k[1:] == k[:-1], lcp, 0)])
    by_place = np.lexsort((x, d))
    new = np.ones(len(by_place), np.int64)
    new[1:] = (d[by_place][1:] != d[by_place][:-1]) | (x[by_place][1:] != x[by_place][:-1])
    position = np.empty(len(order), np.int64)
    position[by_place] = np.cumsum(new)
    out = np.empty(len(order), bool)
    out[order] = longest_previous_factors(position, lcp, length) >= length
    return out


def _steps(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For runs of n elements: each element's run, and its number in it."""
    of = np.repeat(np.arange(len(n)), n)
    return of, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)


def _pieces(p: Repeats, width: int):
    """Contexts of large buckets to their pieces of at most `width` windows, in the buckets of what a piece's windows share.

    ident names a piece by its bytes and offsets. Of identical pieces of a batch only the
    first goes on with its bytes; the others are repeated runs."""

    def run(batches):
        for batch in batches:
            bucket, off, doc, twin, s, e = (batch.column(i).to_numpy() for i in range(6))
            data, offsets = _bytes_of(batch.column(6))
            if not len(bucket):
                continue
            of, step = _steps(e - s + 1)
            part = (off[of] - step) // width
            head = np.flatnonzero((step == 0) | np.concatenate([[True], part[1:] != part[:-1]]))
            last = np.append(head[1:], len(of)) - 1
            of, part, a, b = of[head], part[head], step[head], step[last]
            base = offsets[of]
            begin, end = base + a, base + b + p.length
            core = base + off[of] - part * width
            hashes = Hashes(data)
            shared = hashes.of(core, core - width + 1 + p.length)
            key = mix(mix(bucket[of].view(np.uint64)) + shared + part.astype(np.uint64)).view(np.int64)
            ident = mix(hashes.of(begin, end) + ((off[of] - a) * 256).astype(np.uint64)).view(np.int64)
            doc, twin, a, b, off = doc[of], twin[of], s[of] + a, s[of] + b, off[of] - a
            order, _, _, first = _first_of(key, ident, doc, twin, a)
            i, again = order[first], order[~first]
            d, t, x, y = _merged(doc[again], twin[again], a[again], b[again])
            zero = np.zeros(len(d), np.int64)
            both = lambda repeated, piece: pa.array(np.concatenate([repeated, piece]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([zero + _REPEATED, np.full(len(i), _SORT)]), pa.int32()),
                    both(zero, ident[i]),
                    both(zero, key[i]),
                    both(zero, off[i]),
                    both(d, doc[i]),
                    both(t, twin[i]),
                    both(x, a[i]),
                    both(y, b[i]),
                    pa.concat_arrays([pa.nulls(len(d), pa.binary()), _cuts(data, begin[i], end[i])]),
                ],
                ["kind", "ident", "bucket", "off", "doc", "twin", "s", "e", "windows"],
            )

    return run


def _sorted_buckets(p: Repeats):
    """The contexts of whole buckets to repeated runs (doc, twin, s, e), a bounded number of suffixes at a time."""

    def run(batches):
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        bucket, doc, twin, s, e = (table.column(i).to_numpy() for i in (0, 2, 3, 4, 5))
        data, offsets = _bytes_of(table.column(6).chunk(0))
        who = _ranks(doc, twin)
        order = np.argsort(bucket, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = bucket[order][1:] != bucket[order][:-1]
        key_of = np.cumsum(new) - 1
        windows = np.cumsum((e - s + 1)[order])
        ends = np.append(np.flatnonzero(new)[1:], len(order))
        a = 0
        while a < len(order):
            limit = (windows[a - 1] if a else 0) + p.chunk_windows
            fits = ends[(ends > a) & (windows[ends - 1] <= limit)]
            b = fits[-1] if len(fits) else ends[ends > a][0]
            rows = order[a:b]
            of, step = _steps((e - s + 1)[rows])
            start = s[rows][of] + step
            found = repeated_windows(key_of[a:b][of], who[rows][of], start, data, offsets[rows][of] + step, p.length)
            runs = _merged(doc[rows][of][found], twin[rows][of][found], start[found], start[found])
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in runs], ["doc", "twin", "s", "e"])
            a = b

    return run


def _kept(p: Repeats):
    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            kept, removed, size, spans = [], [], [], []
            for text, runs in zip(texts, batch.column(2), strict=True):
                data = text.as_py() or b""
                size.append(len(data))
                if runs.is_valid and len(runs):
                    flat = runs.values
                    edge = np.zeros(len(data) + 1, np.int32)
                    np.add.at(edge, flat.field(0).to_numpy(), 1)
                    np.add.at(edge, flat.field(1).to_numpy() + p.length, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                    spans.append([{"start": int(i), "end": int(j)} for i, j in zip(turns[::2], turns[1::2], strict=True)])
                    removed.append(int(gone.sum()))
                    kept.append(np.frombuffer(data, np.uint8)[~gone].tobytes())
                else:
                    spans.append([])
                    removed.append(0)
                    kept.append(data)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )

    return run


_RUN = ["doc", "twin", "s", "e"]
#: Large buckets of at most this number are broadcast.
BROADCAST_BUCKETS = 100_000


def _fitting(contexts: DataFrame, p: Repeats) -> tuple[list[DataFrame], list[DataFrame]]:
    """Contexts whose buckets fit, and runs found repeated, of contexts whose buckets may not fit."""
    columns = contexts.columns
    fit, runs = [], []
    for width in p.widths:
        sizes = contexts.groupBy("bucket").agg(F.count("*").alias("n"))
        large = cut(sizes.where(F.col("n") > p.bucket_rows).select("bucket"))
        n = large.count()
        if not n:
            return [*fit, contexts], runs
        large = F.broadcast(large) if n <= BROADCAST_BUCKETS else large.hint("merge")
        fit.append(contexts.join(large, "bucket", "left_anti").select(*columns))
        pieces = cut(contexts.join(large, "bucket", "left_semi").select(*columns).mapInArrow(_pieces(p, width), f"kind int, ident long, {_CONTEXT}"))
        runs.append(pieces.where(F.col("kind") == _REPEATED).select(*_RUN))
        pieces = pieces.where(F.col("kind") == _SORT).drop("kind")
        place = F.struct("doc", "twin", "s")
        # tables of their own, so that Spark can split what meets a piece or a bucket that very many share
        firsts = cut(pieces.groupBy("bucket", "ident").agg(F.min(place).alias("first")))
        several = cut(firsts.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket"))
        judged = cut(pieces.join(firsts, ["bucket", "ident"]).withColumn("again", place != F.col("first")).drop("first"))
        runs.append(judged.where("again").select(*_RUN))
        contexts = judged.where("NOT again").join(several, "bucket", "left_semi").select(*columns)
    return fit, runs


def remove_repeats(docs: DataFrame, p: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, spans (array of start, end: maximal removed runs of bytes), kept (binary).

    Bytes go that lie in a string of `length` bytes which also starts earlier: in a document
    of smaller id, or earlier in the same one. Strings are judged on the input and never
    cross documents; texts are UTF-8 bytes, a null is empty, and what is kept may begin
    inside a character. A null id comes before all others. Rows that repeat id and text count
    as one document and get the same answer; different texts of one id, or of null ids, are
    documents of their own, in the order of a hash of the text. An empty table gives no rows;
    other columns are not read.

    Texts are moved twice: to the contexts that must be sorted, and to their removed runs."""
    spark = docs.sparkSession
    least = -(1 << 63)
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hashed = docs.select("doc", F.xxhash64("text").alias("h"), F.octet_length("text").alias("n"))
    per_id = hashed.groupBy("doc").agg(F.min("h").alias("a"), F.max("h").alias("b"), F.sum("n").alias("n"))
    clash, size = per_id.agg(F.coalesce(F.bool_or(F.col("a") != F.col("b")), F.lit(False)), F.coalesce(F.sum("n"), F.lit(0))).first()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // p.task_bytes))
    docs = docs.select("doc", (F.xxhash64("text") if clash else F.lit(0).cast("long")).alias("twin"), "text")
    rows = docs.mapInArrow(_collect(p), "bucket long, context long, doc long, twin long, packed long")
    marks = cut(rows.repartition(tasks, "bucket").mapInArrow(_resolve(p), "doc long, twin long, kind int, bucket long, place long, s long, e long"))
    to_sort = marks.where(F.col("kind") == _SORT).groupBy("doc", "twin").agg(F.collect_list(F.struct("bucket", "place", "s", "e")).alias("marks"))
    contexts = cut(docs.join(to_sort.hint("merge"), ["doc", "twin"]).select("doc", "twin", "text", "marks").mapInArrow(_contexts(p), _CONTEXT))
    fit, runs = _fitting(contexts, p)
    together = fit[0]
    for df in fit[1:]:
        together = together.union(df)
    sorted_ = together.repartition(tasks, "bucket").mapInArrow(_sorted_buckets(p), "doc long, twin long, s long, e long")
    found = marks.where(F.col("kind") == _REPEATED).select(*_RUN).union(sorted_)
    for df in runs:
        found = found.union(df)
    found = found.groupBy("doc", "twin").agg(F.collect_list(F.struct("s", "e")).alias("runs"))
    out = docs.join(found.hint("merge"), ["doc", "twin"], "left").select("doc", "text", "runs")
    out = out.mapInArrow(_kept(p), "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(least)))
