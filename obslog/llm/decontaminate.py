"""Benchmark decontamination: SimHash fingerprints of item-sized windows, multi-index Hamming lookup, exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslog.llm.common import cut
from obslog.llm.kernels import ALNUM, mix, ngram_hashes, sequence_hash, slices, word_hashes, words


@dataclass(frozen=True)
class Decontamination:
    """Parameters.

    A window leaks an item when the item's shingles that it holds carry `threshold` of the
    item's shingle weight. At 0.8 it may differ in the last fifth of its words, which is some 25
    of 128 fingerprint bits with a deviation of 4.5; `radius` is three deviations beyond.
    An item whose weight lies so unevenly that more of its words may differ is looked up by
    its heaviest shingles too, which loses nothing.
    `items_a_block` and `bytes_a_block` bound what reaches the driver and is broadcast: some
    kilobytes an item, mostly its shingles, and some ten times its text."""

    shingle: int = 5
    threshold: float = 0.8
    radius: int = 39
    blocks: int = 8
    items_a_block: int = 8192
    bytes_a_block: int = 16 << 20


def fingerprints(sums: np.ndarray) -> np.ndarray:
    """Sign bits of rows of 128 sums, as eight 16-bit numbers a row."""
    return np.packbits(sums > 0, axis=1).view(">u2").astype(np.int64)


def signs(hashes: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 128 bits of each word."""
    both = np.stack([hashes, mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))], axis=1)
    bits = np.unpackbits(np.ascontiguousarray(both.astype(">u8")).view(np.uint8).reshape(len(hashes), 16), axis=1)
    return bits.astype(np.int16) * 2 - 1


#: Words over which the windows that are fingerprinted together begin.
_SPAN = 8192


def _starts(at: np.ndarray, before: int, last: int) -> np.ndarray:
    """All numbers from 0 to `last` that lie at most `before` before one of the ascending numbers `at`, each once."""
    lo = np.maximum(at - before, 0)
    lo[1:] = np.maximum(lo[1:], at[:-1] + 1)
    n = np.maximum(np.minimum(at, last) - lo + 1, 0)
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def _within(bits: int) -> np.ndarray:
    """The patterns of 16 bits with at most so many set."""
    all_ = np.arange(1 << 16)
    return all_[np.bitwise_count(all_) <= bits]


def worded(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of the texts that have words."""
    for lo, _, data, offsets in slices(column):
        starts, ends, first = words(data, offsets, ALNUM)
        hashes = word_hashes(data, starts, ends)
        for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
            if b > a:
                yield lo + i, hashes[a:b]


def shingles_of(h: np.ndarray, n: int) -> np.ndarray:
    return ngram_hashes(h, n) if len(h) >= n else np.array([sequence_hash(h)], np.uint64)


class ItemIndex:
    """A bounded block of benchmark items: shingle weights and the multi-index over fingerprints.

    A fingerprint within `radius` of an item's has, in at least one of its `blocks` blocks,
    at most radius // blocks differing bits; each block has a table from patterns to items,
    which is asked for every pattern within that many bits, so that no fingerprint within
    the radius is missed. Only items of the window's own size are in the tables that it asks.

    Where the shingles that make up the threshold can lie in fewer than that share of an
    item's words, the radius isn't enough. Such an item is also looked up by as many of its
    heaviest shingles as leave less than the threshold to the others: a window that leaks it
    holds one of them.

    rarity: (shingles in order, how many items of the benchmark have each, items with words
    in the benchmark), if the block isn't the whole of it."""

    def __init__(self, items: list[tuple[int, str | None]], p: Decontamination, rarity: tuple[np.ndarray, np.ndarray, int] | None = None):
        assert p.blocks * 16 == 128
        self.p = p
        found = list(worded(pa.array([t for _, t in items], pa.string())))
        self.ids, hashes = [items[i][0] for i, _ in found], [h for _, h in found]
        self.sizes = np.array([len(h) for h in hashes], np.int64)
        shingles = [np.unique(shingles_of(h, p.shingle)) for h in hashes]
        known, counts = np.unique(np.concatenate([*shingles, np.zeros(0, np.uint64)]), return_counts=True)
        n_items = len(hashes)
        if rarity:
            counts, n_items = rarity[1][np.searchsorted(rarity[0], known)], rarity[2]
        self.known, self.weight = known, np.log1p(n_items / counts)
        self.shingle_at = [np.searchsorted(known, s) for s in shingles]
        self.total = np.array([self.weight[s].sum() for s in self.shingle_at])
        self.lead_at, self.lead_item = self._leads()
        self.prints = fingerprints(np.array([signs(h).sum(axis=0) for h in hashes]).reshape(len(hashes), 128))
        self.nearby = _within(p.radius // p.blocks)
        self.tables = {int(size): self._tables(np.flatnonzero(self.sizes == size)) for size in np.unique(self.sizes)}
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(known >> np.uint64(42)).astype(np.int64)] = True

    def _tables(self, items: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each block, the patterns that some of the items have, the items in order of them, and where each pattern's begin."""
        out = []
        for b in range(self.p.blocks):
            order = items[np.argsort(self.prints[items, b], kind="stable")]
            patterns, begin = np.unique(self.prints[order, b], return_index=True)
            out.append((patterns, order, np.append(begin, len(order))))
        return out

    def _leads(self) -> tuple[np.ndarray, np.ndarray]:
        """(shingle number, item), in order of shingles: by what the items are looked up for which the radius isn't enough."""
        number, item = [], []
        for i, at in enumerate(self.shingle_at):
            heavy = at[np.argsort(-self.weight[at], kind="stable")]
            sums = np.cumsum(self.weight[heavy])
            least = np.searchsorted(sums, (self.p.threshold - 1e-9) * self.total[i]) + min(self.p.shingle, self.sizes[i])
            if least < self.p.threshold * self.sizes[i]:
                leads = heavy[: np.searchsorted(sums, (1 - self.p.threshold + 1e-6) * self.total[i]) + 1]
                number += leads.tolist()
                item += [i] * len(leads)
        order = np.argsort(number, kind="stable").astype(np.int64)
        return np.array(number, np.int64)[order], np.array(item, np.int64)[order]

    def led(self, first: np.ndarray, size: int, span: int, at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of `first`, item) for items of `size` words one of whose leads begins within `span` of a window's first word."""
        lo, hi = np.searchsorted(self.lead_at, number), np.searchsorted(self.lead_at, number, "right")
        place, item = np.repeat(at, hi - lo), self.lead_item[np.arange((hi - lo).sum()) + np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo)]
        place, item = place[self.sizes[item] == size], item[self.sizes[item] == size]
        lo, hi = np.searchsorted(first, place - span), np.searchsorted(first, place, "right")
        row = np.arange((hi - lo).sum()) + np.repeat(lo - np.cumsum(hi - lo) + (hi - lo), hi - lo)
        return row, np.repeat(item, hi - lo)

    def places(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of known shingles and their numbers."""
        if not len(self.known):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.filter[(grams >> np.uint64(42)).astype(np.int64)])
        number = np.minimum(np.searchsorted(self.known, grams[at]), len(self.known) - 1)
        right = self.known[number] == grams[at]
        return at[right], number[right]

    def near(self, prints: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, item, distance) for all items of `size` words within the radius of a row."""
        row, item = [], []
        for b, (patterns, order, begin) in enumerate(self.tables[size]):
            if len(patterns) > len(self.nearby):
                r, asked = np.divmod(np.arange(len(prints) * len(self.nearby)), len(self.nearby))
                asked = prints[r, b] ^ self.nearby[asked]
                place = np.minimum(np.searchsorted(patterns, asked), len(patterns) - 1)
                known = patterns[place] == asked
                r, place = r[known], place[known]
            else:  # fewer patterns than would be asked for
                r, place = np.nonzero(np.bitwise_count(prints[:, b, None] ^ patterns) <= self.p.radius // self.p.blocks)
            n = begin[place + 1] - begin[place]
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - begin[place], n)
            row.append(np.repeat(r, n))
            item.append(order[at])
        pair = np.unique(np.concatenate(row) * len(self.ids) + np.concatenate(item))
        r, i = pair // len(self.ids), pair % len(self.ids)
        distance = np.bitwise_count(prints[r] ^ self.prints[i]).sum(axis=1)
        right = distance <= self.p.radius
        return r[right], i[right], distance[right]

    def leaks(self, h: np.ndarray, at: np.ndarray, number: np.ndarray) -> list[tuple[int, int, int, int, float]]:
        """(item, start word, words, distance, similarity), the best window for each item, of a document.

        at, number: where the document's known shingles are. A window whose known shingles
        weigh less than `threshold` of the lightest item of its size can't leak one; the
        others are fingerprinted, looked up and confirmed. Once a window holds an item whole,
        no later one is better: what is left of the document is searched for the other items, by
        their shingles. Memory is some tens of bytes a word, however often an item stands in it. A
        document shorter than an item is its only window."""
        best: dict[int, tuple[int, int, int, int, float]] = {}
        weight = np.concatenate([[0], np.cumsum(self.weight[number])])
        for size in np.unique(self.sizes):
            n, width = min(self.p.shingle, size), min(size, len(h))
            if width < n:
                continue
            if n < self.p.shingle:
                a, b = self._short(h, size)
                w = np.concatenate([[0], np.cumsum(self.weight[b])])
            else:
                a, b, w = at, number, weight
            if not len(a):
                continue
            items = np.flatnonzero(self.sizes == size)
            first = self._heavy(_starts(a, int(width - n), int(len(h) - width)), a, w, width - n, items)
            lo = 0
            while lo < len(first):
                hi = min(lo + 1024, int(np.searchsorted(first, first[lo] + _SPAN)))
                whole = False
                for found in self._confirmed(h, first[lo:hi], int(size), int(width), n, a, b, w, best):
                    if found[0] not in best or (-found[4], found[1]) < (-best[found[0]][4], best[found[0]][1]):
                        best[found[0]] = found
                        whole |= found[4] >= 1 - 1e-12
                lo = hi
                if whole:
                    items = np.array([i for i in items if i not in best or best[i][4] < 1 - 1e-12], np.int64)
                    if not len(items):
                        break
                    theirs = np.zeros(len(self.weight))
                    for i in items:
                        theirs[self.shingle_at[i]] = self.weight[self.shingle_at[i]]
                    first, lo = self._heavy(first[lo:], a, np.concatenate([[0], np.cumsum(theirs[b])]), width - n, items), 0
        return list(best.values())

    def _heavy(self, first: np.ndarray, at: np.ndarray, w: np.ndarray, span: int, items: np.ndarray) -> np.ndarray:
        """The windows in which shingles (their places, and sums of their weights) weigh as much as the lightest of the items must."""
        inside = w[np.searchsorted(at, first + span, "right")] - w[np.searchsorted(at, first)]
        return first[inside >= self.p.threshold * self.total[items].min() - 1e-9]

    def _short(self, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of items of `size` words, fewer than a shingle has."""
        whole = np.array([sequence_hash(h[i : i + size]) for i in range(len(h) - size + 1)], np.uint64)
        return self.places(whole)

    def _confirmed(self, h: np.ndarray, first: np.ndarray, size: int, width: int, n: int, at: np.ndarray, number: np.ndarray, w: np.ndarray, best: dict) -> Iterator[tuple[int, int, int, int, float]]:
        base = first.min()
        sums = np.zeros((first.max() + width - base + 1, 128), np.int32)
        np.cumsum(signs(h[base : first.max() + width]), axis=0, out=sums[1:])
        prints = fingerprints(sums[first - base + width] - sums[first - base])
        row, item, _ = self.near(prints, size)
        if len(self.lead_at):
            lo, hi = np.searchsorted(at, first[0]), np.searchsorted(at, first[-1] + width - n, "right")
            more = self.led(first, size, width - n, at[lo:hi], number[lo:hi])
            pair = np.unique(np.concatenate([row, more[0]]) * len(self.ids) + np.concatenate([item, more[1]]))
            row, item = pair // len(self.ids), pair % len(self.ids)
        # a window whose known shingles weigh no more than what an earlier one had of the item is no better
        inside = w[np.searchsorted(at, first + width - n, "right")] - w[np.searchsorted(at, first)]
        had = np.array([best[i][4] if i in best else 0.0 for i in item.tolist()])
        better = (inside[row] > had * self.total[item] + 1e-9) & (had < 1 - 1e-12)
        row, item = row[better], item[better]
        distance = np.bitwise_count(prints[row] ^ self.prints[item]).sum(axis=1)
        for r, i, d in zip(row, item, distance, strict=True):
            lo, hi = np.searchsorted(at, first[r]), np.searchsorted(at, first[r] + width - n, "right")
            held = np.intersect1d(number[lo:hi], self.shingle_at[i])
            similarity = float(self.weight[held].sum() / self.total[i])
            if similarity >= self.p.threshold - 1e-9:
                yield int(i), int(first[r]), width, int(d), min(1.0, similarity)

    def search(self, column: pa.Array) -> Iterator[tuple[int, list[tuple[int, int, int, int, float]]]]:
        """(row, leaks) for the rows that leak an item."""
        short = bool((self.sizes < self.p.shingle).any())
        for lo, _, data, offsets in slices(column):
            starts, ends, first = words(data, offsets, ALNUM)
            hashes = word_hashes(data, starts, ends)
            at, number = self.places(ngram_hashes(hashes, self.p.shingle))
            if short:
                rows = np.arange(len(offsets) - 1)
            else:
                rows = np.unique(np.searchsorted(first, at, "right") - 1)
            for d in rows:
                a, b = first[d], first[d + 1]
                l, r = np.searchsorted(at, a), np.searchsorted(at, b - self.p.shingle, "right")
                if b > a and (found := self.leaks(hashes[a:b], at[l:r] - a, number[l:r])):
                    yield lo + int(d), found


def item_indexes(benchmark: DataFrame, p: Decontamination, id_col: str = "item_id", text_col: str = "text") -> Iterator[ItemIndex]:
    """The benchmark, in blocks of about `items_a_block` items or `bytes_a_block` bytes of text, whichever are more blocks: what reaches the driver at once is bounded. Weights are those of the whole benchmark."""
    items = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text IS NOT NULL AND item_id IS NOT NULL")
    count, size = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    n = max(-(-count // p.items_a_block), -(-size // p.bytes_a_block))
    if n <= 1:
        if n:
            yield ItemIndex([(r.item_id, r.text) for r in items.collect()], p)
        return

    def run(batches):
        for batch in batches:
            for row, h in worded(batch.column(1)):
                found = np.unique(shingles_of(h, p.shingle)).view(np.int64)
                # a null stands for the item itself
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found) + 1, batch.column(0)[row].as_py()), pa.int32()), pa.array([None, *found.tolist()], pa.int64())], ["block", "shingle"])

    items = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)).cast("int"))
    held = cut(items.select("block", "text").mapInArrow(run, "block int, shingle long").groupBy("block", "shingle").agg(F.count("*").alias("n")))
    counts = cut(held.groupBy("shingle").agg(F.sum("n").alias("n")))
    worded_items = held.where("shingle IS NULL").agg(F.sum("n")).first()[0] or 0
    for i in range(n):
        rows = held.where((F.col("block") == i) & F.col("shingle").isNotNull()).select("shingle").join(counts, "shingle").collect()
        known = np.array([r.shingle for r in rows], np.int64).view(np.uint64)
        order = np.argsort(known)
        rarity = known[order], np.array([r.n for r in rows], np.int64)[order], worded_items
        yield ItemIndex([(r.item_id, r.text) for r in items.where(F.col("block") == i).collect()], p, rarity)


def find_leaks(docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, start_word, n_words, distance, similarity.

    Words are runs of ASCII letters and digits and of non-ASCII characters, with A-Z as a-z.
    Only windows that can reach the threshold, judged by the weight of the known shingles in
    them, are fingerprinted; of these, every one within the radius of an item of its size, or
    with a heavy shingle of an item of uneven weights, is found and confirmed on its
    shingles. Weights are ln(1 + items / items with the shingle) over all items; an item of fewer words than a shingle is one shingle. The best
    window counts, then the earliest. Documents are read once for each block of items, one
    up to `items_a_block`, and not moved. Null or wordless texts and items match nothing; null item ids are ignored;
    rows that repeat give repeated rows; empty tables give none; other columns aren't read."""
    schema = "doc_id long, item_id long, start_word int, n_words int, distance int, similarity double"
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for block in item_indexes(benchmark, p):
        index = spark.sparkContext.broadcast(block)

        def run(batches, index=index):
            for batch in batches:
                rows, found = [], []
                for row, leaks in index.value.search(batch.column(1)):
                    rows += [row] * len(leaks)
                    found += leaks
                f = list(zip(*found, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([index.value.ids[i] for i in f[0]], pa.int64()), *(pa.array(x, pa.int32()) for x in f[1:4]), pa.array(f[4], pa.float64())],
                    ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"],
                )

        part = docs.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, p: Decontamination = Decontamination(), text_col: str = "text") -> DataFrame:
    """`docs` without the rows that leak an item; all columns stay and no row is moved."""
    spark, schema = docs.sparkSession, docs.schema
    for block in item_indexes(benchmark, p):
        index = spark.sparkContext.broadcast(block)

        def run(batches, index=index):
            for batch in batches:
                stays = np.ones(batch.num_rows, bool)
                stays[[row for row, _ in index.value.search(batch.column(batch.schema.get_field_index(text_col)))]] = False
                yield batch.filter(pa.array(stays))

        docs = docs.mapInArrow(run, schema)
    return docs
