"""Prefix trie of conversations: every distinct beginning of turns with its members, children, leaves and what sharing it saves.

Conversations are sorted by their turns' ids and dealt to shards by ranges, so that a node's
members stand together. A shard writes its turns as padded matrices of ids, sorts them by
numpy's lexsort, and reads the nodes of every depth off the places where a row differs from
the one before it in this or an earlier column. A node that holds a shard's first or last row
may go on in the next shard: its parts are recombined by a digest of its turns."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslog.llm.common import cut

#: Columns of a padded matrix; longer conversations go on in further matrices.
WIDTH = 64
#: Turns that a shard has on average, at most.
SHARD_TURNS = 200_000
#: Ids of a piece of a node's list of ended conversations.
_PIECE = 1024


def heads(conv_id: Column) -> Column:
    """How many turns a conversation takes from the beginning of its hundred's first one."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 6).cast("int")


def turn_lists(turns: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's turns as (turn, id, n) in order, the turn's id being 16 bytes of a digest of role and text.

    Null turns come first, and rows of one turn in order of their ids. A null role or text is
    empty. Rows without a conv_id belong to no conversation."""
    part = lambda c: F.coalesce(F.col(c), F.lit(""))
    role, text = part("role"), part("text")
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 32))
    one = F.struct(F.col("turn"), digest.alias("id"), F.length(text).cast("long").alias("n"))
    return turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(one)).alias("turns"))


def rebuilt(lists: DataFrame, most: int = 5) -> DataFrame:
    """(conv_id, turns) with each conversation's first turns taken from the first conversation of its hundred."""
    base = lists.where("conv_id % 100 = 0").select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    joined = lists.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100).join(base, "base", "left").withColumn("h", heads(F.col("conv_id")))
    head = F.coalesce(F.expr("slice(head, 1, h)"), F.expr("slice(turns, 1, 0)"))
    own = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    return joined.select("conv_id", F.concat(head, own).alias("turns"))


#: kind: 0 a whole node, 1 a whole node whose parent may go on in another shard, 2 a part of a node that may go on, 3 a piece of its ended conversations.
_SHARD = pa.schema(
    [("kind", pa.int8()), *[(c, pa.int64()) for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "depth", "parent_conv_id")], ("ends_sha256", pa.string())]
    + [("shard", pa.int32()), ("side", pa.int8()), ("both", pa.bool_()), ("key", pa.binary()), ("parent_key", pa.binary()), ("size", pa.int64()), ("piece", pa.int64()), ("ids", pa.string())]
)
_SHARD_DDL = (
    "kind tinyint, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, depth long, parent_conv_id long, ends_sha256 string, "
    "shard int, side tinyint, both boolean, key binary, parent_key binary, size long, piece long, ids string"
)
LEFT, RIGHT = 0, 1


def in_order(codes: np.ndarray, offsets: np.ndarray, conv: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The order of conversations by their codes (from 1), then ids, and for every depth from 1 the first and the end row of its nodes in that order.

    Matrix after matrix of `width` padded columns: rows that are equal so far are sorted by
    the next columns. A column's mask marks the rows that differ from the one before them in
    it or in any column before it; of these, rows with a turn there begin a node."""
    n = np.diff(offsets)
    order = np.lexsort((conv,))
    group = np.zeros(len(n), np.int64)  # of the row at each place: the place of the first row that is equal so far
    places: list[tuple[np.ndarray, np.ndarray]] = []
    for start in range(0, int(n.max(initial=0)), width):
        at = np.flatnonzero(n[order] >= start)  # those that end right here come before those that go on
        rows, held = order[at], group[at]
        size = np.clip(n[rows] - start, 0, width)
        matrix = np.zeros((len(rows), int(size.max())), np.int64)
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        matrix[np.repeat(np.arange(len(rows)), size), within] = codes[np.repeat(offsets[rows] + start, size) + within]
        sort = np.lexsort((conv[rows], *matrix.T[::-1], held))
        order[at], matrix = rows[sort], matrix[sort]
        changed = np.ones(len(rows), bool)
        changed[1:] = held[1:] != held[:-1]
        for column in matrix.T:
            changed[1:] |= column[1:] != column[:-1]
            marks = np.append(np.flatnonzero(changed), len(rows))
            first = np.flatnonzero(column[marks[:-1]] > 0)
            places.append((at[marks[first]], at[marks[first + 1] - 1] + 1))
        group[at] = at[np.maximum.accumulate(np.where(changed, np.arange(len(at)), 0))]
    return order, places


def _prefix_keys(ids: np.ndarray) -> list[bytes]:
    """A digest of the first d ids, for d from 0."""
    so_far = sha256()
    out = [so_far.digest()]
    for one in ids:
        so_far.update(one.tobytes())
        out.append(so_far.digest())
    return out


def shard_nodes(conv: np.ndarray, ids: np.ndarray, size: np.ndarray, offsets: np.ndarray, shard: int, width: int = WIDTH) -> Iterator[dict[str, object]]:
    """Columns of `_SHARD`, batch by batch, of one shard's conversations; `ids` (16 bytes a turn) and `size` (code points) lie flat, cut by `offsets`."""
    rows = len(conv)
    if not rows:
        return
    order, places = in_order(np.unique(ids, return_inverse=True)[1] + 1, offsets, conv, width)
    conv, turns, start = conv[order], np.diff(offsets)[order], offsets[:-1][order]
    per = [1, *[len(b) for b, _ in places]]
    below = np.concatenate([[0], np.cumsum(per)])  # the first node of each depth
    lo, hi = np.concatenate([[0], *[b for b, _ in places]]), np.concatenate([[rows], *[e for _, e in places]])
    depth = np.repeat(np.arange(len(per)), per)
    beyond = np.append(conv, np.iinfo(np.int64).max)
    least = np.concatenate([np.minimum.reduceat(beyond, np.stack([lo[a:b], hi[a:b]], 1).ravel())[::2] for a, b in zip(below[:-1], below[1:], strict=True)])
    count = hi - lo
    own = np.zeros(len(lo), np.int64)
    own[1:] = size[start[lo[1:]] + depth[1:] - 1]
    parent, ended = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
    by_turns = np.argsort(turns, kind="stable")
    cuts = np.searchsorted(turns[by_turns], np.arange(len(per) + 1))
    for d, (a, b) in enumerate(zip(below[:-1], below[1:], strict=True)):
        if d:
            parent[a:b] = below[d - 1] + np.searchsorted(lo[below[d - 1] : a], lo[a:b], "right") - 1
        ended[a:b] = np.bincount(np.searchsorted(lo[a:b], by_turns[cuts[d] : cuts[d + 1]], "right") - 1, minlength=b - a)
    children = np.bincount(parent[1:], minlength=len(lo))
    walk = np.lexsort((depth, lo))  # preorder, in which a subtree is a run
    at = np.empty(len(lo), np.int64)
    at[walk] = np.arange(len(lo))
    until = np.searchsorted(lo[walk], hi)

    def subtree(v: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(v[walk])])
        return sums[until] - sums[at]

    leaves, saved = subtree((children == 0).astype(np.int64)), subtree((count - 1) * own)
    edge, side = (lo == 0) | (hi == rows), np.where(lo == 0, LEFT, RIGHT)
    text = [str(c) for c in conv]
    whole = lambda pick: {"conv_id": least[pick], "n_convs": count[pick], "n_children": children[pick], "n_leaves": leaves[pick], "saved_tokens": saved[pick], "depth": depth[pick]}
    for kind, nodes in ((0, np.flatnonzero(~edge & ~edge[parent])), (1, np.flatnonzero(~edge & edge[parent]))):
        for some in np.split(nodes, range(50_000, len(nodes), 50_000)):
            digests = [sha256(",".join(text[lo[i] : lo[i] + ended[i]]).encode()).hexdigest() for i in some]
            above = {"parent_conv_id": least[parent[some]]} if kind == 0 else {"side": side[parent[some]]}
            yield whole(some) | above | {"kind": np.full(len(some), kind), "shard": np.full(len(some), shard), "ends_sha256": digests}
    keys = [_prefix_keys(ids[start[r] : start[r] + turns[r]]) for r in (0, rows - 1)]
    some = np.flatnonzero(edge)
    key = [keys[side[i]][depth[i]] for i in some]
    up = [keys[side[i]][depth[i] - 1] if depth[i] else None for i in some]
    yield whole(some) | {"kind": np.full(len(some), 2), "shard": np.full(len(some), shard), "side": side[some], "both": (lo[some] == 0) & (hi[some] == rows), "key": key, "parent_key": up, "size": own[some]}
    for i, k in zip(some, key, strict=True):
        for piece in range(0, int(ended[i]), _PIECE):
            yield {"kind": [3], "shard": [shard], "key": [k], "piece": [piece], "ids": [",".join(text[lo[i] + piece : lo[i] + min(piece + _PIECE, ended[i])])]}


def _in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow: the conversations (shard, conv_id, ids, sizes) of a shard to rows of `_SHARD`."""
    held = list(batches)
    table = pa.Table.from_batches(held).combine_chunks() if held else None
    if table is None or not table.num_rows:
        return
    ids, sizes = table["ids"].combine_chunks(), table["sizes"].combine_chunks()
    offsets = ids.offsets.to_numpy().astype(np.int64) - ids.offsets[0].as_py()
    flat = np.frombuffer(b"".join(ids.flatten().to_pylist()), "S16")
    for out in shard_nodes(table["conv_id"].to_numpy(), flat, sizes.flatten().to_numpy(), offsets, table["shard"][0].as_py()):
        n = len(out["kind"])
        yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) if f.name in out else pa.nulls(n, f.type) for f in _SHARD], schema=_SHARD)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow over (key, ids) in order: a digest of each key's ids, piece after piece."""
    key, so_far, out = None, sha256(), []
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if k == key:
                so_far.update(b",")
            else:
                if key is not None:
                    out.append((key, so_far.hexdigest()))
                key, so_far = k, sha256()
            so_far.update(ids.encode())
    if key is not None:
        out.append((key, so_far.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.binary()), pa.array([d for _, d in out], pa.string())], ["key", "ends_sha256"])


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of conversations (conv_id, turns of `turn_lists`): conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A conversation without turns is a member of the root alone; no conversations give no
    nodes. Of a conversation, its turns' ids must fit a task, not its texts. Equal
    conversations are dealt to shards by their ids, so that a group of copies is no one
    task's work; only its list of ids, which one digest must read in order, passes through
    one task, in pieces."""
    spark = conversations.sparkSession
    flat = cut(conversations.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.n").alias("sizes")))
    turns = flat.agg(F.sum(F.size("ids"))).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns // SHARD_TURNS))
    dealt = flat.repartitionByRange(shards, "ids", "conv_id").select(F.spark_partition_id().alias("shard"), "conv_id", "ids", "sizes")
    nodes = cut(dealt.mapInArrow(_in_shards, _SHARD_DDL))

    parts = nodes.where("kind = 2")
    merged = cut(
        parts.groupBy("key").agg(
            F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("children"), F.count("*").alias("k"),
            F.min("shard").alias("owner"), F.max("parent_key").alias("parent_key"), F.max("size").alias("size"), F.count_if(F.col("n_children") == 0).alias("leaf_parts"),
        )
    )
    # what the parts' sums count too often or too seldom at a node goes to all nodes above it, once: along the path of the first shard that has it
    amiss = merged.select("key", "owner", F.expr("IF(children = 0, 1, 0) - leaf_parts").alias("leaf"), F.expr("(k - 1) * size").alias("saved"))
    at = parts.select("key", "shard", "side", "depth", "both", "n_leaves", "saved_tokens").join(amiss, "key")
    mine = lambda c: F.when(F.col("shard") == F.col("owner"), F.col(c)).otherwise(0)
    path = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    right = lambda c: F.sum(F.when(F.col("side") == RIGHT, mine(c)).otherwise(0)).over(Window.partitionBy("shard"))
    total = lambda c: F.sum(mine(c)).over(path) + F.when(F.col("both"), right(c)).otherwise(0)
    sums = at.select("key", (F.col("n_leaves") + total("leaf")).alias("n_leaves"), (F.col("saved_tokens") + total("saved")).alias("saved_tokens"))
    sums = sums.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    again = merged.where("k > 1 AND parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.sum(F.col("k") - 1).alias("again"))
    pieces = nodes.where("kind = 3").select("key", "shard", "piece", "ids").repartition("key").sortWithinPartitions("key", "shard", "piece")
    ends = pieces.select("key", "ids").mapInArrow(_digests, "key binary, ends_sha256 string")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    edges = merged.join(sums, "key").join(again, "key", "left").join(ends, "key", "left").join(above, "parent_key", "left")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    edges = edges.withColumn("n_children", F.col("children") - F.coalesce("again", F.lit(0))).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(sha256().hexdigest())))
    places = parts.select("key", "shard", "side", "depth").join(merged.select("key", F.col("conv_id").alias("above")), "key").select("shard", "side", (F.col("depth") + 1).alias("depth"), "above")
    inner = nodes.where("kind = 1").join(places, ["shard", "side", "depth"]).withColumn("parent_conv_id", F.col("above"))
    return nodes.where("kind = 0").select(*columns).unionByName(inner.select(*columns)).unionByName(edges.select(*columns))
