"""Merkle manifest of a dataset: trees of 16 over row digests, kept as a postorder append log, with a proof for each row.

A tree's nodes are built by aligned builders: a builder takes 4096 neighbouring leaves, and
writes each node when it is complete, right behind its last child. So the nodes of a builder
stand together in the tree's postorder log, and `position` tells where any node stands from
subtree sizes alone: siblings are read by their places, without a search. The builders' roots
are the leaves of the next tier of builders, until one node is left."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslog.llm.common import cut, without

ARITY = 16
#: Levels that a builder completes, and so the leaves that it takes.
HEIGHT = 3
SPAN = ARITY**HEIGHT
_HEX = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def height(leaves: int) -> int:
    """Levels above the leaves."""
    h = 0
    while leaves > 1:
        leaves, h = -(-leaves // ARITY), h + 1
    return h


def position(level: int, i: int, leaves: int, top: int) -> int:
    """Place in the postorder log of node i of a level, in a tree of `leaves` leaves whose root has the level `top`.

    Before a node come the whole subtrees on its left, and its own descendants: at its level
    and below all nodes that end no later than it, above it all that end before it begins."""
    start, end = i * ARITY**level, min((i + 1) * ARITY**level, leaves)
    return sum(-(-end // ARITY**m) for m in range(level + 1)) + sum(start // ARITY**m for m in range(level + 1, top + 1)) - 1


def append_log(leaves: Iterable[bytes], top: int) -> list[bytes]:
    """The nodes of a tree in the order in which they are complete; the last is its root. A short last run, even of one, is a node."""
    log: list[bytes] = []
    open_: list[list[bytes]] = [[] for _ in range(top)]

    def close(level: int) -> None:
        node = sha256(b"".join(open_[level])).hexdigest().encode()
        open_[level].clear()
        write(level + 1, node)

    def write(level: int, node: bytes) -> None:
        log.append(node)
        if level < top:
            open_[level].append(node)
            if len(open_[level]) == ARITY:
                close(level)

    for leaf in leaves:
        write(0, leaf)
    for level in range(top):
        if open_[level]:
            close(level)
    return log


def told(*columns: str) -> Column:
    """Fields as one text that no other fields give: `-` for a null, else the bytes' number, a colon and the value."""
    value = lambda c: F.col(f"`{c}`").cast("string")
    return F.concat(*[F.when(value(c).isNull(), "-").otherwise(F.concat(F.octet_length(value(c)).cast("string"), F.lit(":"), value(c))) for c in columns])


def leaf(docs: DataFrame, fields: tuple[str, ...]) -> Column:
    return F.sha2(told(*fields).cast("binary"), 256)


def lower_case_leaf(fields: tuple[str, ...], text_col: str) -> Column:
    """The leaf of a row whose text's A-Z have been lower-cased."""
    text = F.col(f"`{text_col}`")
    low = F.translate(text, _UPPER, _LOWER)
    at = [told(f) if f != text_col else F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), low)) for f in fields]
    return F.sha2(F.concat(*at).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """`rows`, written, with i (their place in their group by `order`, from 0) and n (the group's rows); `group` is not null.

    Rows are dealt by ranges and numbered within them, on from the exact counts of the
    group's earlier ranges, so that a group of most of the rows is no one task's work."""
    dealt = cut(rows.repartitionByRange(group, *order).withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy(group, "__part").agg(F.count("*").alias("__n"))
    of = Window.partitionBy(group)
    ahead = of.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "__part", F.coalesce(F.sum("__n").over(ahead), F.lit(0)).alias("__before"), F.sum("__n").over(of).alias("n"))
    place = F.col("__before") + F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order)) - 1
    return cut(dealt.join(counts, [group, "__part"]).withColumn("i", place.cast("long")).drop("__part", "__before"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], list[dict]]]:
    """Rows of one (tree, block) after another, in the order in which they come."""
    key, held = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if (row["tree"], row["block"]) != key:
                if held:
                    yield key, held
                key, held = (row["tree"], row["block"]), []
            held.append(row)
    if held:
        yield key, held


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= size or weight > 8 << 20:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


_SEGMENT = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()), ("log", pa.string())])


def _build(nodes: DataFrame) -> DataFrame:
    """(tree, block, n, log) of each builder over nodes (tree, i, n, digest): its nodes in postorder, as one text of digests."""

    def run(batches):
        def logs():
            for (tree, block), rows in _runs(batches):
                n = rows[0]["n"]
                yield tree, block, n, b"".join(append_log((r["digest"].encode() for r in rows), min(HEIGHT, height(n)))).decode()

        yield from _batches(logs(), _SEGMENT)

    placed = nodes.select("tree", F.expr(f"i div {SPAN}").alias("block"), "i", "n", "digest")
    return cut(placed.repartition("tree", "block").sortWithinPartitions("tree", "block", "i").mapInArrow(run, "tree string, block long, n long, log string"))


@dataclass
class Forest:
    """Trees and their log: tiers[k] has the segments (tree, block, n, log) over the n nodes that tier k has in the tree; the leaves are tier 0's."""

    tiers: list[DataFrame]

    def roots(self) -> DataFrame:
        """(tree, digest) of every tree."""
        parts = [t.where(f"n <= {SPAN}").select("tree", F.right("log", F.lit(_HEX)).alias("digest")) for t in self.tiers]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def plant(leaves: DataFrame) -> Forest:
    """The trees over leaves (tree, i, n, digest); as many tiers as the largest tree needs, which is one for each factor of 4096."""
    tiers, nodes = [], leaves
    while True:
        tiers.append(_build(nodes))
        above = tiers[-1].where(f"n > {SPAN}")
        if above.isEmpty():
            return Forest(tiers)
        nodes = above.select("tree", F.col("block").alias("i"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"), F.right("log", F.lit(_HEX)).alias("digest"))


def _levels(log: str, n: int, block: int) -> tuple[list[list[str]], int]:
    """The nodes of a segment by level, each read at its position, and the level of its root."""
    top = min(HEIGHT, height(n))
    leaves = min(SPAN, n - block * SPAN)
    out, count = [], leaves
    for level in range(top + 1):
        at = [position(level, i, leaves, top) * _HEX for i in range(count)]
        out.append([log[p : p + _HEX] for p in at])
        count = -(-count // ARITY)
    return out, top


def _step(level: list[str], i: int) -> str:
    """One level of a path: the siblings of node i, with a dot in its own place."""
    run = i // ARITY * ARITY
    return "".join(level[run:i]) + "." + "".join(level[i + 1 : run + ARITY])


def fold(digest: str, path: str) -> str:
    """The root that a digest and its path, levels apart by `;`, give."""
    for step in path.split(";") if path else []:
        digest = sha256(step.replace(".", digest).encode()).hexdigest()
    return digest


def proof_digest(path: str) -> str:
    return sha256(path.replace(";", "").replace(".", "").encode()).hexdigest()


def _joined(step: str, rest: str) -> str:
    return f"{step};{rest}" if rest else step


def _paths_within(levels: list[list[str]], top: int, upper: str, level: int = 1) -> list[str]:
    """The paths of all nodes of a level of a segment, from the node up to the root of the last tree."""
    paths = [upper]
    for at in range(top - 1, level - 1, -1):
        paths = [_joined(_step(levels[at], i), paths[i // ARITY]) for i in range(len(levels[at]))]
    return paths


_PATHS = "tree string, block long, path string"


def _child_paths(segments: DataFrame) -> DataFrame:
    """Of segments (tree, block, n, log, path): the path of each of their leaves, which are the roots of the blocks below."""
    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("path", pa.string())])

    def run(batches):
        def paths():
            for batch in batches:
                for r in batch.to_pylist():
                    levels, top = _levels(r["log"], r["n"], r["block"])
                    for i, path in enumerate(_paths_within(levels, top, r["path"], 0)):
                        yield r["tree"], r["block"] * SPAN + i, path

        yield from _batches(paths(), schema)

    return segments.select("tree", "block", "n", "log", "path").mapInArrow(run, _PATHS)


def segment_paths(forest: Forest, upper: DataFrame) -> list[DataFrame]:
    """For each tier its segments with `path`, from the segment's root up; `upper` has (tree, path) from each tree's root up."""
    out: list[DataFrame] = []
    below: DataFrame | None = None  # the paths of this tier's roots in trees that have a tier above
    for segments in reversed(forest.tiers):
        tops = segments.where(f"n <= {SPAN}").join(upper, "tree")
        with_path = tops if below is None else tops.unionByName(segments.where(f"n > {SPAN}").join(below, ["tree", "block"]))
        out.append(cut(with_path))
        below = _child_paths(out[-1])
    return out[::-1]


def log_rows(forest: Forest) -> DataFrame:
    """(tree, position, level, i, digest): every node of the trees at its place in its tree's log."""
    schema = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("level", pa.int32()), ("i", pa.int64()), ("digest", pa.string())])
    sizes = forest.tiers[0].select("tree", F.col("n").alias("__leaves")).distinct()
    out = None
    for tier, segments in enumerate(forest.tiers):

        def run(batches, tier=tier):
            def nodes():
                for batch in batches:
                    for r in batch.to_pylist():
                        total = r["__leaves"]
                        levels, _ = _levels(r["log"], r["n"], r["block"])
                        for low, nodes in enumerate(levels):
                            if tier and not low:
                                continue  # the roots of the tier below
                            level = HEIGHT * tier + low
                            for i, digest in enumerate(nodes, r["block"] * (SPAN // ARITY**low)):
                                yield r["tree"], position(level, i, total, height(total)), level, i, digest

            yield from _batches(nodes(), schema)

        part = segments.join(sizes, "tree").mapInArrow(run, "tree string, position long, level int, i long, digest string")
        out = part if out is None else out.unionByName(part)
    return out


@dataclass
class Manifest:
    """Rows with their leaves and places, the trees of the sources, and the tree over the sources' roots."""

    rows: DataFrame
    sources: Forest
    whole: Forest
    subroots: DataFrame

    def root(self) -> DataFrame:
        """One row with the digest of everything; none if there are no rows."""
        return self.whole.roots().select(F.col("digest").alias("root"))


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def merkle_manifest(docs: DataFrame, other_leaf: Column | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", source_col: str = "source") -> Manifest:
    """The manifest of `docs`: a tree for each source over its rows by id, and one over the sources' roots.

    Null fields are told apart from empty ones; a null source is a source and the first; a
    null id is the smallest; rows of one id come in order of their leaves. A long text is
    hashed where it is read: only digests move. `other_leaf` is the leaf that a row is to be
    verified with in place of its own (null: its own). No rows give no nodes."""
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{source_col}`").cast("string")), F.lit(""))
    other = other_leaf if other_leaf is not None else F.lit(None).cast("string")
    rows = docs.select(tree.alias("tree"), F.col(f"`{id_col}`").alias("id"), leaf(docs, fields).alias("digest"), other.alias("other"))
    placed = numbered(rows, "tree", "id", "digest")
    sources = plant(placed.select("tree", "i", "n", "digest"))
    one = numbered(sources.roots().select(F.lit("").alias("tree"), F.col("tree").alias("source"), "digest"), "tree", "source")
    return Manifest(placed, sources, plant(one.select("tree", "i", "n", "digest")), one)


_VERDICTS = pa.schema([("id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string())])


def verify(manifest: Manifest) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row: its proof, and the root that its `other` or own leaf gives with it.

    A block's rows meet the block's segment of the log, sorted behind it, so that a task
    holds one builder's leaves at a time."""
    found = manifest.root().first()
    root = F.lit(found.root if found else None).cast("string")
    top = manifest.whole.tiers[-1].select("tree", F.lit("").alias("path"))
    place = _child_paths(segment_paths(manifest.whole, top)[0]).select(F.col("block").alias("i"), "path")
    upper = cut(manifest.subroots.select("i", F.col("source").alias("tree"), F.col("digest").alias("subroot")).join(place, "i").withColumn("root", root))
    segments = segment_paths(manifest.sources, upper.select("tree", "path"))[0].join(upper.select("tree", "subroot", "root"), "tree")
    nothing = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    heads = segments.select("tree", "block", F.lit(-1).cast("long").alias("i"), "n", F.lit(None).cast("long").alias("id"), *nothing("other"), "log", "path", "subroot", "root")
    own = manifest.rows.select("tree", F.expr(f"i div {SPAN}").alias("block"), "i", "n", "id", "other", *nothing("log", "path", "subroot", "root"))

    def run(batches):
        yield from _batches((v for _, rows in _runs(batches) for v in _verdicts(rows)), _VERDICTS)

    met = heads.unionByName(own).repartition("tree", "block").sortWithinPartitions("tree", "block", "i")
    out = met.mapInArrow(run, "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _verdicts(rows: list[dict]) -> Iterator[tuple]:
    """The verdicts of a block: its segment, then its rows by place."""
    head = rows[0]
    levels, top = _levels(head["log"], head["n"], head["block"])
    above = _paths_within(levels, top, head["path"], min(1, top))
    hashed = [p.replace(";", "").replace(".", "").encode() for p in above]
    folded: dict[tuple[int, str], str] = {}  # the same node in the same place has one root
    for r in rows[1:]:
        i = r["i"] - head["block"] * SPAN
        own = levels[0][i]
        if top:
            step = _step(levels[0], i)
            proof = sha256(step.replace(".", "").encode() + hashed[i // ARITY]).hexdigest()
            at, node = i // ARITY, sha256(step.replace(".", r["other"] or own).encode()).hexdigest()
        else:
            proof, at, node = sha256(hashed[0]).hexdigest(), 0, r["other"] or own
        if (at, node) not in folded:
            folded[at, node] = fold(node, above[at])
        yield r["id"], own, head["subroot"], head["root"], proof, folded[at, node]


def tampered_leaf(docs: DataFrame, every: int = 5, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The leaf of a row tampered with: one with a lower-case text where the crc32 of the id as text is a multiple of `every`; null elsewhere."""
    hit = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % every == 0
    return F.when(hit, lower_case_leaf(fields, text_col))


def verify_tampered(docs: DataFrame) -> DataFrame:
    """Every row's proof, where a fifth of the rows are verified with tampered texts."""
    docs = without(docs.select(*FIELDS))
    return verify(merkle_manifest(docs, tampered_leaf(docs))).withColumnRenamed("id", "doc_id")
