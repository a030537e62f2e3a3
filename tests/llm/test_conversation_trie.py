"""The prefix trie against one of dictionaries."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from obslog.llm import conversation_trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def turn_id(t):
    role, text = t
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def nodes_of(convs):
    """Rows of the trie of {conv_id: [(role, text)]}."""
    if not convs:
        return []
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in nodes:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[: len(path)] == path]
        ends = sorted(c for c in members if len(convs[c]) == len(path))
        saved = sum((len(nodes[p]) - 1) * len(p[-1][1]) for p in under if p)
        leaves = sum(p not in children for p in under)
        up = min(nodes[path[:-1]]) if path else None
        out.append((min(members), len(path), up, len(members), len(children.get(path, [])), leaves, saved, sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn, (role or "", text or "")))
    own = {c: [x for _, x in sorted(v, key=lambda y: (y[0] is not None, y[0] or 0, turn_id(y[1])))] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.select(*COLUMNS).collect()), key=str)


def trie(df):
    return T.prefix_trie(T.rebuilt(T.turn_lists(df)))


def random_rows(seed, convs, longest):
    rng = random.Random(seed)
    texts = ["", "a", "bé", "𝄞x", "long text " * 3]
    rows = []
    for c in rng.sample(range(-150, 700), convs):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn if rng.random() > 0.05 else None, rng.choice(["user", None, "bot"]), rng.choice([*texts, None])))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_trie_of_dictionaries(spark, seed):
    rows = random_rows(seed, 220, 7)
    assert got(trie(spark.createDataFrame(rows, SCHEMA))) == nodes_of(rebuilt(rows))


def test_copies_over_many_shards(spark):
    """A third of the conversations are equal, so that their nodes go on over several shards."""
    rows = [(c, t, "user", f"t{t}" if c % 3 else f"own {c % 7} {t}") for c in range(400) for t in range(1 + c % 3 * 2)]
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert got(trie(spark.createDataFrame(rows, SCHEMA))) == nodes_of(rebuilt(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("width", [1, 2, 3, 64])
def test_matrices_of_any_width_give_one_order(width):
    rng = np.random.default_rng(5)
    n = rng.integers(0, 9, 300)
    offsets = np.concatenate([[0], np.cumsum(n)])
    codes, conv = rng.integers(1, 4, offsets[-1]), rng.permutation(300)
    order, places = T.in_order(codes, offsets, conv, width)
    seqs = [tuple(codes[offsets[i] : offsets[i + 1]]) for i in range(300)]
    assert list(order) == sorted(range(300), key=lambda i: (seqs[i], conv[i]))
    for d, (lo, hi) in enumerate(places, 1):
        assert [seqs[order[a]][:d] for a in lo] == sorted({s[:d] for s in seqs if len(s) >= d})
        assert all(len({seqs[order[i]][:d] for i in range(a, b)}) == 1 for a, b in zip(lo, hi, strict=True))


def test_very_long_conversations(spark):
    """Far longer than a matrix is wide; two that part in the last turn, and one long text."""
    c, e, f = [i for i in range(200, 300) if crc32(str(i).encode()) % 6 == 0][:3]
    rows = [(i, t, "user", "x" if t < 2999 else f"end {i}") for i in (c, e) for t in range(3000)] + [(f, 0, "user", "y" * 1_000_000)]
    out = {(r[0], r[1]): r[2:7] for r in got(trie(spark.createDataFrame(rows, SCHEMA)))}
    assert len(out) == 3000 + 2 + 1
    assert out[c, 0] == (None, 3, 2, 3, 2999) and out[f, 1] == (c, 1, 0, 1, 0)
    assert all(out[c, d] == (c, 2, 1 if d < 2999 else 2, 2, 2999 - d + 1) for d in range(1, 3000))
    assert out[c, 3000] == out[e, 3000] == (c, 1, 0, 1, 0)


def test_empty_tables_nulls_and_turnless_conversations(spark):
    assert got(trie(spark.createDataFrame([], SCHEMA))) == []
    rows = [(None, 0, "user", "a"), (201, 0, None, None)]
    assert got(trie(spark.createDataFrame(rows, SCHEMA))) == nodes_of(rebuilt(rows))
    turnless = next(c for c in range(101, 200) if crc32(str(c).encode()) % 6)
    assert got(trie(spark.createDataFrame([(turnless, 0, "user", "a")], SCHEMA))) == [(turnless, 0, None, 1, 0, 1, 0, sha256(str(turnless).encode()).hexdigest())]


def test_columns_of_the_same_names(spark):
    rows = random_rows(9, 60, 4)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit(1)).withColumn("ids", F.lit("x")).withColumn("depth", F.lit(2))
    assert got(trie(df)) == nodes_of(rebuilt(rows))
