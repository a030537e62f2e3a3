"""Merkle manifests against trees built node by node."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from obslog.llm import merkle as M


def H(parts):
    return sha256("".join(parts).encode()).hexdigest()


def told(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def climbed(tree, i, digest):
    """(siblings up to the root, the root that `digest` gives)."""
    siblings = []
    for level in tree[:-1]:
        run = i // 16 * 16
        left, right = level[run:i], level[i + 1 : run + 16]
        siblings += left + right
        digest, i = H(left + [digest] + right), i // 16
    return siblings, digest


def plain(rows):
    """Verdicts of rows (doc_id, text, lang, source, n_chars) by the contract, with nothing shared between rows."""
    full = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    by = {}
    for r in full:
        by.setdefault(r[1], []).append((r, H([told(r)])))
    by = {s: sorted(v, key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for s, v in by.items()}
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf for _, leaf in by[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, (r, leaf) in enumerate(by[s]):
            low = None if r[4] is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[4])
            hit = r[0] is not None and crc32(str(r[0]).encode()) % 5 == 0
            start = H([told((*r[:4], low))]) if hit else leaf
            inner, sub = climbed(trees[s], i, start)
            outer, root = climbed(top, k, sub)
            out.append((r[0], leaf, trees[s][-1][0], top[-1][0], H(inner + outer), root, root == top[-1][0]))
    return sorted(out, key=str)


def verdicts(df):
    return sorted(map(tuple, df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 255, 256, 257, 272, 273, 4095, 4096])
def test_positions_are_those_of_the_log(n):
    leaves = [H([str(i)]) for i in range(n)]
    top = M.height(n)
    log = M.append_log((x.encode() for x in leaves), top)
    seen = set()
    for level, nodes in enumerate(levels(leaves)):
        for i, digest in enumerate(nodes):
            at = M.position(level, i, n, top)
            assert log[at].decode() == digest
            seen.add(at)
    assert seen == set(range(len(log)))


def test_verdicts_equal_the_plain_trees(table):
    rng = random.Random(3)
    rows = [(i, f"Text {'Ä' * (i % 3)} {rng.random()}", rng.choice(["en", None]), rng.choice(["a", "b", "é", "B", None, ""]), i) for i in range(700)]
    rows += [(900 + i, "all low", "en", "single", 3) for i in range(1)]
    rows += [(None, "No Id", None, "a", None), (None, None, None, "a", None), (5, "Same", "en", "a", 1), (5, "Same", "en", "a", 1), (5, "Other", "en", "a", 1), (-8, "", "", "", 0)]
    got = verdicts(M.verify_tampered(table(rows)))
    assert got == plain(rows)
    assert not all(r[-1] for r in got)


def test_trees_of_several_tiers(table):
    rows = [(i, f"T{i}", "en", "hot" if i % 7 else "other", i) for i in range(9000)]
    manifest = M.merkle_manifest(table(rows))
    assert len(manifest.sources.tiers) == 2
    assert verdicts(M.verify_tampered(table(rows))) == plain(rows)


def test_the_log_has_every_node_at_its_place(table):
    rows = [(i, f"t{i}", "en", "s" if i < 4500 else "u", i) for i in range(4700)]
    manifest = M.merkle_manifest(table(rows))
    log = [tuple(r) for r in M.log_rows(manifest.sources).select("tree", "position", "level", "i", "digest").collect()]
    for tree, ids in (("=s", range(4500)), ("=u", range(4500, 4700))):
        nodes = levels([H([told((i, tree[1:], "en", i, f"t{i}"))]) for i in ids])
        own = sorted(r[1:] for r in log if r[0] == tree)
        assert [r[0] for r in own] == list(range(sum(map(len, nodes))))
        assert all(nodes[level][i] == digest for _, level, i, digest in own)
        assert own == sorted(own, key=lambda r: M.position(r[1], r[2], len(ids), M.height(len(ids))))


def test_one_row_and_no_rows(table):
    assert verdicts(M.verify_tampered(table([(3, "A", None, None, 1)]))) == plain([(3, "A", None, None, 1)])
    assert M.verify_tampered(table([])).collect() == []


def test_long_texts_and_columns_of_the_same_names(table):
    rows = [(i, "Xy" * 500_000 if i == 4 else "b", "en", "s", i) for i in range(20)]
    docs = table(rows).withColumn("leaf", F.lit("x")).withColumn("root", F.lit(1)).withColumn("tree", F.lit(2)).withColumn("i", F.lit(3))
    assert verdicts(M.verify_tampered(docs)) == plain(rows)
