import random
import re

import numpy as np
import pytest

from obslog.llm import near_dedup
from obslog.llm.components import connected_components
from obslog.llm.near_dedup import NearDedup, drop_near_duplicates, links_of_block, min_samples, near_duplicates, odd_sketches, sketch_similarity

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(docs, n=3, t=85):
    sets = {d: shingles(x, n) for d, x in docs}
    up = {d: d for d in sets}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= t * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in ids}


@pytest.fixture(scope="module")
def corpus(prose):
    rng = random.Random(1)
    docs = [(i, prose(i, rng.randint(5, 90))) for i in range(40)]
    base = prose(900, 120).split()
    for i in range(60):  # near copies of one text, of all degrees
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"w{rng.random()}"
        docs.append((100 + i, " ".join(w)))
    docs += [(300, "One two"), (301, "one  TWO\n"), (302, "one"), (303, ""), (304, None), (305, " \t\n"), (306, docs[0][1].upper()), (307, docs[0][1]), (308, "Élan one two"), (309, "élan one two")]
    return docs


@pytest.mark.parametrize("block", [140, 7, 2])
def test_equals_brute_force(table, corpus, block):
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(table(corpus).repartition(3), NearDedup(block=block)).collect()}
    assert got == brute(corpus)


def test_chains_through_a_large_cluster(table, prose):
    """Neighbours in a chain link, its ends do not: whatever the leader, most members link over others."""
    base = prose(41, 150).split()
    docs = [(i, " ".join(f"c{j}" if j < 3 * i else w for j, w in enumerate(base))) for i in range(25)]
    docs += [(100 + i, " ".join(f"d{j}" if j >= 150 - 2 * i else w for j, w in enumerate(base))) for i in range(25)]
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(table(docs), NearDedup(block=3)).collect()}
    assert got == brute(docs)


def test_work_grows_with_a_group_of_near_copies(spark, table, prose):
    base = prose(77, 60).split()
    made = []
    for n in (300, 1200):
        docs = [(i, " ".join(f"n{i}" if j == (i * 11) % 60 else w for j, w in enumerate(base))) for i in range(n)]
        rows = []
        keep = near_dedup.links_of_block
        acc = spark.sparkContext.accumulator(0)
        near_dedup.links_of_block = lambda ids, *a, **k: (acc.add(len(ids)), keep(ids, *a, **k))[1]
        try:
            rows = near_duplicates(table(docs), NearDedup(block=30)).select("component_id").distinct().collect()
        finally:
            near_dedup.links_of_block = keep
        assert [r.component_id for r in rows] == [0]
        made.append(acc.value)
    assert made[1] <= 6 * max(made[0], 300)


def test_five_words_at_eighty_percent(table, corpus):
    p = NearDedup(shingle=5, threshold_percent=80, bands=40, rows=4, sketch_floor=0.45)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(table(corpus), p).collect()}
    assert got == brute(corpus, 5, 80)


def test_empty_null_ids_and_repeated_rows(table, prose):
    assert near_duplicates(table([])).collect() == []
    rows = near_duplicates(table([(None, prose(1, 30)), (None, prose(1, 30)), (4, prose(1, 30)), (4, prose(1, 30)), (9, prose(1, 30))])).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in rows if r.doc_id) == [(4, 4, True), (4, 4, True), (9, 4, False)]
    assert [(r.component_id, r.kept) for r in rows if r.doc_id is None] == [(None, True)] * 2


def test_drop_keeps_all_columns_and_one_of_each_group(table, corpus):
    df = table(corpus).selectExpr("*", "1 AS component_id", "2 AS kept")
    out = drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted(d for d, v in brute(corpus).items() if v[2])


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(100, 7), (200, 201), (201, 200), (5, 5), (None, 3)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(pairs, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 1, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "x long, y long"), "x", "y").collect() == []


def test_odd_sketches_tell_high_similarities(prose):
    rng = np.random.default_rng(2)
    p = NearDedup()
    for share in (0.8, 0.9, 0.97):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 2**63, 1000).astype(np.uint64)
            k = round(1000 * (1 - share) / (1 + share))
            a = np.concatenate([both[: 1000 - k], rng.integers(0, 2**63, k).astype(np.uint64)])
            b = np.concatenate([both[: 1000 - k], rng.integers(0, 2**63, k).astype(np.uint64)])
            s = odd_sketches(np.array([min_samples(a, p.samples), min_samples(b, p.samples)]), p.sketch_bits)
            z = int(np.bitwise_count(s[0] ^ s[1]).sum())
            errors.append(sketch_similarity(z, p.samples, p.sketch_bits) - share)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.06


def test_a_block_links_what_all_its_links_would():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(200) > 0.05], rng.integers(0, 2**63, int(rng.integers(0, 12))).astype(np.uint64)])) for _ in range(30)]
    p = NearDedup()
    sketches = np.ascontiguousarray(odd_sketches(np.array([min_samples(s, p.samples) for s in sets]), p.sketch_bits)).view(np.uint64)
    links = links_of_block(np.arange(30), sets, sketches, np.array([4]), p)
    up = list(range(30))
    for a in range(30):
        for b in range(a):
            k = len(np.intersect1d(sets[a], sets[b]))
            if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
                x, y = up[a], up[b]
                up = [y if u == x else u for u in up]
    down = list(range(30))
    for a, b in links:
        x, y = down[a], down[b]
        down = [y if u == x else u for u in down]
    assert len(set(up)) == len(set(down)) and len(links) < 30
