import random
import re

import numpy as np
import pyarrow as pa
import pytest

from obslog.llm.decontaminate import Decontamination, ItemIndex, drop_leaking, find_leaks, item_indexes

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
UPPER = {v: k for k, v in LOWER.items()}


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").translate(LOWER))


def brute(docs, items, n=5, t=0.8):
    """The best weighted containment of each item in any window of its size."""
    grams = lambda w: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}
    sets = {i: grams(words(x)) for i, x in items if words(x)}
    weight = {g: np.log1p(len(sets) / sum(g in s for s in sets.values())) for s in sets.values() for g in s}
    out = {}
    for d, text in docs:
        w = words(text)
        for i, x in items:
            k = len(words(x))
            if not k:
                continue
            total = sum(weight[g] for g in sets[i])
            best = max((sum(weight[g] for g in grams(w[a : a + k]) & sets[i]) / total for a in range(max(1, len(w) - k + 1))), default=0)
            if best >= t - 1e-9:
                out[d, i] = round(best, 9)
    return out


@pytest.fixture(scope="module")
def items(prose):
    return [(i, prose(5000 + i, 15 + i)) for i in range(30)] + [(40, "Tiny item"), (41, "Élan, vital!"), (42, ""), (43, None)]


@pytest.fixture(scope="module")
def corpus(prose, items):
    docs = [(i, prose(6000 + i, 80)) for i in range(20)]
    docs += [(100 + i, f"{prose(i, 20)} {items[i][1].translate(UPPER)}, {prose(i + 50, 20)}") for i in range(30)]
    docs += [(200 + i, f"{prose(i, 20)} {' '.join(w if j != 12 else 'changed' for j, w in enumerate(items[i][1].split()))} {prose(i + 50, 9)}") for i in range(30)]
    docs += [(300 + i, f"{prose(i, 9)} {' '.join(items[i][1].split()[: 8 + i // 2])} {prose(i + 50, 9)}") for i in range(30)]
    docs += [(500 + i, f"{prose(i, 9)} {' '.join(items[i][1].split()[: -max(1, (11 + i) // 6)])} {prose(i + 50, 9)}") for i in range(30)]
    docs += [(600 + i, f"{prose(i, 9)} {' '.join(items[i][1].split()[max(1, (11 + i) // 8) :])} {prose(i + 50, 9)}") for i in range(30)]
    docs += [(700 + i, " ".join(items[i][1].split()[: -max(1, (11 + i) // 7)])) for i in range(30)]
    docs += [(400, "a tiny item here"), (401, "élan vital"), (402, ""), (403, None), (404, "tiny"), (405, items[3][1] + " " + items[3][1] + " " + items[4][1])]
    return docs


def test_equals_brute_force(spark, table, corpus, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in find_leaks(table(corpus), bench).collect()}
    want = brute(corpus, items)
    assert got == want
    assert {d for d, _ in want} >= {100 + i for i in range(30)} and not {d for d, _ in want} & set(range(20))


@pytest.mark.parametrize("block", [6, 512])
def test_item_blocks_change_nothing(spark, table, corpus, items, block):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in find_leaks(table(corpus), bench, Decontamination(items_a_block=block)).collect()}
    assert got == brute(corpus, items)


def test_one_read_of_the_documents(spark, table, corpus, items):
    bench = spark.createDataFrame([(100 * k + i, t) for k in range(40) for i, t in items], "item_id long, text string")
    out = find_leaks(table(corpus), bench)
    assert out._jdf.queryExecution().analyzed().toString().count("MapInArrow") == 1


@pytest.mark.parametrize("block", [512, 60])
def test_a_shared_opening_equals_brute_force(spark, table, prose, block):
    opening = prose(9000, 20)
    shared = [(i, f"{opening} {prose(9100 + i, 30)}") for i in range(200)]
    docs = [(i, " ".join([*prose(9300 + i, 21).split(), *x.split()[20:], *prose(9500 + i, 1).split()])) for i, x in shared[:40]]
    bench = spark.createDataFrame(shared, "item_id long, text string")
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in find_leaks(table(docs), bench, Decontamination(items_a_block=block)).collect()}
    want = brute(docs, shared)
    assert got == want and set(want) >= {(i, i) for i in range(40)}
    assert drop_leaking(table(docs), bench, Decontamination(items_a_block=block)).count() == 0


def test_drop_keeps_columns_and_clean_rows(spark, table, corpus, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = table(corpus).selectExpr("*", "1 AS item_id", "2 AS similarity")
    out = drop_leaking(df, bench)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == sorted({d for d, _ in corpus} - {d for d, _ in brute(corpus, items)})


def test_empty_tables_and_nulls(spark, table, corpus, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(table(corpus), none).collect() == [] and drop_leaking(table(corpus), none).count() == len(corpus)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert find_leaks(table([]), bench).collect() == []
    rows = find_leaks(table([(None, items[0][1]), (1, items[0][1]), (1, items[0][1])]), bench).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 0), (1, 0), (1, 0)]


def test_no_fingerprint_within_the_radius_is_missed(prose):
    p = Decontamination()
    index = ItemIndex([(i, prose(i, 30)) for i in range(50)], p)
    rng = np.random.default_rng(0)
    for i in range(50):
        bits = np.unpackbits(index.prints[i].astype(">u2").view(np.uint8))
        bits[rng.choice(128, p.radius, replace=False)] ^= 1
        row, item, distance = index.near(np.packbits(bits).view(">u2").astype(np.int64)[None], 30)
        assert (i, p.radius) in set(zip(item.tolist(), distance.tolist(), strict=True))


def test_a_large_index_finds_what_a_scan_finds(prose):
    p = Decontamination()
    index = ItemIndex([(i, prose(i, 12)) for i in range(4000)], p)
    assert min(len(patterns) for patterns, _, _ in index.tables[12]) > len(index.nearby)
    rng = np.random.default_rng(1)
    bits = np.unpackbits(index.prints[:40].astype(">u2").view(np.uint8), axis=1)
    bits ^= (rng.random(bits.shape) < 0.25).astype(np.uint8)
    prints = np.packbits(bits, axis=1).view(">u2").astype(np.int64)
    row, item, distance = index.near(prints, 12)
    all_ = np.bitwise_count(prints[:, None] ^ index.prints).sum(axis=2)
    assert set(zip(row.tolist(), item.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(all_ <= p.radius)), strict=True)) and len(row)


def test_a_long_text_that_repeats_an_item_takes_little_memory():
    """Memory goes with the words and not with item width times places; a part-leaked item after it is still found."""
    import tracemalloc

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(7))
    item, other = [word() for _ in range(200)], [word() for _ in range(200)]
    index = ItemIndex([(1, " ".join(item)), (2, " ".join(other))], Decontamination())
    partly = other[:190] + [word() for _ in range(10)]
    text = " ".join(item * 1000 + [word() for _ in range(500)] + partly + item * 100)
    tracemalloc.start()
    (found,) = index.search(pa.array([text]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    best = {index.ids[i]: (start, n, similarity) for i, start, n, _, similarity in found[1]}
    assert best[1] == (0, 200, 1.0) and abs(best[2][0] - 200_500) <= 12 and 0.8 <= best[2][2] < 1


def test_blocks_of_items_are_cut_by_bytes(spark):
    items = spark.createDataFrame([(i, f"item {i} " + " ".join(f"w{i}x{j}" for j in range(40))) for i in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"before item {i} " + " ".join(f"w{i}x{j}" for j in range(40)) + " after") for i in range(0, 30, 3)], "doc_id long, text string")
    blocks = list(item_indexes(items, Decontamination(bytes_a_block=2000)))
    assert len(blocks) >= 4 and sum(len(b.ids) for b in blocks) == 30
    one, many = (sorted(map(tuple, find_leaks(docs, items, p).collect())) for p in (Decontamination(), Decontamination(bytes_a_block=2000)))
    assert one == many and [r[0] for r in one] == list(range(0, 30, 3))
