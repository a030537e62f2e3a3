import hashlib
import random

import numpy as np
import pytest

from obslog.llm.repeats import Repeats, longest_previous_factors, remove_repeats, sliding_minimum


def brute(docs, length=100):
    seen, out = {}, {}
    for doc, text in sorted(docs, key=lambda r: (r[0] is not None, r[0])):
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if seen.setdefault(w, (doc, i)) != (doc, i):
                gone[i : i + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[doc] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df, **k):
    return {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in remove_repeats(df, Repeats(**k)).collect()}


@pytest.fixture(scope="module")
def corpus(prose):
    passage, line = prose(1, 40), prose(2, 14)
    docs = [(i, prose(100 + i, 60)) for i in range(12)]
    docs += [(20 + i, f"{prose(200 + i, 20)} {passage} {prose(300 + i, 20)}") for i in range(30)]
    docs += [(60 + i, f"{line} {line} {prose(400 + i, 30)}") for i in range(30)]
    docs += [(100, "a" * 1000), (101, "ab" * 300), (102, "a" * 99), (103, "a" * 100), (104, ""), (105, None), (106, docs[3][1]), (107, docs[3][1]), (108, docs[3][1][:-1])]
    docs += [(110, (prose(9, 30) + "é") * 5), (111, "\0" * 300), (112, passage[1:] + passage)]
    return docs


@pytest.mark.parametrize("options", [{}, {"local_contexts": 2, "bucket_rows": 3, "chunk_windows": 50, "task_bytes": 1000}, {"bucket_rows": 1, "widths": (5, 1)}, {"bucket_rows": 1, "widths": (1,)}])
def test_equals_brute_force(table, corpus, options):
    assert found(table(corpus).repartition(5), **options) == brute(corpus)


def test_empty_null_and_repeated_rows(spark, table):
    assert remove_repeats(table([])).collect() == []
    text = "x1y2" * 10 + "q" * 120
    rows = remove_repeats(table([(None, text), (5, text), (5, text), (7, None)])).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed) for r in rows)
    assert got[0][:2] == (False, 0) and got[0][2] < len(text)
    assert [g[2] for g in got[1:3]] == [len(text)] * 2 and got[3][2] == 0


def test_many_near_copies(table, prose):
    base = prose(70, 120).split()
    docs = []
    for i in range(400):
        w = list(base)
        for j in range(i % 5):
            w[(i * 7 + j * 31) % len(w)] = f"w{i}x{j}"
        docs.append((i, " ".join(w)))
    assert found(table(docs).repartition(6), bucket_rows=20, local_contexts=2) == brute(docs)


def test_different_texts_of_one_id_and_of_null_ids(table, prose):
    passage = prose(3, 60)
    texts = [f"{prose(10 + i, 20)} {passage}" for i in range(6)]
    rows = remove_repeats(table([(None, texts[0]), (None, texts[1]), (4, texts[2]), (4, texts[3]), (4, texts[3]), (4, "x"), (9, texts[4])]), Repeats(bucket_rows=1)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r.n_removed)
    assert len(rows) == 7 and sorted(by[None])[0] == 0 and sorted(by[None])[1] >= len(passage.encode())
    assert sorted(x > 0 for x in by[4]) == [False, True, True, True] and by[9][0] >= len(passage.encode())


def test_other_columns_are_not_read(table, corpus):
    df = table(corpus[:5]).selectExpr("*", "1 AS kept", "2 AS spans", "3 AS bucket", "4 AS doc")
    assert found(df) == brute(corpus[:5])


def test_kernels():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 9, 50).astype(np.uint64)
    assert sliding_minimum(x, 7).tolist() == [x[i : i + 7].min() for i in range(44)]
    for _ in range(50):
        text = "".join(random.choice("ab") for _ in range(30))
        order = sorted(range(30), key=lambda i: text[i:])
        common = lambda a, b: next((k for k in range(31) if text[a : a + k + 1] != text[b : b + k + 1] or max(a, b) + k >= 30), 0)
        lcp = np.array([0] + [common(order[r - 1], order[r]) for r in range(1, 30)])
        lpf = longest_previous_factors(np.array(order), lcp, 1)
        for r, i in enumerate(order):
            assert lpf[r] == max([common(i, j) for j in range(i)], default=0)
