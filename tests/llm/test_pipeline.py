import random
import re

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage."""
    from obslog.llm.common import cut, documents

    docs = documents(spark, SF)
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, SF))
        out.append((name, docs))
    return dict(out)


def test_columns_and_order(stages):
    names = ["language_id", "near_dedup", "decontamination", "mixing", "sharding"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    columns = stages["documents"].columns
    assert all(stages[n].columns == columns for n in names[:-1])
    assert stages["sharding"].columns[: len(columns)] == columns and {"shard", "slot", "size"} <= set(stages["sharding"].columns)


def test_language_keeps_clean_documents(stages):
    before, after = ({r.doc_id for r in stages[n].collect()} for n in ("documents", "language_id"))
    assert after <= before and len(after) >= 0.98 * len(before)


def test_near_dedup_equals_brute_force(stages):
    docs = {r.doc_id: r.text for r in stages["language_id"].collect()}
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for d, t in docs.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate(lower))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    up = {d: d for d in sets}

    def find(d):
        while up[d] != d:
            d = up[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                up[y] = x
    assert {r.doc_id for r in stages["near_dedup"].collect()} == {d for d in ids if find(d) == d}


def test_leaks_go_and_clean_documents_stay(spark, stages):
    items = [" ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", r.text.lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = {r.doc_id: " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", r.text.lower())) for r in stages["near_dedup"].collect()}
    after = {r.doc_id for r in stages["decontamination"].collect()}
    holds = {d for d, t in before.items() if any(i in t for i in items)}
    assert holds and not holds & after
    shares = lambda d: any(" ".join(w[k : k + 5]) in before[d] for i in items for w in [i.split()] for k in range(len(w) - 4))
    assert all(d in after for d in before if not shares(d))


def test_mix_and_shards(stages):
    kept = {r.doc_id for r in stages["decontamination"].collect()}
    mixed = [r.doc_id for r in stages["mixing"].collect()]
    assert set(mixed) <= kept and 0.5 * len(kept) < len(mixed) < 1.7 * len(kept)
    rows = stages["sharding"].collect()
    assert sorted(r.doc_id for r in rows) == sorted(mixed)
    for s in range(8):
        slots = sorted(r.slot for r in rows if r.shard == s)
        assert slots == list(range(len(slots)))


def test_odd_rows_pass_through_all_stages(spark, prose, tmp_path):
    rng = random.Random(0)
    rows = [(i, prose(i, 40), "en" if i % 2 else "fr", rng.choice(["a", "b", None]), 5) for i in range(80)]
    rows += [(None, prose(500, 40), "en", "a", 1), (90, None, None, None, None), (91, "", "en", "a", 0), (92, "123 !!", "en", "a", 6), (93, rows[0][1], "fr", "a", 1), (1, rows[1][1], "en", "b", 5), (94, prose(7, 30000), "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 AS shard", "2 AS score", "3 AS replica", "4 AS component_id")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, prose(3, 20)), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {r.doc_id for r in out}
    assert not ids & {90, 91, 92, 93, 3} and len(ids) > 40 and out[0].component_id == 4


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
