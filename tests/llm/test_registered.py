"""The registered queries themselves: against DuckDB where there is SQL, else their columns and rows."""

import duckdb
import pytest

from obslog.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op2_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op3_histogram_sort_shards": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op7_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op8_quality_classifier": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op13_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    result = duck.execute(ORACLE_SQL[name])
    order = sorted(d[0] for d in result.description)
    assert sorted(got.columns) == order
    at = [[d[0] for d in result.description].index(c) for c in order]
    want = [tuple(row[i] for i in at) for row in result.fetchall()]
    assert sorted(map(tuple, got.select(*order).collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_per_document(spark, name):
    out = QUERIES[name](spark, SF)
    assert dict(out.dtypes) == COLUMNS[name]
    ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(r.doc_id for r in ids)


def test_mixed_and_leaking_rows_are_of_the_tables(spark):
    ids = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    items = {r.item_id for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id").collect()}
    assert {r.doc_id for r in QUERIES["op9_poisson_mixing"](spark, SF).collect()} <= ids
    leaks = QUERIES["op10_decontamination"](spark, SF).collect()
    assert leaks and {r.doc_id for r in leaks} <= ids and {r.item_id for r in leaks} <= items
