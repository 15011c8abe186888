"""Queries with SQL give what DuckDB gives, and every query gives a row for what it is asked about."""

import duckdb
import pytest

from statewise.llm.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=str)
    want = con.sql(SQL[name])
    at = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
    assert got


@pytest.mark.parametrize("name", ["op2_toxicity", "op3_lm_score", "op5_shard_by_bytes", "op8_fingerprints"])
def test_one_row_for_every_document(spark, name):
    ids = sorted(r.doc_id for r in QUERIES[name](spark, SF_DIR).select("doc_id").collect())
    assert ids == sorted(r.doc_id for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect())
