"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import duckdb
import pytest

from statewise.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=str)
    want = db.sql(SQL[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(want.columns) == columns
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=str)
    assert got


def test_fitted_policy_beats_the_largest_class(spark):
    row = QUERIES["policy_fit"](spark, SF_DIR).first()
    classes = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").groupBy("label").count()
    largest = classes.agg({"count": "max"}).first()[0]
    assert row.accuracy_percent > 100 * largest / row.n
    assert QUERIES["policy_score"](spark, SF_DIR).count() == row.n
