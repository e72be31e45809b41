"""Driver contract: entry() runs, every query has a callable, every oracle
has a query; a few queries are checked against DuckDB end to end."""
import duckdb
import pytest

import __spark_entry__ as E

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "embeddings"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "high_severity" in df.columns


def test_registry_consistent():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 150


@pytest.mark.parametrize("name", ["rate_by_hour", "within_buffer", "roc_auc", "stratified_split", "dbscan"])
def test_against_duckdb(spark, name):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{d}/{t}.parquet')")
    cur = con.execute(E.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    exp = sorted(tuple(str(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in cur.fetchall())
    df = E.queries()[name](spark, d).select(*cols)
    got = sorted(tuple(str(round(v, 6)) if isinstance(v, float) else str(v) for v in r) for r in df.collect())
    assert got == exp
