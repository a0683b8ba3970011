"""Driver contract: entry runs on sf0.001, every query of the inventory has an oracle and equals
it on sf0.001."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from filament.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "event_time" in df.columns and "_etl_record_id" in df.columns


def test_registry_complete():
    assert set(catalog.QUERIES) == set(catalog.ORACLES) and len(catalog.QUERIES) >= 50
    assert set(catalog.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("events", "customer", "orders", "lineitem", "nation", "documents"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    rel = con.sql(E.oracle_sql()[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    a = sorted(tuple(str(r[c]) for c in cols) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    b = sorted(tuple(str(row[i]) for i in idx) for row in rel.fetchall())
    assert a == b
