"""Every registered query against its DuckDB oracle on the sf0.001 tables.

Same comparison the driver makes: columns by sorted name, rows order-
insensitively; doubles compared to 9 significant digits.
"""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from marketlens import catalog, oracle
from marketlens.sources.testdata import BASE_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_key_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracle.all_sql())
    assert set(catalog.QUERIES) <= set(E.queries())
    assert len(catalog.QUERIES) == 69


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _canon(df.columns, df.collect()) == _canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "total_orders", "gross_revenue", "avg_order_value"]
    assert df.count() > 0
