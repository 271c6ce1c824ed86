"""Driver contract: entry() smoke, registry shape, oracle agreement at sf0.001."""

import decimal
import hashlib

import duckdb
import pytest

import __spark_entry__ as entry
from marketflow.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = ["part", "lineitem", "orders", "events"]

def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["item_id", "item_name", "buy_limit"]
    assert df.count() >= 0


def test_every_query_has_oracle_sql():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog.QUERIES) <= set(entry.oracle_sql())


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


def _digest(rows):
    return sorted(hashlib.sha1(repr(r).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF)
    cols = sorted(sdf.columns)
    srows = [tuple(_norm(r[c]) if r[c] is not None else None for c in cols) for r in sdf.collect()]
    res = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = [tuple(_norm(r[i]) if r[i] is not None else None for i in idx) for r in res.fetchall()]
    assert len(srows) == len(orows)
    assert _digest(srows) == _digest(orows)
