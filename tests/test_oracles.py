"""Every registered query against its DuckDB oracle (the driver's check),
on the smallest scale factor; plus a rows-only run of the others."""

import math

import duckdb
import pytest

from quire.plans.catalog import ORACLES, QUERIES
from quire.sources.tables import TABLES

from conftest import SF_SMALL


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return round(v, 4)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = df.collect()
    cur = duck.execute(ORACLES[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    order = sorted(cols)
    a = sorted((tuple(_norm(r[cols.index(c)]) for c in order) for r in rows), key=repr)
    b = sorted((tuple(_norm(r[dcols.index(c)]) for c in order) for r in drows), key=repr)
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.count() >= 0
    assert len(df.columns) > 0
