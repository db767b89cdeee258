"""Every registered query with an oracle agrees with DuckDB on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from geoscore.sources.testdata import TABLES

from conftest import SF_SMALL

ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9) + 0.0
        return v
    out = [tuple(n(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(ORACLES[name])
    dcols = [c[0] for c in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _norm([tuple(r) for r in df.collect()], df.columns) == _norm(res.fetchall(), dcols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns[0] == "wk"


def test_every_query_has_a_callable():
    q = E.queries()
    assert set(ORACLES) <= set(q)
    assert len(q) >= 40
