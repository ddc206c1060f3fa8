"""Every registered query against its DuckDB oracle (the driver's gate) at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["GEOniv", "Value"]


@pytest.mark.parametrize("key", sorted(E.queries()))
def test_query_matches_oracle(spark, con, key):
    if key not in E.oracle_sql():
        pytest.skip("no oracle; tested against brute force")
    sdf = E.queries()[key](spark, SF)
    cols = sorted(sdf.columns)
    srows = sorted(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
    res = con.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert srows == drows
