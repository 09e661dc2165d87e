"""Every query with SQL against that SQL on the smallest tables."""

import glob
import math
import os

import pytest

from stemma.plans import data_queries, graph_queries, text_queries

D = "/root/testdata/sf0.001"
MODULES = (data_queries, text_queries, graph_queries)
ALL = {k: f for m in MODULES for k, f in m.QUERIES.items()}
SQL = {k: q for m in MODULES for k, q in m.SQL.items()}
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v.isoformat() if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in glob.glob(f"{D}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(ALL))
def test_query(spark, duck, name):
    df = ALL[name](spark, D)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in SQL:
        q = duck.execute(SQL[name])
        names = [x[0] for x in q.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert got == sorted((tuple(norm(r[i]) for i in at) for r in q.fetchall()), key=repr)


def test_flagship(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
