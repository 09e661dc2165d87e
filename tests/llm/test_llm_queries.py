import os

import pytest

from stemma.llm import queries

D = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_runs(spark, name):
    df = queries.QUERIES[name](spark, D)
    rows = df.collect()
    assert len(rows) == len(set(map(str, rows)))
