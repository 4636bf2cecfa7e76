import os

import pytest
from compare import FOLDER, both

from weftline.plans import file_queries, oracle, queries

QUERIES, SQL = {**queries.QUERIES, **file_queries.QUERIES}, {**oracle.SQL, **file_queries.SQL}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    got, want = both(spark, QUERIES[name], SQL[name])
    assert got == want
