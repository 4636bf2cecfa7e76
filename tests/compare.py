"""A query's rows next to its SQL's over the smallest given tables."""

import math
import os

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if hasattr(v, "item"):
        v = v.item()
    return "" if v is None or (isinstance(v, float) and math.isnan(v)) else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


def both(spark, query, sql):
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        path = f"{FOLDER}/{name}"
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    rel = con.sql(sql)
    order = sorted(rel.columns)
    want = sorted(tuple(plain(v) for v in r) for r in con.sql(f"select {', '.join(order)} from rel").fetchall())
    got = query(spark, FOLDER)
    assert sorted(got.columns) == order
    return sorted(tuple(plain(v) for v in r) for r in got.select(*order).collect()), want
