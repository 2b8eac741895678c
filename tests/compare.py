"""A query's rows against its SQL's, as the driver compares them."""

import os

import pytest

DATA = os.environ.get("TIDEMILL_TESTDATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="the test tables are not here")


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


def agree(spark, query, sql):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    got = query(spark, DATA)
    names = sorted(got.columns)
    found = con.execute(sql)
    theirs = [d[0] for d in found.description]
    assert sorted(theirs) == names
    at = [theirs.index(c) for c in names]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=str)
    assert sorted((tuple(plain(r[c]) for c in names) for r in got.collect()), key=str) == want
