"""Every query of the core on the smallest tables, against its oracle where it has one."""

import math
import os

import duckdb
import pytest

from terrane.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(DIR):
        c.execute(f"create view {f[:-8]} as select * from '{DIR}/{f}'")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str([norm(x) for x in v]) if isinstance(v, (list, tuple)) else str(v)


@pytest.mark.parametrize("name", list(catalogue.QUERIES))
def test_query(spark, con, name):
    df = catalogue.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    rows = sorted(tuple(norm(r[c]) for c in cols) for r in df.collect())
    if name in catalogue.ORACLES:
        cur = con.execute(catalogue.ORACLES[name])
        names = [x[0] for x in cur.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        assert rows == sorted(tuple(norm(r[i]) for i in at) for r in cur.fetchall())
