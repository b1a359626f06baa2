"""Every query with an SQL counterpart, row by row, on the smallest tables."""

import glob

import duckdb
import pytest

from checks import REGISTRY
from checks.base import Tables
from checks.compare import table

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"create view {p.rsplit('/', 1)[1][:-8]} as select * from '{p}'")
    return c


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql is not None])
def test_query(spark, con, name):
    q = REGISTRY[name]
    df = q.run(Tables(spark, FOLDER))
    rel = con.sql(q.sql)
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(rel.columns, rel.fetchall())
