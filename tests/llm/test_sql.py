"""Every query of the subpackage with an SQL counterpart, row by row, on the smallest tables."""

import glob

import duckdb
import pytest

from checks.compare import table
from siteplan.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"create view {p.rsplit('/', 1)[1][:-8]} as select * from '{p}'")
    df = queries.QUERIES[name](spark, FOLDER)
    rel = con.sql(queries.SQL[name])
    assert table(df.columns, [tuple(r) for r in df.collect()]) == table(rel.columns, rel.fetchall())
