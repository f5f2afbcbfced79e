"""Queries against their SQL in DuckDB, on two sizes of the test tables."""

import duckdb
import pytest

from tidemark.llm import queries

TABLES = "documents embeddings labels".split()


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query(spark, name, size):
    d = f"/root/testdata/{size}"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{d}/{t}.parquet'")
    got = queries.queries()[name](spark, d).toArrow()
    want = con.sql(queries.oracle_sql()[name]).to_arrow_table()
    cols = sorted(got.column_names)
    assert cols == sorted(want.column_names)
    rows = lambda t: sorted(tuple(map(str, r)) for r in zip(*[t.column(c).to_pylist() for c in cols]))
    assert len(rows(got)) > 0 and rows(got) == rows(want)
