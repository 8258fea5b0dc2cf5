"""Every query with SQL against DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from strandlake.catalog import all_queries, all_sql

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.skipif(not SF.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    got = all_queries()[name](spark, str(SF))
    rows = [tuple(r) for r in got.select(*sorted(got.columns)).collect()]
    if name not in all_sql():
        assert rows
        return
    want = duck.execute(all_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    order = sorted(range(len(columns)), key=columns.__getitem__)
    assert sorted(map(repr, rows)) == sorted(repr(tuple(r[i] for i in order)) for r in want.fetchall())
