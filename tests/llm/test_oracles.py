"""Every query with SQL against DuckDB, on the shared tables."""

from __future__ import annotations

import glob
import os

import pytest

from gridsky.llm.queries import all_oracles, all_queries

SF = os.environ.get("GRIDSKY_TEST_SF", "/root/testdata/sf0.01")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="shared tables not present")


def test_one_query_for_each_operator():
    names = list(all_queries())
    assert [n.split("_")[0] for n in names] == [f"op{k}" for k in range(1, 14)]


@pytest.mark.parametrize("name", sorted(all_oracles()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    want = con.execute(all_oracles()[name])
    columns = sorted(c[0] for c in want.description)
    place = [[c[0] for c in want.description].index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())
    got = all_queries()[name](spark, SF)
    assert sorted(got.columns) == columns
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == expected
