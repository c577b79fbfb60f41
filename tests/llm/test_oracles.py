"""Queries that SQL can express agree with DuckDB on all rows."""

import duckdb
import pytest

from runsight.llm.queries import ORACLE, QUERIES
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle_pair(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cur.fetchall())


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
