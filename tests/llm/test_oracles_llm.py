"""Queries that SQL can express, against DuckDB on sf0.001."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_SMALL

sys.path.insert(0, os.path.join(ROOT, "tools"))
from check_oracles import _rows  # noqa: E402
from touchline.llm.queries import llm_oracles, llm_queries  # noqa: E402
from touchline.sources.tables import DRIVER_TABLES  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_matches_sql(spark, duck, name):
    df = llm_queries()[name](spark, SF_SMALL)
    rel = duck.sql(llm_oracles()[name])
    rows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, rows) == _rows(rel.columns, rel.fetchall())


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in llm_queries()) == list(range(1, 14))
