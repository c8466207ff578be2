"""Queries against the SQL that checks them, on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from tidemark.llm import queries as part

QUERIES, ORACLE = part.queries(), part.oracle_sql()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def test_registry():
    assert len([q for q in QUERIES if q.startswith("op")]) == 13 and "pipeline" in QUERIES
    assert set(ORACLE) <= set(QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", ORACLE)
def test_query_matches_oracle(spark, sf_dir, oracle, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    got = sorted(tuple(r[c] for c in columns) for r in result.collect())
    order = ", ".join(columns)
    want = sorted(oracle.sql(f"SELECT {order} FROM ({ORACLE[name]})").fetchall())
    assert got == want
