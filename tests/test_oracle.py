"""Every registered query against the SQL that checks it, on the same files."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

PART = registry.training_data  # tested in tests/llm
OTHERS = set(PART.queries()) if PART else set()
QUERIES = {k: q for k, q in registry.queries().items() if k not in OTHERS}
ORACLE = {k: q for k, q in registry.oracle_sql().items() if k not in OTHERS}

SAME_TYPE = {
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    yield connection
    connection.close()


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, v) for v in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_oracle(spark, sf_dir, oracle, name):
    result = QUERIES[name](spark, sf_dir)
    expected = oracle.sql(ORACLE[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    types = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SAME_TYPE[t] for c, t in result.dtypes} == types

    got = [tuple(row[c] for c in columns) for row in result.collect()]
    order = ", ".join(f'"{c}"' for c in columns)
    want = oracle.sql(f"SELECT {order} FROM ({ORACLE[name]})").fetchall()
    assert _sorted(got) == _sorted(want)


def test_entry(spark):
    result = registry.entry(spark)
    assert result.columns == ["event_id", "ts", "user_id", "event_type", "value", "props"]
    assert result.count() == 692
