"""Plans: what is read, what is pushed down, and what is shuffled."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import tidemark as tm


SHOWN = {}


@pytest.fixture
def plan(spark, sf_dir, capsys):
    def explain(df):
        capsys.readouterr()
        df.explain("formatted")
        return capsys.readouterr().out

    def show(shown):
        if not isinstance(shown, str):
            return explain(shown)
        if shown not in SHOWN:
            SHOWN[shown] = explain(registry.queries()[shown](spark, sf_dir))
        return SHOWN[shown]

    return show


def shuffles(text):
    """Exchanges in the tree at the head of a formatted plan."""
    tree = text.split("\n\n\n")[0]
    return tree.count("Exchange")


@pytest.mark.parametrize(
    "query, columns",
    [
        ("incr_pushdown", "event_id:bigint,ts:timestamp_ntz,event_type:string,value:double"),
        ("incr_empty_count", "ts:timestamp_ntz"),
        ("range_full", "o_orderkey:bigint"),
        ("range_filtered", "o_totalprice:double,o_orderdate:timestamp_ntz"),
        ("next_offset", "ts:timestamp_ntz"),
        ("stride_numeric", "o_orderkey:bigint"),
        ("stride_predicates", "o_orderkey:bigint"),
        ("record_count", "l_quantity:double"),
        ("avg_row_size", "o_orderstatus:string,o_orderpriority:string"),
        ("key_check", "l_orderkey:bigint,l_linenumber:int"),
    ],
)
def test_only_needed_columns_are_read(plan, query, columns):
    assert f"ReadSchema: struct<{columns}>" in plan(query)


@pytest.mark.parametrize(
    "query, pushed",
    [
        ("incr_numeric", "GreaterThan(o_orderkey,2000)"),
        ("incr_timestamp", "GreaterThan(ts,2024-01-10T00:00)"),
        ("incr_timestamp_t", "GreaterThan(ts,2024-01-15T12:00)"),
        ("incr_date", "GreaterThanOrEqual(o_orderdate,1998-07-01T00:00)"),
        ("incr_pushdown", "EqualTo(event_type,click)"),
        ("range_filtered", "GreaterThan(o_totalprice,250000.0)"),
        ("incr_dedup", "GreaterThan(l_shipdate,1998-01-01T00:00)"),
        ("stride_timestamp", "GreaterThan(ts,2024-01-10T00:00)"),
    ],
)
def test_filters_reach_the_scan(plan, query, pushed):
    assert pushed in plan(query)


@pytest.mark.parametrize(
    "query, count",
    [
        ("full_scan", 0),
        ("bootstrap_scan", 0),
        ("incr_numeric", 0),
        ("incr_timestamp", 0),
        ("incr_chain", 0),
        ("base64_binary", 0),
        ("normalise_timestamps", 0),
        ("range_full", 1),
        ("stride_numeric", 1),
        ("field_profile", 1),
        ("dedup_latest", 1),
        ("full_ranged", 1),
        ("key_check", 2),
    ],
)
def test_shuffles(plan, query, count):
    assert shuffles(plan(query)) == count


PART = registry.training_data  # its operators are free to use Python


@pytest.mark.parametrize("query", sorted({*registry.queries()} - {*(PART.queries() if PART else ())}))
def test_no_python_in_any_plan(plan, query):
    text = plan(query)
    for slow in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert slow not in text


def test_dedup_of_a_table_bucketed_by_key_does_not_shuffle(spark, plan, tmp_path):
    name = f"bucketed_{uuid.uuid4().hex}"
    rows = spark.range(1000).selectExpr("id % 100 AS key", "id AS seen", "CAST(id AS string) AS note")
    rows.write.bucketBy(4, "key").option("path", str(tmp_path / name)).saveAsTable(name)
    try:
        load = tm.loader(spark).options(dbtable=name, partitionColumn="seen", offset="500")
        latest = load.load_deduplicated(["key"])
        assert shuffles(plan(latest.df)) == 0
        assert latest.df.agg(F.count("*"), F.min("seen")).first() == (100, 900)
        any_row = load.load_deduplicated(["key"], keep="any")
        assert shuffles(plan(any_row.df)) == 0 and any_row.df.count() == 100
    finally:
        spark.sql(f"DROP TABLE {name}")
