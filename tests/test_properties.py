"""Random tables, offsets and strides against plain Python."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tidemark as tm

few = settings(
    max_examples=8,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)
# Narrow keys repeat, wide ones spread; both with missing values among them.
keys = st.one_of(st.none(), st.integers(-6, 6), st.integers(-(2**62), 2**62))
tables = st.lists(keys, min_size=1, max_size=40)
columns = st.sampled_from(["number", "moment"])


def frame(spark, table, column):
    rows = spark.createDataFrame(list(enumerate(table)), "id long, k long").repartition(3)
    if column == "moment":
        # Microseconds within a few centuries around 1970.
        rows = rows.withColumn("k", F.timestamp_micros(F.col("k") % 10**16))
    return rows


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@few
@given(table=tables, offset=st.integers(-10, 10), strides=st.integers(1, 20), column=columns)
@pytest.mark.parametrize("layout", ["scan", "stride"])
def test_increment_and_next_offset(spark, layout, table, offset, strides, column):
    rows = frame(spark, table, column)
    text = str(offset)
    if column == "moment":
        table = [None if v is None else (abs(v) % 10**16) * (1 if v > 0 else -1) for v in table]
        offset, text = offset * 10**6, f"1970-01-01 00:00:{offset:02}" if offset >= 0 else f"1969-12-31 23:59:{60 + offset}"
    load = tm.loader(spark).options(
        partitionColumn="k", offset=text, offsetZone="Z", numPartitions=strides, layout=layout
    )
    loaded = load.load(rows)
    assert ids(loaded.df) == [i for i, v in enumerate(table) if v is not None and v > offset]
    assert ids(load.option("offset", loaded.next_offset).load(rows).df) == []


@few
@given(table=tables, strides=st.integers(1, 20), rows_each=st.integers(1, 9), column=columns)
def test_full_load_in_strides_is_the_whole_table(spark, table, strides, rows_each, column):
    load = tm.loader(spark).options(
        loadType="full", partitionColumn="k", numPartitions=strides, layout="stride", maxPartitionRows=rows_each
    )
    loaded = load.load(frame(spark, table, column))
    assert ids(loaded.df) == list(range(len(table)))
    if loaded.strides is not None:
        mixed = loaded.df.groupBy(F.spark_partition_id()).agg(
            F.count_distinct(tm.stride_id(loaded.strides)).alias("strides")
        )
        assert mixed.where("strides > 1").count() == 0


@few
@given(
    table=st.lists(
        st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 3))),
        max_size=30,
    )
)
def test_dedup(spark, table):
    rows = spark.createDataFrame(table, "id long, seen long, v long").repartition(4)
    rank = lambda r: tuple((x is not None, x) for x in r[1:])
    best = {}
    for row in table:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    latest = {tuple(r) for r in tm.dedup_latest(rows, ["id"], "seen").collect()}
    assert latest == set(best.values())
    survivors = [tuple(r) for r in tm.dedup_any(rows, ["id"]).collect()]
    assert set(survivors) <= set(table) and sorted(r[0] for r in survivors) == sorted(best)
    check = tm.key_check(rows, ["id"]).first()
    assert check.surplus_rows == len(table) - len(best) and check.is_key == (len(table) == len(best))
