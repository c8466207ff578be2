"""Stride plans: bounds, the row-level form, and the SQL text."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidemark as tm
from tidemark.functions.types import axis_text
from tidemark.plans.ranges import ColumnRange

LONG, DATE, NTZ, ZONED = T.LongType(), T.DateType(), T.TimestampNTZType(), T.TimestampType()
SECOND = 1_000_000


def found(low, high, dtype=LONG):
    return ColumnRange("k", dtype, low, high, None, None if high is None else str(high))


def test_narrow_range():
    plan = tm.plan_strides(found(1, 5), 100)
    assert plan.bounds() == [(1, 2), (2, 3), (3, 4), (4, 5)]


def test_remainder_goes_to_the_last_stride():
    plan = tm.plan_strides(found(0, 199), 100)
    assert (plan.count, plan.step, plan.bounds()[-1]) == (100, 1, (99, 199))


def test_single_value_and_empty_range():
    assert tm.plan_strides(found(7, 7), 100).count == 1
    assert tm.plan_strides(found(None, None), 100) is None


def test_bad_plans():
    with pytest.raises(tm.OptionError):
        tm.plan_strides(found(1, 5), 0)
    with pytest.raises(tm.OptionError):
        tm.plan_strides(found(5, 1), 3)


@pytest.mark.parametrize("dtype", [NTZ, ZONED])
def test_timestamps_step_by_whole_seconds(dtype):
    plan = tm.plan_strides(found(250_000, 25 * SECOND + 1, dtype), 10)
    assert (plan.count, plan.step) == (10, 2 * SECOND)
    assert plan.bounds()[1] == (2 * SECOND + 250_000, 4 * SECOND + 250_000)
    assert plan.bounds()[-1][1] == 25 * SECOND + 1
    assert tm.plan_strides(found(0, 9 * SECOND, dtype), 10).count == 1


def test_step_counts_seconds_of_the_clock():
    # 0.9 s to 2.1 s is one second apart in length but two on the clock.
    assert tm.plan_strides(found(900_000, 2_100_000, NTZ), 2).step == SECOND


@settings(max_examples=500, deadline=None)
@given(st.integers(-(2**70), 2**70), st.integers(0, 2**66), st.integers(1, 300))
def test_strides_are_disjoint_and_cover_the_range(low, width, requested):
    for dtype in (LONG, NTZ):
        plan = tm.plan_strides(found(low, low + width, dtype), requested)
        bounds = plan.bounds()
        assert 1 <= plan.count <= requested and len(bounds) == plan.count
        assert bounds[0][0] == low and bounds[-1][1] == low + width
        assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(bounds, bounds[1:]))
        assert bounds[-1][0] <= bounds[-1][1]


def brute_stride(plan, x):
    if x is None:
        return 0
    for i, (start, end) in enumerate(plan.bounds()):
        if start <= x < end or (i == plan.count - 1 and x == end):
            return i
    raise AssertionError(f"{x} is in no stride")


RANGES = [
    (T.ByteType(), -128, 127, 9),
    (T.IntegerType(), -(2**31), 2**31 - 1, 7),
    (LONG, -(2**63), 2**63 - 1, 11),
    (LONG, 2**53, 2**53 + 1000, 13),
    (LONG, 5, 9, 100),
    (T.DecimalType(20, 0), 2**63, 2**64 - 1, 10),
    (T.DecimalType(10, 0), 0, 10**9, 3),
    (DATE, 10_000, 12_345, 12),
    (NTZ, 1_704_067_200_123_456, 1_706_659_200_654_321, 10),
    (NTZ, -86_400_000_000, 86_400_000_001, 7),
    (ZONED, 1_730_500_000_000_001, 1_730_700_000_000_000, 8),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("dtype, low, high, n", RANGES)
def test_row_level_form_equals_the_intervals(spark, zone, dtype, low, high, n):
    plan = tm.plan_strides(found(low, high, dtype), n)
    edges = [x + d for bound in plan.bounds() for x in bound for d in (-1, 0, 1)]
    spread = [low + (high - low) * i // 97 for i in range(98)]
    values = sorted({x for x in edges + spread if low <= x <= high})
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        texts = [(str(x), axis_text(x, dtype)) for x in values]
        rows = spark.createDataFrame(texts, "x string, v string")
        instant = F.timestamp_micros(F.col("x").cast("bigint"))
        k = instant if isinstance(dtype, T.TimestampType) else F.col("v").cast(dtype)
        rows = rows.select("x", k.alias("k"))
        ids = rows.select("x", tm.stride_id(plan).alias("s")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {int(r.x): r.s for r in ids} == {x: brute_stride(plan, x) for x in values}


def test_missing_values_belong_to_stride_zero(spark):
    plan = tm.plan_strides(found(0, 100), 4)
    rows = spark.createDataFrame([(None,), (0,), (100,)], "k bigint")
    assert [r.s for r in rows.select(tm.stride_id(plan).alias("s")).collect()] == [0, 0, 3]


def test_sql_text():
    plan = tm.plan_strides(found(1, 4), 2)
    assert tm.stride_predicates(plan, "`k`", keep_nulls=False) == [
        "`k` >= 1 AND `k` < 2",
        "`k` >= 2 AND `k` <= 4",
    ]
    assert tm.stride_predicates(plan, "k", keep_nulls=True)[0] == (
        "k >= 1 AND k < 2"
    )
    assert tm.stride_predicates(None, "k", keep_nulls=False) == ["1=0"]
    assert tm.stride_predicates(None, "k", keep_nulls=True) == ["k IS NULL"]
    days = tm.plan_strides(found(0, 2, DATE), 2)
    assert tm.stride_predicates(days, "d", keep_nulls=False) == [
        "d >= {d '1970-01-01'} AND d < {d '1970-01-02'}",
        "d >= {d '1970-01-02'} AND d <= {d '1970-01-03'}",
    ]
    moment = tm.plan_strides(found(1, 1, NTZ), 9)
    at = "{ts '1970-01-01 00:00:00.000001'}"
    assert tm.stride_predicates(moment, "t", keep_nulls=False) == [f"t >= {at} AND t <= {at}"]
    at = "'1970-01-01 00:00:00.000001'"
    plain = tm.stride_predicates(moment, "t", keep_nulls=False, plain_timestamps=True)
    assert plain == [f"t >= {at} AND t <= {at}"]
    instant = tm.plan_strides(found(1, 1, ZONED), 9)
    at = "'1970-01-01 00:00:00.000001+00:00'"
    assert tm.stride_predicates(instant, "t", keep_nulls=False) == [f"t >= {at} AND t <= {at}"]


@settings(max_examples=200, deadline=None)
@given(st.datetimes(min_value=datetime(1, 1, 1), max_value=datetime(9999, 12, 31)))
def test_axis_text_of_timestamps(moment):
    micros = (moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    assert axis_text(micros, NTZ) == moment.isoformat(sep=" ", timespec="microseconds")


def test_range_of_wide_decimals(spark):
    top = 2**64 - 1
    rows = spark.createDataFrame([(Decimal(2**63),), (Decimal(top),)], "k decimal(20,0)")
    found_range = tm.column_range(rows, "k")
    assert (found_range.low, found_range.high) == (2**63, top)
    loaded = tm.loader(spark).options(partitionColumn="k", offset=str(2**63)).load(rows)
    assert [int(r.k) for r in loaded.df.collect()] == [top]
    assert loaded.next_offset == str(top)
