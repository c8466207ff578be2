"""Physical layout by stride."""

from __future__ import annotations

import json
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import free_name, holds, quoted
from tidemark.plans.strides import StridePlan, stride_id

# Types that Spark does not hash.
UNHASHABLE = (T.MapType, T.VariantType)


def stride_layout(
    df: DataFrame, plan: StridePlan, max_partition_rows: int | None = None
) -> DataFrame:
    """Shuffle rows so that no partition mixes strides.

    Strides hold very different numbers of rows when values are skewed, NULL or
    repeated.  One count per stride (a pass over the plan's column) decides how
    many partitions each stride gets, so that none is larger than an even share
    or, if it is given, than ``max_partition_rows``.
    """
    return lay_out(df, plan, max_partition_rows)[0]


def lay_out(
    df: DataFrame, plan: StridePlan, max_partition_rows: int | None = None
) -> tuple[DataFrame, int]:
    """:func:`stride_layout`, and the number of its partitions."""
    stride = stride_id(plan)
    counted = df.groupBy(stride.alias("stride_id")).count()
    rows = {r["stride_id"]: r["count"] for r in counted.collect()}  # at most plan.count rows
    share = max(1, -(-sum(rows.values()) // plan.count))
    if max_partition_rows:
        share = min(share, max_partition_rows)
    pieces = [max(1, -(-rows.get(i, 0) // share)) for i in range(plan.count)]
    starts = list(accumulate(pieces, initial=0))

    place = _per_stride(starts[:-1], stride)
    if max(pieces) > 1:
        place = place + F.pmod(_row_salt(df), _per_stride(pieces, stride))
    name = free_name(df, "__stride_partition")
    placed = df.withColumn(name, place.cast("int")).repartitionById(starts[-1], F.col(name))
    return placed.drop(name), starts[-1]


def _per_stride(values: list[int], stride: Column) -> Column:
    # One text literal, which Spark folds into an array; a literal per value would
    # take seconds to build for thousands of strides.
    lookup = F.from_json(F.lit(json.dumps(values)), "array<int>")
    return F.element_at(lookup, (stride + 1).cast("int"))


def _row_salt(df: DataFrame) -> Column:
    """A number that spreads rows, copies of one row included, and is stable on retry.

    The contents spread different rows and the input partition spreads copies.
    Neither changes when a lost task is run again, which a random number or a
    row counter would not promise.
    """
    hashed = [quoted(f.name) for f in df.schema if not holds(f.dataType, UNHASHABLE)]
    return F.xxhash64(*hashed, F.spark_partition_id())

