"""Deduplication by primary key.

Both forms keep one row per key with a window filter.  Spark turns a filter on
``row_number() = 1`` into a group limit that also runs before the shuffle, so each
map task sends at most one row per key and a key that holds a large part of the
table does not pile up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import OptionError
from tidemark.functions.types import free_name, holds, quoted

FIXED_WIDTH = (
    T.BooleanType,
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)

# Types that Spark does not order.
UNORDERED = (T.MapType, T.VariantType, T.CalendarIntervalType)


def resolve_keys(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """Key names as Spark resolves them; an error if one is missing."""
    if not keys:
        raise OptionError("at least one key column is needed")
    return list(dict.fromkeys(df.select(*[quoted(k) for k in keys]).columns))


def dedup_any(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; which one survives is not defined."""
    names = resolve_keys(df, keys)
    rest = [f for f in df.schema if f.name not in names]
    if all(isinstance(f.dataType, FIXED_WIDTH) for f in rest):
        return df.dropDuplicates(names)  # a hash aggregate
    # With text among the values ``dropDuplicates`` becomes a sort aggregate, which
    # is slower than the group limit.
    return _first_per_key(df, names, [quoted(k) for k in names])


def dedup_latest(df: DataFrame, keys: Sequence[str], order_column: str) -> DataFrame:
    """One row per key: the one with the largest ``order_column``.

    Ties go to the largest remaining columns, in table order, so the result does
    not depend on the order of the input.  NULL loses against any value.  Columns of types
    that Spark does not order come last, by their value written as text.
    """
    names = resolve_keys(df, keys)
    (newest,) = df.select(quoted(order_column)).columns
    rest = [f for f in df.schema if f.name not in (*names, newest)]
    unordered = [f for f in rest if holds(f.dataType, UNORDERED)]
    ordered = [quoted(f.name) for f in rest if f not in unordered]
    order = [quoted(newest), *ordered, *[_written(quoted(f.name), f.dataType) for f in unordered]]
    return _first_per_key(df, names, [c.desc_nulls_last() for c in order])


def _first_per_key(df: DataFrame, names: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*[quoted(k) for k in names]).orderBy(*order)
    rank = free_name(df, "__rank_in_key")
    ranked = df.withColumn(rank, F.row_number().over(window))
    return ranked.where(F.col(rank) == 1).drop(rank)


def _written(c: Column, dtype: T.DataType) -> Column:
    """A value of any type as text that is the same for equal values.

    Maps are written as their sorted entries; parts are written with their length in
    front, so that different values never have the same text.
    """
    if isinstance(dtype, T.StructType):
        parts = F.array(*[_part(c[f.name], f.dataType) for f in dtype])
    elif isinstance(dtype, T.ArrayType):
        parts = F.transform(c, lambda x: _part(x, dtype.elementType))
    elif isinstance(dtype, T.MapType):
        entries = F.transform(
            F.map_entries(c),
            lambda e: F.concat(_part(e["key"], dtype.keyType), _part(e["value"], dtype.valueType)),
        )
        parts = F.array_sort(entries)
    elif isinstance(dtype, T.VariantType):
        return F.to_json(c)
    elif isinstance(dtype, T.BinaryType):
        return F.hex(c)
    else:
        return c.cast("string")
    return F.when(c.isNotNull(), F.array_join(parts, ""))


def _part(c: Column, dtype: T.DataType) -> Column:
    text = _written(c, dtype)
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
