"""Column range discovery and the offset for the next run."""

from __future__ import annotations

import re
from dataclasses import dataclass
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import (
    WHOLE_NUMBERS,
    axis,
    check_years,
    offset_literal,
    offset_text,
    quoted,
    splittable_field,
)

# Types whose footer statistics Spark answers min and max from.
FOOTER_TYPES = (*WHOLE_NUMBERS, T.DateType)


@dataclass(frozen=True)
class ColumnRange:
    """Smallest and largest value of a column, on its axis and as offset text.

    All four are None when no row has a value; the low end alone is None when only
    the top was looked up.
    """

    column: str
    dtype: T.DataType
    low: int | None
    high: int | None
    low_text: str | None
    high_text: str | None

    @property
    def is_empty(self) -> bool:
        return self.high is None

    def high_literal(self) -> Column:
        return F.lit(self.high_text).cast(self.dtype)

    def next_offset(self, previous: str | None = None) -> str | None:
        """The offset to pass to the next run: unchanged if nothing new was found."""
        return previous if self.is_empty else self.high_text


def bare_condition(text: str) -> str:
    """A filter as text, given with or without a leading ``where``."""
    return re.sub(r"\A\s*where\s+", "", text.strip(), flags=re.IGNORECASE)


def _filtered(df: DataFrame, predicate: Column | str | None) -> DataFrame:
    if predicate is None:
        return df
    return df.where(bare_condition(predicate) if isinstance(predicate, str) else predicate)


def range_frame(df: DataFrame, column: str, predicate: Column | str | None = None) -> DataFrame:
    """One row ``(min_value, max_value)``, optionally over the rows that pass ``predicate``."""
    c = quoted(column)
    return _filtered(df, predicate).agg(F.min(c).alias("min_value"), F.max(c).alias("max_value"))


def read_range(extremes: DataFrame, column: str, dtype: T.DataType) -> ColumnRange:
    """Bring the one row of :func:`range_frame` to the driver."""
    low, high = F.col("min_value").cast(dtype), F.col("max_value").cast(dtype)
    (row,) = extremes.select(
        axis(low, dtype).alias("low"),
        axis(high, dtype).alias("high"),
        offset_text(low, dtype).alias("low_text"),
        offset_text(high, dtype).alias("high_text"),
    ).collect()
    check_years(row.high_text, dtype)
    return ColumnRange(
        column,
        dtype,
        None if row.low is None else int(row.low),
        None if row.high is None else int(row.high),
        row.low_text,
        row.high_text,
    )


def column_range(
    df: DataFrame, column: str, predicate: Column | str | None = None
) -> ColumnRange:
    """Range of a splittable column: one job that reads that column (and the filter's)."""
    field = splittable_field(df, column)
    return read_range(range_frame(df, field.name, predicate), field.name, field.dataType)


def footer_frame(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files as a frame whose whole-table facts are read from file footers.

    For ``range_frame`` (whole numbers and dates), ``field_profile`` and plain counts
    of all rows: Spark pushes those aggregates into the Parquet reader, and no column
    data is read.  Anything else scans as usual.  The two settings this takes live in
    a second session, which has the caller's other settings and is kept for the caller's next
    frame; do not combine the frame with frames of other sessions.
    """
    footers = _footer_session(spark)
    return footers.read.parquet(path)


_footer_sessions: WeakKeyDictionary[SparkSession, SparkSession] = WeakKeyDictionary()


def _footer_session(spark: SparkSession) -> SparkSession:
    """One session beside the caller's, with the caller's settings of this moment but for two."""
    footers = _footer_sessions.get(spark)
    if footers is None:
        footers = _footer_sessions[spark] = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            footers.conf.set(key, value)
    footers.conf.set("spark.sql.sources.useV1SourceList", "")
    footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return footers


def footer_range(df: DataFrame, column: str, offset: str | None = None) -> ColumnRange:
    """Range of a column of a :func:`footer_frame`.

    With an offset only the top is known: it is the top of the table, if that is
    past the offset.
    """
    field = splittable_field(df, column)
    extremes = range_frame(df, field.name)
    if offset is not None:
        top = F.col("max_value")
        extremes = extremes.select(
            F.lit(None).cast(field.dataType).alias("min_value"),
            F.when(top > offset_literal(offset, field.dataType), top).alias("max_value"),
        )
    return read_range(extremes, field.name, field.dataType)


def next_offset_frame(df: DataFrame, column: str, predicate: Column | str | None = None) -> DataFrame:
    """One row ``next_offset``: the largest value seen, in the column's own type."""
    return _filtered(df, predicate).agg(F.max(quoted(column)).alias("next_offset"))
