"""Stride plans: N equal steps over a column's range, or N steps of about equal rows.

The last stride is closed at the top of the range; of equal steps it takes the remainder of
the division.  A row's stride is a column expression, so it is computed inside
the scan; the same plan rendered as SQL text drives parallel JDBC reads.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import OptionError
from tidemark.functions.types import (
    LONG_MAX,
    LONG_MIN,
    MICROS,
    axis,
    axis_literal,
    axis_text,
    is_number,
    is_timestamp,
    quoted,
)
from tidemark.plans.ranges import ColumnRange


@dataclass(frozen=True)
class StridePlan:
    """``count`` strides of ``step`` axis units from ``low``; the last ends at ``high``.

    With ``starts`` the strides begin there instead, and ``step`` has no meaning.
    """

    column: str
    dtype: T.DataType
    low: int
    high: int
    step: int
    count: int
    starts: tuple[int, ...] = ()

    def bounds(self) -> list[tuple[int, int]]:
        """Start and end of each stride; all ends are open but the last."""
        starts = list(self.starts) or [self.low + i * self.step for i in range(self.count)]
        return list(zip(starts, starts[1:] + [self.high]))


def plan_strides(found: ColumnRange, requested: int) -> StridePlan | None:
    """Split a range into at most ``requested`` strides; None without a low and a high end.

    Numbers and days never get more strides than the range is wide.  Timestamps
    step by whole seconds, and a range too short for that stays in one stride.
    """
    if requested < 1:
        raise OptionError(f"numPartitions must be at least 1, not {requested}")
    if found.low is None or found.high is None:
        return None
    if found.low > found.high:
        raise OptionError(f"range of {found.column!r} starts at {found.low}, past its end {found.high}")
    if is_timestamp(found.dtype):
        step = MICROS * ((found.high // MICROS - found.low // MICROS) // requested)
        count = requested if step else 1
    else:
        width = found.high - found.low
        count = max(1, min(requested, width))
        step = width // count
    return StridePlan(found.column, found.dtype, found.low, found.high, step, count)


#: Ranks that the sketch may be off, as a share of a stride.
SKETCH_ERROR = 0.05


def plan_balanced(df: DataFrame, found: ColumnRange, requested: int) -> StridePlan | None:
    """At most ``requested`` strides of about equal rows over a range that was found.

    One pass over the column builds a quantile sketch in each task and merges them; its ranks are
    within SKETCH_ERROR of a stride, so a stride holds at most 1.1 times an even share, and the rows
    that repeat its values.  A value that fills several strides gets one, so there may be
    fewer.  Beyond 2^53 the sketch rounds values, which moves the bounds but loses no row.
    Only the bounds reach the driver.
    """
    if requested < 1:
        raise OptionError(f"numPartitions must be at least 1, not {requested}")
    if found.low is None or found.high is None:
        return None
    shares = [i / requested for i in range(1, requested)]
    cuts: set[int] = set()
    if shares:
        accuracy = max(10_000, round(requested / SKETCH_ERROR))
        sketched = df.agg(F.percentile_approx(quoted(found.column), shares, accuracy).alias("cuts"))
        placed = sketched.select(F.explode("cuts").alias("cut")).select(axis(F.col("cut"), found.dtype).alias("at"))
        cuts = {int(r["at"]) for r in placed.collect()}
    starts = (found.low, *sorted(c for c in cuts if found.low < c <= found.high))
    return StridePlan(found.column, found.dtype, found.low, found.high, 0, len(starts), starts)


def _by_cuts(c: Column, plan: StridePlan, first: int, last: int) -> Column:
    """Stride of a value between two strides, by halving: a few comparisons in the column's type."""
    if first == last:
        return F.lit(first).cast("bigint")
    middle = (first + last + 1) // 2
    below = c < axis_literal(plan.starts[middle], plan.dtype)
    return F.when(below, _by_cuts(c, plan, first, middle - 1)).otherwise(_by_cuts(c, plan, middle, last))


def stride_id(plan: StridePlan) -> Column:
    """Stride of each row as a bigint; rows without a value belong to stride 0."""
    c = quoted(plan.column)
    if plan.count == 1:
        return F.lit(0).cast("bigint")
    if plan.starts:
        return F.when(c.isNull(), F.lit(0).cast("bigint")).otherwise(_by_cuts(c, plan, 0, plan.count - 1))
    if isinstance(plan.dtype, T.TimestampNTZType):
        # Interval arithmetic, in whole seconds, for the reason given in ``axis``.
        distance = (c - axis_literal(plan.low, plan.dtype)).cast("bigint")
        steps = _whole_steps(distance, plan.step // MICROS)
    elif isinstance(plan.dtype, T.TimestampType):
        steps = _whole_steps(F.unix_micros(c) - F.lit(plan.low), plan.step)
    elif isinstance(plan.dtype, T.DateType):
        steps = _whole_steps(F.unix_date(c).cast("bigint") - F.lit(plan.low), plan.step)
    else:
        steps = _whole_steps(*_number_distance(c, plan))
    # ``least`` skips NULL, so a missing value has to be settled before it.  A value
    # outside the range, which a changing source may hold, goes to the nearest stride.
    first, last = F.lit(0).cast("bigint"), F.lit(plan.count - 1).cast("bigint")
    return F.when(c.isNull(), first).otherwise(F.greatest(first, F.least(last, steps)))


def _whole_steps(distance: Column, step: int | Column) -> Column:
    # Integer division: a double quotient is off by one past 2^53.
    return F.call_function("div", distance, step if isinstance(step, Column) else F.lit(step))


def _number_distance(c: Column, plan: StridePlan) -> tuple[Column, int | Column]:
    """Distance from the low end, in decimals where longs would overflow."""
    fits = LONG_MIN <= plan.low and plan.high <= LONG_MAX and plan.high - plan.low <= LONG_MAX
    if fits and not isinstance(plan.dtype, T.DecimalType):
        return c.cast("bigint") - F.lit(plan.low).cast("bigint"), plan.step
    wide = "decimal(38,0)"
    return c.cast(wide) - F.lit(str(plan.low)).cast(wide), F.lit(str(plan.step)).cast(wide)


def stride_summary(df: DataFrame, plan: StridePlan) -> DataFrame:
    """Rows, smallest and largest value per stride; empty strides have no row."""
    c = quoted(plan.column)
    return (
        df.groupBy(stride_id(plan).alias("stride_id"))
        .agg(F.count("*").alias("row_count"), F.min(c).alias("min_value"), F.max(c).alias("max_value"))
    )


def stride_predicates(
    plan: StridePlan | None, name: str, keep_nulls: bool, plain_timestamps: bool = False
) -> list[str]:
    """The plan as SQL conditions, one per parallel query of a JDBC source.

    ``name`` is the already quoted column name.  With ``keep_nulls`` the last condition takes
    the rows without a value, which may be many.  ``plain_timestamps`` is that of ``sql_literal``.
    """
    if plan is None:
        return [f"{name} IS NULL" if keep_nulls else "1=0"]
    predicates = []
    for i, (start, end) in enumerate(plan.bounds()):
        closing = "<=" if i == plan.count - 1 else "<"
        low, high = (sql_literal(n, plan.dtype, plain_timestamps) for n in (start, end))
        predicates.append(f"{name} >= {low} AND {name} {closing} {high}")
    if keep_nulls:
        predicates.append(f"{name} IS NULL")
    return predicates


def salted_predicates(predicates: list[str], name: str, buckets: int) -> list[str]:
    """Split each condition ``buckets`` ways by a second, whole-number column.

    For strides that hold most of the table: a hot value cannot be cut by range.
    Every row falls in one bucket; rows without a value fall in the first.
    """
    split = [f"ABS(MOD({name}, {buckets})) = {i}" for i in range(buckets)]
    split[0] += f" OR {name} IS NULL"
    return [f"({p}) AND ({s})" for p in predicates for s in split]


def sql_literal(n: int, dtype: T.DataType, plain_timestamps: bool = False) -> str:
    """An axis position as SQL text.

    Dates and wall-clock timestamps are written with the JDBC standard's escapes, or
    timestamps as plain text where a database is better served by that.  Instants are
    plain text with their zone offset, for which there is no escape.
    """
    if is_number(dtype):
        return str(n)
    text = axis_text(n, dtype)
    if isinstance(dtype, T.DateType):
        return f"{{d '{text}'}}"
    if isinstance(dtype, T.TimestampType):
        return f"'{text}+00:00'"
    return f"'{text}'" if plain_timestamps else f"{{ts '{text}'}}"
