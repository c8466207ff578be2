"""Which sets of columns identify the rows of a table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations
from math import prod

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import OptionError
from tidemark.functions.types import free_name, holds, quoted
from tidemark.operators.dedup import UNORDERED, resolve_keys

#: Relative standard error of the sketches, and how many of it an estimate may fall short.
SKETCH_ERROR, MARGIN = 0.02, 10
#: Sketches that one pass over the table fills.
SETS_A_PASS = 100


def key_candidates(
    df: DataFrame, columns: Sequence[str] | None = None, max_columns: int = 3
) -> DataFrame:
    """``key_columns`` (an array) of every minimal key of at most ``max_columns`` columns.

    A key has no NULL and no value twice; a set that holds a key is not listed.  Sets are searched level by
    level.  A set is left out without a look at its values if it holds a key, or if its columns
    have too few distinct values to tell all rows apart.  One pass over the table then fills a sketch of
    distinct values for each set that is left, and only a set whose estimate is near the number
    of rows is checked exactly, by one grouped count that stops at the first repeated value.

    ``columns`` (by default all that Spark can group by) limits the search.  A table without rows has
    no key.  Only counts reach the driver.
    """
    if max_columns < 1:
        raise OptionError(f"max_columns must be at least 1, not {max_columns}")
    usable = [f.name for f in df.schema if not holds(f.dataType, UNORDERED)]
    names = usable if columns is None else resolve_keys(df, columns)
    keys = list(_minimal_keys(df, names, max_columns))
    schema = T.StructType([T.StructField("key_columns", T.ArrayType(T.StringType()))])
    return df.sparkSession.createDataFrame([(list(k),) for k in keys], schema)


def _minimal_keys(df: DataFrame, names: list[str], most: int) -> Iterator[tuple[str, ...]]:
    if not names:
        return
    counts = df.agg(F.count("*").alias("n"), F.array(*[F.count(quoted(c)) for c in names]).alias("v")).first()
    rows = counts["n"]
    names = [c for c, n in zip(names, counts["v"]) if n == rows]
    least = rows * (1 - MARGIN * SKETCH_ERROR)
    found: list[set[str]] = []
    distinct: dict[str, int] = {}
    for size in range(1, min(most, len(names)) + 1 if rows else 0):
        sets = [s for s in combinations(names, size) if not any(k <= set(s) for k in found)]
        if size > 1:
            # an estimate of the single columns may be short by the margin as well
            slack = (1 - MARGIN * SKETCH_ERROR) ** size
            sets = [s for s in sets if prod(max(distinct[c], 1) for c in s) >= rows * slack]
        estimates = _estimates(df, sets)
        if size == 1:
            distinct = {s[0]: n for s, n in zip(sets, estimates)}
        for columns, estimate in zip(sets, estimates):
            if estimate >= least and _is_unique(df, columns):
                found.append(set(columns))
                yield columns


def _estimates(df: DataFrame, sets: list[tuple[str, ...]]) -> list[int]:
    found: list[int] = []
    for start in range(0, len(sets), SETS_A_PASS):
        some = sets[start : start + SETS_A_PASS]
        sketches = [F.approx_count_distinct(_together(s), SKETCH_ERROR) for s in some]
        found += df.agg(F.array(*sketches).alias("n")).first()["n"]
    return found


def _together(columns: tuple[str, ...]) -> Column:
    return F.struct(*map(quoted, columns)) if len(columns) > 1 else quoted(columns[0])


def _is_unique(df: DataFrame, columns: tuple[str, ...]) -> bool:
    rows = free_name(df, "__rows")
    counted = df.groupBy(*map(quoted, columns)).agg(F.count(F.lit(1)).alias(rows))
    return counted.where(quoted(rows) > 1).isEmpty()
