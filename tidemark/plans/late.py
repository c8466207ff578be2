"""Late rows: those committed with a value at or below an offset that was already passed.

A run reads an overlap below its offset once more and leaves out what was delivered before.  What that
was is known from a small store: the keys and the ordered column of the rows in the
overlap, no more, written anew by each run and published with its offset.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import LoadError
from tidemark.functions.types import (
    LONG_MIN,
    MICROS,
    axis,
    axis_text,
    is_number,
    is_timestamp,
    offset_literal,
    quoted,
)
from tidemark.operators.dedup import resolve_keys
from tidemark.plans.ranges import column_range
from tidemark.sinks.runs import RunLog

#: Position of 0001-01-01, the first day that an offset can name.
FIRST_DAY = -719_162


class LateLoad:
    """The rows of one run, and the offset for the next.

    ``df`` holds every row past the offset and every late row once.  A row is known by its keys and its
    value of the ordered column, so a changed row with a newer value is a new row; NULL keys are equal to
    each other.  Copies in one run are all delivered, copies that come in a later run are not.
    Call :meth:`confirm` once the rows are used: a run that is not confirmed is delivered again.
    A full start delivers rows without a value of the column too; increments never do.  A full start that
    finds no value at all has no offset to record, and the next run starts in full again.
    """

    def __init__(self, df: DataFrame, next_offset: str | None, chain: DeliveredRows, store: DataFrame):
        self.df, self.next_offset = df, next_offset
        self._chain, self._store = chain, store

    def confirm(self) -> str | None:
        """Record the rows as delivered and return the next offset."""
        self._chain.publish(self._store, self.next_offset)
        return self.next_offset


class DeliveredRows:
    """What a chain of runs has delivered within ``overlap`` below its offset."""

    def __init__(
        self, spark: SparkSession, folder: str, keys: Sequence[str], field: T.StructField, overlap: int
    ):
        self._spark, self._folder = spark, folder.rstrip("/")
        self._keys, self._field, self._overlap = list(keys), field, overlap
        self._log = RunLog(spark, folder)
        self._last = self._log.last()

    def next_offset(self) -> str | None:
        return self._last.next_offset if self._last else None

    def below(self, offset: str) -> str:
        """The offset that lies ``overlap`` below another one, as text."""
        dtype = self._field.dataType
        literal = offset_literal(offset, dtype)
        (row,) = self._spark.range(1).select(axis(literal, dtype).alias("position")).collect()
        step = MICROS if is_timestamp(dtype) else 1
        position = int(row.position) - self._overlap * step
        if not is_number(dtype):
            position = max(position, FIRST_DAY * (86_400 * MICROS if is_timestamp(dtype) else 1))
        elif not isinstance(dtype, T.DecimalType):
            position = max(position, LONG_MIN)
        text = axis_text(position, dtype)
        return f"{text}Z" if isinstance(dtype, T.TimestampType) else text

    def load(self, rows: DataFrame, offset: str | None) -> LateLoad:
        """One run over the staged ``rows`` past the overlap; all rows of the source without an offset."""
        keys = resolve_keys(rows, self._keys)
        known = self._known(rows, keys)
        moment = quoted(self._field.name)
        if offset is None:
            found, df = column_range(rows, self._field.name), rows
        else:
            past = moment > offset_literal(offset, self._field.dataType)
            fresh = rows.where(past)
            found, df = column_range(fresh, self._field.name), fresh
            if known is not None:  # a first run takes what lies below its offset as delivered
                df = fresh.unionByName(_unknown(rows.where(~past), known, keys, self._field.name))
        next_offset = found.next_offset(offset)
        store = _identities(rows, keys, self._field.name)
        store = store if known is None else store.unionByName(known)
        if next_offset is not None:
            held = offset_literal(self.below(next_offset), self._field.dataType)
            store = store.where(F.col("at") > held)
        return LateLoad(df, next_offset, self, store.distinct())

    def publish(self, store: DataFrame, next_offset: str | None) -> None:
        if next_offset is None:
            return  # nothing has a place in the order yet, so the next run is a first one as well
        run = uuid.uuid4().hex
        store.write.parquet(f"{self._folder}/delivered/{run}")
        self._log.publish(self._last.version + 1 if self._last else 1, run, next_offset, store.schema.json())

    def _known(self, rows: DataFrame, keys: list[str]) -> DataFrame | None:
        if self._last is None:
            return None
        expected = _identities(rows, keys, self._field.name).schema
        stored = self._spark.read.parquet(f"{self._folder}/delivered/{self._last.run}")
        if stored.schema.simpleString() != expected.simpleString():
            raise LoadError(f"{self._folder} belongs to a chain with other keys or another column")
        return stored


def _identities(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """``k0, k1, ... at``: the keys and the ordered column."""
    named = [quoted(k).alias(f"k{i}") for i, k in enumerate(keys)]
    return rows.select(*named, quoted(column).alias("at")).where("at IS NOT NULL")


def _unknown(rows: DataFrame, known: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The rows whose identity is not known; columns of any name stay as they are."""
    inner = rows.select(F.struct(*[quoted(c) for c in rows.columns]).alias("row"))
    store = known.select(F.struct("*").alias("seen"))
    pairs: list[tuple[Column, Column]] = [
        (_inside("row", name), F.col(f"seen.{own}"))
        for name, own in [*[(k, f"k{i}") for i, k in enumerate(keys)], (column, "at")]
    ]
    same = reduce(and_, [ours.eqNullSafe(theirs) for ours, theirs in pairs])
    left = inner.join(store, same, "left_anti")
    return left.select(*[_inside("row", c).alias(c) for c in rows.columns])


def _inside(struct: str, name: str) -> Column:
    return F.col(f"{struct}.`" + name.replace("`", "``") + "`")
