"""The incremental loader.

``loader(spark).option(...).load(name)`` returns a lazy DataFrame of the rows past
the offset, and the offset to pass to the next run.  The range is read once, when
``load`` is called, and both the filter and the next offset come from it: rows that
arrive later are left to the next run, and none is skipped or read twice.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import replace
from functools import cached_property
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import SPARK_ERRORS, LoadError, OptionError
from tidemark.functions.types import (
    axis,
    check_years,
    in_zone,
    offset_literal,
    offset_text,
    quoted,
    splittable_field,
)
from tidemark.operators.dedup import dedup_any, dedup_latest
from tidemark.operators.layout import lay_out
from tidemark.operators.provenance import PROVENANCE_KEYS, with_provenance
from tidemark.plans.late import DeliveredRows, LateLoad
from tidemark.plans.merge import MergeTarget
from tidemark.plans.ranges import (
    FOOTER_TYPES,
    ColumnRange,
    column_range,
    footer_frame,
    footer_range,
)
from tidemark.plans.strides import StridePlan, plan_balanced, plan_strides
from tidemark.plans.zones import ZoneMap
from tidemark.sinks.files import write_files
from tidemark.sinks.staging import shared_dir, stage
from tidemark.sources.footers import FILE_TYPES, facts_range, file_facts
from tidemark.sources.frames import is_catalog_table, open_frame
from tidemark.sources.jdbc import open_jdbc
from tidemark.sources.spec import FULL, INCREMENTAL, STRIDE, LoadSpec


class LoadResult:
    """A loaded frame and what was found out on the way.

    ``range`` is None without a partition column.  It is looked up when the load is called, so that
    the next offset outlives the files; with ``lateRange`` a load of files, whose list is
    fixed when the frame opens, does so when ``range``, ``strides`` or ``next_offset`` is first
    asked for.  ``strides`` is None without a range, and when the range is empty or only its top
    is known.  ``partitions`` is the number of partitions of the stride layout, else None.
    """

    def __init__(
        self,
        df: DataFrame,
        offset: str | None,
        find: Callable[[], ColumnRange | None],
        requested: int,
        partitions: int | None = None,
        plan: Callable[[ColumnRange, int], StridePlan | None] = plan_strides,
    ):
        self.df, self.partitions = df, partitions
        self._offset, self._find, self._requested, self._plan = offset, find, requested, plan

    def with_frame(self, df: DataFrame) -> LoadResult:
        return LoadResult(
            df, self._offset, lambda: self.range, self._requested, self.partitions, lambda *_: self.strides
        )

    @cached_property
    def range(self) -> ColumnRange | None:
        return self._find()

    @cached_property
    def strides(self) -> StridePlan | None:
        return self._plan(self.range, self._requested) if self.range else None

    @property
    def next_offset(self) -> str | None:
        return self.range.next_offset(self._offset) if self.range else None


class Loader:
    """Option builder; option names are case-insensitive, as in Spark's readers.

    Every call returns a new loader, so a common one can be kept and varied.
    """

    def __init__(self, spark: SparkSession, options: dict[str, Any] | None = None):
        self._spark = spark
        self._options = dict(options or {})

    def option(self, key: str, value: Any) -> Loader:
        kept = {k: v for k, v in self._options.items() if k.lower() != key.lower()}
        return Loader(self._spark, {**kept, key: value})

    def options(self, **options: Any) -> Loader:
        result = self
        for key, value in options.items():
            result = result.option(key, value)
        return result

    def format(self, name: str) -> Loader:
        return self.option("format", name)

    def load(self, source: str | DataFrame | None = None) -> LoadResult:
        """Load a table name, a path or a DataFrame."""
        return self._load(LoadSpec.of(self._options, source))

    def load_deduplicated(
        self,
        primary_keys: Sequence[str],
        source: str | DataFrame | None = None,
        keep: str = "latest",
    ) -> LoadResult:
        """Load, then keep one row per key; a full load is returned as it is.

        ``keep="latest"`` keeps the row with the largest partition column,
        ``keep="any"`` an arbitrary one, as does a load without partition column.
        """
        if keep not in ("latest", "any"):
            raise OptionError(f"keep is latest or any, not {keep!r}")
        spec = LoadSpec.of(self._options, source)
        loaded = self._load(spec)
        return loaded.with_frame(_deduplicated(loaded.df, spec, primary_keys, keep))

    def load_into(
        self,
        path: str,
        source: str | DataFrame | None = None,
        format: str = "parquet",
        mode: str = "append",
        partition_by: Sequence[str] = (),
        rebalance: bool = False,
        primary_keys: Sequence[str] = (),
    ) -> str | None:
        """Load straight into files and return the offset for the next run.

        The file arguments are those of ``write_files``.  With ``primary_keys`` an
        increment keeps the latest row of each key.

        The source is read once: the next offset is the largest value among the rows
        loaded, observed while they are written, so no range is looked up first.
        (JDBC, staged and stride-layout loads need their range beforehand and look it up.)
        A source that changes while it is read, so that a retried task could see other
        rows, should be loaded with ``load`` or staged first.
        """
        if mode.lower() == "ignore":
            raise OptionError("mode ignore may write nothing, while the next offset moves on")
        spec = LoadSpec.of(self._options, source)
        if spec.is_jdbc or spec.tempdir or spec.layout == STRIDE or not spec.partition_column:
            loaded = self._load(spec)
            rows = _deduplicated(loaded.df, spec, primary_keys) if primary_keys else loaded.df
            write_files(rows, path, format, mode, partition_by, rebalance)
            return loaded.next_offset
        seen = Observation()
        with _load_errors(spec):
            rows = _observed(self._spark, spec, seen)
        if primary_keys:
            rows = _deduplicated(rows, spec, primary_keys)
        write_files(rows, path, format, mode, partition_by, rebalance)
        top = seen.get["next_offset"]
        check_years(top, splittable_field(rows, spec.partition_column).dataType)
        return top or spec.offset or None

    def merge_into(
        self, folder: str, primary_keys: Sequence[str], source: str | DataFrame | None = None
    ) -> str | None:
        """Load, merge the newest row of each key into a :class:`MergeTarget`, and return the next offset.

        The target keeps the offset with the version, so a run that is killed is made again from
        ``MergeTarget.next_offset()``; rows that are merged twice change nothing.
        """
        spec = LoadSpec.of(self._options, source)
        if not spec.partition_column:
            raise OptionError("a merge needs a partitionColumn")
        loaded = self._load(spec)
        target = MergeTarget(self._spark, folder, primary_keys, spec.partition_column)
        with _load_errors(spec):
            target.merge(loaded.df, loaded.next_offset)
        return loaded.next_offset

    def load_late(
        self,
        primary_keys: Sequence[str],
        delivered: str,
        overlap: int,
        source: str | DataFrame | None = None,
    ) -> LateLoad:
        """Load the rows past the offset, and those that were committed late, up to ``overlap`` below it.

        ``delivered`` is a folder of this chain of runs alone; it keeps what was delivered, and the
        offset: the option ``offset`` starts the first run, later ones go on from the folder.
        ``overlap`` is in units of the column: numbers, days of a date, seconds of a timestamp.  See
        :class:`LateLoad`.  For sources that Spark reads itself.
        """
        spec = LoadSpec.of(self._options, source)
        if spec.is_jdbc or not spec.partition_column:
            raise OptionError("late rows need a partitionColumn and a source that Spark reads itself")
        if overlap < 0:
            raise OptionError(f"overlap must not be negative, not {overlap}")
        with _load_errors(spec):
            field = splittable_field(open_frame(self._spark, spec), spec.partition_column)
            chain = DeliveredRows(self._spark, delivered, primary_keys, field, overlap)
            offset = chain.next_offset() or in_zone(spec.offset, spec.offset_zone, field.dataType) or None
            below = chain.below(offset) if offset else None
            wanted = replace(
                spec,
                load_type=INCREMENTAL if offset else FULL,
                offset=below or "",
                tempdir=spec.tempdir or shared_dir(self._spark),
                late_range=True,
            )
            return chain.load(_load(self._spark, wanted).df, offset)

    def _load(self, spec: LoadSpec) -> LoadResult:
        with _load_errors(spec):
            return _load(self._spark, spec)


@contextmanager
def _load_errors(spec: LoadSpec) -> Iterator[None]:
    try:
        yield
    except SPARK_ERRORS as cause:
        raise LoadError(f"load of {spec.table_name} failed") from cause


def loader(spark: SparkSession) -> Loader:
    return Loader(spark)


def _load(spark: SparkSession, spec: LoadSpec) -> LoadResult:
    details = _details(spark, spec)
    offset = spec.offset or None
    if spec.is_jdbc:
        df, found, plan = open_jdbc(spark, spec)
        df = with_provenance(df, details)
        df = stage(df, spec.tempdir) if spec.tempdir else df
        return LoadResult(df, offset, lambda: found, spec.num_partitions, None, lambda *_: plan)
    # Footers come before the files are listed for the load: a file that arrives in
    # between is cut off by the range, where an older listing would miss it while the
    # next offset is already past it.
    if spec.zone_map:
        df, found = _open_zones(spark, spec)
    else:
        found = _range_from_footers(spark, spec) if spec.partition_column else None
        df = open_frame(spark, spec)
    if not spec.partition_column:
        df = with_provenance(df, details)
        df = stage(df, spec.tempdir) if spec.tempdir else df
        return LoadResult(df, offset, lambda: None, spec.num_partitions)
    field = splittable_field(df, spec.partition_column)
    past_offset = _past_offset(spec, field)
    rows = df if past_offset is None else df.where(past_offset)
    pinned = _is_files(spark, spec)
    if spec.tempdir:  # before anything else reads the source, which may be costly or changing
        rows, pinned = stage(with_provenance(rows, details), spec.tempdir), True
    if pinned and found is None and spec.layout != STRIDE:
        frame = rows

        def look_up() -> ColumnRange:
            with _load_errors(spec):
                return column_range(frame, field.name)

        # Files may be compacted or expired once their rows are used, and the offset with them.
        find = look_up if spec.late_range else lambda early=look_up(): early
        df = with_provenance(rows, details)
        return LoadResult(df, offset, find, spec.num_partitions, None, _planner(spec, rows))

    if found is None:
        found = column_range(rows, field.name)
    c = quoted(field.name)
    if past_offset is not None:
        rows = rows.where(F.lit(False) if found.is_empty else c <= found.high_literal())
    else:
        # A full load keeps the rows without a value.
        rows = rows.where(c.isNull() if found.is_empty else c.isNull() | (c <= found.high_literal()))
    plan, partitions = _planner(spec, rows), None
    if spec.layout == STRIDE:
        strides = plan(found, spec.num_partitions)
        plan = lambda *_: strides
        if strides is not None:
            rows, partitions = lay_out(rows, strides, spec.max_partition_rows)
    df = with_provenance(rows, details)
    return LoadResult(df, offset, lambda: found, spec.num_partitions, partitions, plan)


def _planner(spec: LoadSpec, rows: DataFrame) -> Callable[[ColumnRange, int], StridePlan | None]:
    """What makes strides of a range of ``rows``: equal steps, or steps of about equal rows."""
    if spec.balanced:
        return lambda found, requested: plan_balanced(rows, found, requested)
    return plan_strides


def _open_zones(spark: SparkSession, spec: LoadSpec) -> tuple[DataFrame, ColumnRange]:
    """The files that the zone map picks, and their range."""
    if spec.format != "parquet" or not _is_files(spark, spec) or spec.reader_options:
        raise OptionError("zoneMap is for a path of Parquet files without reader options")
    if spec.layout == STRIDE and spec.is_incremental:
        raise OptionError("the strides of an increment need its least value, which zones do not know")
    zones = ZoneMap(spark, spec.table, spec.partition_column, spec.zone_map).refresh()
    offset = in_zone(spec.offset, spec.offset_zone, zones.field.dataType) if spec.is_incremental else ""
    return zones.open(offset or None)


def _is_files(spark: SparkSession, spec: LoadSpec) -> bool:
    """Whether the source is a path, the files of which are listed when the frame opens."""
    return (
        isinstance(spec.table, str)
        and not spec.query
        and not spec.named_table
        and not is_catalog_table(spark, spec)
    )


def _deduplicated(
    df: DataFrame, spec: LoadSpec, primary_keys: Sequence[str], keep: str = "latest"
) -> DataFrame:
    if not spec.is_incremental:
        return df
    if keep == "latest" and spec.partition_column:
        return dedup_latest(df, primary_keys, spec.partition_column)
    return dedup_any(df, primary_keys)


def _observed(spark: SparkSession, spec: LoadSpec, seen: Observation) -> DataFrame:
    df = open_frame(spark, spec)
    field = splittable_field(df, spec.partition_column)
    past_offset = _past_offset(spec, field)
    rows = df if past_offset is None else df.where(past_offset)
    top = offset_text(F.max(quoted(field.name)), field.dataType)
    return with_provenance(rows, _details(spark, spec)).observe(seen, top.alias("next_offset"))


def _past_offset(spec: LoadSpec, field: T.StructField) -> Column | None:
    if not spec.is_incremental:
        return None
    offset = in_zone(spec.offset, spec.offset_zone, field.dataType)
    return quoted(field.name) > offset_literal(offset, field.dataType)


def _range_from_footers(spark: SparkSession, spec: LoadSpec) -> ColumnRange | None:
    """The range from Parquet footers, if that was asked for and is possible.

    Footers know the range of a whole file, so they give the top of an increment but
    not its bottom, which strides start from.  Where they cannot serve, a warning says why.
    """
    if not spec.footer_stats:
        return None
    if spec.format != "parquet" or not _is_files(spark, spec):
        return _no_footers("the source is not a path of Parquet files")
    if spec.reader_options:
        return _no_footers(f"reader options are given: {sorted(spec.reader_options)}")
    if spec.layout == STRIDE and spec.is_incremental:
        return _no_footers("the strides of an increment need its least value")
    if not hasattr(spark, "newSession"):
        return _no_footers("the session cannot open a second one")
    footers = footer_frame(spark, spec.table)
    field = splittable_field(footers, spec.partition_column)
    if isinstance(field.dataType, FOOTER_TYPES):
        return footer_range(footers, field.name, spec.offset or None)
    if not isinstance(field.dataType, FILE_TYPES):
        return _no_footers(f"column {field.name!r} is a {field.dataType.simpleString()}")
    past = _axis_position(spark, spec, field) if spec.offset else None
    return facts_range(file_facts(spark, spec.table, field.name), field, past)


def _axis_position(spark: SparkSession, spec: LoadSpec, field: T.StructField) -> int:
    literal = offset_literal(in_zone(spec.offset, spec.offset_zone, field.dataType), field.dataType)
    (row,) = spark.range(1).select(axis(literal, field.dataType).alias("position")).collect()
    return int(row.position)


def _no_footers(why: str) -> None:
    warnings.warn(f"footerStats is not used, the column is scanned: {why}", stacklevel=2)


def _details(spark: SparkSession, spec: LoadSpec) -> dict[str, str | int]:
    values = (
        spec.table_name,
        spec.load_type,
        spec.offset,
        spec.num_partitions,
        spark.conf.get("spark.app.id"),
        spec.partition_column,
    )
    return dict(zip(PROVENANCE_KEYS, values))
