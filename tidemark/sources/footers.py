"""Facts of single Parquet files, read from their footers in parallel.

Spark answers whole-table extremes of numbers and dates from footers, but neither those of
timestamps nor those of single files.  Here the tasks that list the files also read their footers:
a row for each file with the rows, the NULLs and the range of a column, on the integer axis of its type.
No column data is read.  A file whose footer cannot tell (no statistics, another type, a
store that only Spark reaches) is scanned instead, that column alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import MICROS, WHOLE_NUMBERS, axis, quoted, splittable_field
from tidemark.plans.ranges import ColumnRange, read_range
from tidemark.sinks.staging import stage

LISTED = "file string, length bigint, modified timestamp"
FACTS = "row_count bigint, null_count bigint, low bigint, high bigint"
SAME_FILE = ["file", "length", "modified"]
#: Files that are named one by one when a frame opens; beyond it the whole path is opened and filtered.
NAMED_FILES = 10_000
#: Types whose values footers give as 64-bit whole numbers.
FILE_TYPES = (*WHOLE_NUMBERS, T.DateType, T.TimestampType, T.TimestampNTZType)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``file, length, modified`` of the files of a path, those in its directories included.

    Spark lists them as it does for a load, hidden files left out; no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.selectExpr("path AS file", "length", "modificationTime AS modified")


def file_facts(spark: SparkSession, path: str, column: str) -> DataFrame:
    """``file, length, modified, row_count, null_count, low, high`` of each file of a Parquet path.

    ``low`` and ``high`` are positions on the column's axis, NULL in a file without values.  A
    file that lacks the column holds NULLs only.
    """
    return facts_of(spark, path, column, list_files(spark, path))


def facts_of(spark: SparkSession, path: str, column: str, files: DataFrame) -> DataFrame:
    """:func:`file_facts` of some of the files of a path, given as :func:`list_files` has them."""
    field = splittable_field(spark.read.parquet(path), column)
    footers = stage(files.mapInArrow(_footer_reader(field.name), f"{LISTED}, {FACTS}, known boolean"))
    told = footers.where("known").drop("known")
    untold = footers.where("NOT known").select(*SAME_FILE)
    names = [r.file for r in untold.select("file").limit(NAMED_FILES + 1).collect()]
    if not names:
        return told
    c = quoted(field.name)
    place = axis(c, field.dataType).cast("bigint")
    scanned = open_files(spark, path, names).groupBy(listed_name(F.col("_metadata.file_path")).alias("file")).agg(
        F.count("*").alias("row_count"),
        (F.count("*") - F.count(c)).alias("null_count"),
        F.min(place).alias("low"),
        F.max(place).alias("high"),
    )
    empty = {"row_count": 0, "null_count": 0}
    return told.unionByName(untold.join(scanned, "file", "left").fillna(empty))


def open_files(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """Files of a Parquet path as a frame with the schema of the path, its directory columns too.

    Files beyond NAMED_FILES, and those of a path with wildcards, are not named one by one: the
    frame holds the whole path then.
    """
    table = spark.read.parquet(path)
    if not names:
        return table.where(F.lit(False))
    if len(names) > NAMED_FILES or any(mark in path for mark in "*?[{"):
        return table
    reader = spark.read.schema(table.schema)
    alone = names[0].rsplit("/", 1)[-1] == path.rstrip("/").rsplit("/", 1)[-1]
    if not alone:
        reader = reader.option("basePath", path)
    return reader.parquet(*names)


def listed_name(path: Column) -> Column:
    """A ``_metadata.file_path`` as the name that :func:`list_files` gives the file."""
    encoded = F.regexp_replace(path, "\\+", "%2B")
    return F.regexp_replace(F.url_decode(encoded), "^([A-Za-z][A-Za-z0-9+.-]*):///(?!/)", "$1:/")


def _footer_reader(column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [_footer_facts(f, column) for f in batch.column("file").to_pylist()]
            rows = [t or (None, None, None, None) for t in told]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 4
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns, pa.array([t is not None for t in told], pa.bool_())],
                names=[*batch.schema.names, "row_count", "null_count", "low", "high", "known"],
            )

    return run


def _footer_facts(file: str, column: str) -> tuple[int, int, int | None, int | None] | None:
    """Rows, NULLs, least and largest value by the footer of a file; None if it cannot tell."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    if f"/{column.lower()}=" in file.lower():
        return None  # a directory column, which files do not hold
    try:
        where = "file://" + file[5:] if file.startswith("file:/") and not file.startswith("file:///") else file
        if where.startswith("file:///"):
            store, name = fs.LocalFileSystem(), where[len("file://") :]
        else:
            store, name = fs.FileSystem.from_uri(where)
        with store.open_input_file(name) as opened:
            return _column_facts(pq.read_metadata(opened), column)
    except (OSError, ValueError, NotImplementedError, pa.ArrowException):
        return None


def _column_facts(footer: Any, column: str) -> tuple[int, int, int | None, int | None] | None:
    names = [footer.schema.column(i).path for i in range(footer.num_columns)]
    if column in names:
        at = names.index(column)
    else:
        alike = [i for i, n in enumerate(names) if n.lower() == column.lower()]
        if len(alike) > 1:
            return None
        if not alike:
            inside = any(n.lower().startswith(column.lower() + ".") for n in names)
            return None if inside else (footer.num_rows, footer.num_rows, None, None)
        at = alike[0]
    scale = _axis_scale(footer.schema.column(at))
    if scale is None:
        return None
    nulls, low, high = 0, None, None
    for i in range(footer.num_row_groups):
        group = footer.row_group(i)
        of_group = group.column(at).statistics
        if not group.num_rows:
            continue
        if of_group is None or not of_group.has_null_count:
            return None
        nulls += of_group.null_count
        if of_group.null_count == group.num_rows:
            continue
        if not of_group.has_min_max:
            return None
        least, largest = of_group.min_raw * scale, of_group.max_raw * scale
        low = least if low is None else min(low, least)
        high = largest if high is None else max(high, largest)
    return footer.num_rows, nulls, low, high


def _axis_scale(column: Any) -> int | None:
    """Axis units in a unit of the stored number; None if statistics do not serve."""
    if column.physical_type not in ("INT32", "INT64") or column.max_repetition_level:
        return None
    kind = column.logical_type.type
    if kind in ("NONE", "DATE"):
        return 1
    if kind == "INT":
        return 1 if '"isSigned": true' in column.logical_type.to_json() else None
    if kind == "TIMESTAMP":
        units = {'"milliseconds"': MICROS // 1000, '"microseconds"': 1}
        written = column.logical_type.to_json()
        return next((scale for unit, scale in units.items() if unit in written), None)
    return None


def from_axis(place: Column, dtype: T.DataType) -> Column:
    """The value of ``dtype`` at a 64-bit position, as a column."""
    if isinstance(dtype, T.DateType):
        return F.date_from_unix_date(place.cast("int"))
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(place)
    if isinstance(dtype, T.TimestampNTZType):
        seconds = (place.cast("decimal(20,0)") / F.lit(MICROS)).cast("decimal(18,6)")
        return F.lit("1970-01-01 00:00:00").cast(dtype) + F.make_dt_interval(secs=seconds)
    return place.cast(dtype)


def facts_range(facts: DataFrame, field: T.StructField, past: int | None = None) -> ColumnRange:
    """The range of a column by the facts of its files: one small aggregate.

    With ``past``, a position, only the top is known, and only if it lies past that.
    """
    low, high = F.min("low"), F.max("high")
    if past is not None:
        low, high = F.lit(None).cast("bigint"), F.max(F.expr(f"IF(high > {past}L, high, NULL)"))
    extremes = facts.agg(low.alias("l"), high.alias("h")).select(
        from_axis(F.col("l"), field.dataType).alias("min_value"),
        from_axis(F.col("h"), field.dataType).alias("max_value"),
    )
    return read_range(extremes, field.name, field.dataType)
