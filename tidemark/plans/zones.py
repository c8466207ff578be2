"""Zone maps: which files of a path can hold rows of a range.

A zone map is a Parquet table beside the data: for each file of a path its length, time of change, rows,
NULLs and the range of one column.  A refresh lists the path and reads the footers of the files
that are new or changed; facts of files that are gone no longer count.  An increment then opens
only the files whose range ends past its offset, and knows its top before any row is read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import OptionError
from tidemark.functions.types import axis, offset_literal, splittable_field
from tidemark.plans.ranges import ColumnRange
from tidemark.sources.footers import (
    FACTS,
    FILE_TYPES,
    LISTED,
    NAMED_FILES,
    SAME_FILE,
    facts_of,
    facts_range,
    list_files,
    open_files,
)

ZONES = f"path string, column string, {LISTED}, {FACTS}"


class ZoneMap:
    """The zones of one column of a path of Parquet files, kept in ``folder``.

    One folder may hold the zones of several paths and columns.  Runs that refresh it at the same time
    may read a file's footer twice, but each file counts once.
    """

    def __init__(self, spark: SparkSession, path: str, column: str, folder: str):
        self._spark, self._path, self._folder = spark, path, folder.rstrip("/")
        self.field = splittable_field(spark.read.parquet(path), column)
        if not isinstance(self.field.dataType, FILE_TYPES):
            raise OptionError(f"column {column!r} has type {self.field.dataType.simpleString()}; a zone "
                              "map needs a 64-bit whole number, date or timestamp")

    def _known(self) -> DataFrame:
        schema = T.StructType.fromDDL(ZONES)
        try:
            kept = self._spark.read.schema(schema).parquet(self._folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            kept = self._spark.createDataFrame([], schema)
        own = (F.col("path") == self._path) & (F.col("column") == self.field.name)
        return kept.where(own).drop("path", "column")

    def refresh(self) -> ZoneMap:
        """Add the facts of files that have none yet."""
        listed = list_files(self._spark, self._path)
        new = listed.join(self._known().select(*SAME_FILE), SAME_FILE, "left_anti")
        facts = facts_of(self._spark, self._path, self.field.name, new)
        named = facts.select(F.lit(self._path).alias("path"), F.lit(self.field.name).alias("column"), "*")
        named.write.mode("append").parquet(self._folder)
        return self

    def facts(self) -> DataFrame:
        """``file, length, modified, row_count, null_count, low, high`` of the files that are there now
        and whose facts are known."""
        once = self._known().dropDuplicates(SAME_FILE)
        return list_files(self._spark, self._path).join(once, SAME_FILE)

    def position(self, offset: str) -> int:
        """An offset on the column's axis."""
        literal = offset_literal(offset, self.field.dataType).cast(self.field.dataType)
        (row,) = self._spark.range(1).select(axis(literal, self.field.dataType).alias("p")).collect()
        return int(row.p)

    def open(self, offset: str | None) -> tuple[DataFrame, ColumnRange]:
        """The files that can hold rows past ``offset`` (all, without one) as a frame, and the range.

        Of an increment only the top is known.  Files that came after the last refresh are left out
        of both.
        """
        facts = self.facts()
        past = None if offset is None else self.position(offset)
        if past is not None:
            facts = facts.where(F.col("high") > F.lit(past))
        names = [r.file for r in facts.select("file").limit(NAMED_FILES + 1).collect()]
        found = facts_range(facts, self.field, past)
        return open_files(self._spark, self._path, names), found
