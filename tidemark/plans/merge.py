"""Merge of increments into a table of Parquet files, the newest row of each key kept.

Copy on write: a merge rewrites the files that hold one of its keys and leaves the others as they are.
Files are never changed or removed, so a frame that was opened before goes on reading its version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import LoadError, OptionError
from tidemark.functions.types import free_name, quoted
from tidemark.operators.dedup import dedup_latest, resolve_keys
from tidemark.sinks.runs import RunLog, read_if_there
from tidemark.sinks.staging import stage
from tidemark.sources.footers import NAMED_FILES, listed_name


class MergeTarget:
    """A folder that holds one row per key, in versions.

    Its data files lie in ``files/<run>``.  ``changes`` has a row for each file that a run adds, with its rows
    and the range of the first key column, and for each that it takes out of the table.  ``log`` tells
    which runs count.  Writers may overlap: the later to publish fails and changes nothing.

    The newest row is the one with the largest ``order_column``; ties and NULLs fall as in
    ``dedup_latest``, and NULL keys are equal to each other.
    """

    def __init__(self, spark: SparkSession, folder: str, primary_keys: Sequence[str], order_column: str):
        if not primary_keys:
            raise OptionError("at least one key column is needed")
        self._spark, self._folder = spark, folder.rstrip("/")
        self._keys, self._order = list(primary_keys), order_column
        self._log = RunLog(spark, folder)

    def read(self) -> DataFrame:
        """The newest version."""
        last = self._last()
        return self._open(self.files(), _row_schema(last))

    def next_offset(self) -> str | None:
        """The offset that the newest version was merged with; None in a new folder."""
        last = self._log.last()
        return last.next_offset if last else None

    def files(self) -> DataFrame:
        """``file, row_count, low, high, has_null`` of the files of the newest version; the range
        is that of the first key column."""
        empty = self._spark.createDataFrame([], _row_schema(self._last()))
        return self._live(_type_of(empty, self._keys[0]))

    def merge(self, rows: DataFrame, next_offset: str | None = None) -> int:
        """Merge the newest row of each key of ``rows`` and return the version that this makes.

        ``rows`` have the columns of the table, in any order.  They are staged, so that their source is read once.
        """
        last = self._log.last()
        keys = resolve_keys(rows, self._keys)
        if last is not None:
            rows = _as_before(rows, _row_schema(last))
        rows = stage(dedup_latest(rows, keys, self._order))
        first_key = _type_of(rows, keys[0])
        run = uuid.uuid4().hex
        # Each key has two rows at most, so ranges of keys are even, and one shuffle serves the newest row
        # of a key as well as files that hold neighbouring keys.
        in_order = [quoted(k) for k in keys]
        if last is None:
            merged, taken = rows.repartitionByRange(*in_order), None
        else:
            taken = stage(self._matched(rows, keys, first_key))
            both = self._open(taken, rows.schema).unionByName(rows).repartitionByRange(*in_order)
            merged = dedup_latest(both, keys, self._order)
        merged.write.parquet(f"{self._folder}/files/{run}")
        self._write_changes(run, rows.schema, keys[0], taken)
        version = last.version + 1 if last else 1
        self._log.publish(version, run, next_offset, rows.schema.json())
        return version

    def _last(self) -> Row:
        last = self._log.last()
        if last is None:
            raise LoadError(f"nothing has been merged into {self._folder}")
        return last

    def _live(self, first_key: T.DataType) -> DataFrame:
        changes = read_if_there(self._spark, f"{self._folder}/changes", _changes(first_key))
        counted = changes.join(self._log.runs().select("run"), "run", "left_semi")
        taken = counted.where("NOT added").select("file")
        return counted.where("added").drop("run", "added").join(taken, "file", "left_anti")

    def _matched(self, rows: DataFrame, keys: list[str], first_key: T.DataType) -> DataFrame:
        """``file`` of the files that hold a key of ``rows``.

        Files whose range of the first key column does not meet that of the rows are not opened; of the
        others only the key columns are read.
        """
        first = quoted(keys[0])
        least, largest = rows.agg(F.min(first)).scalar(), rows.agg(F.max(first)).scalar()
        without = rows.agg(F.count_if(first.isNull())).scalar()
        meets = (F.col("low") <= largest) & (F.col("high") >= least)
        near = self._live(first_key).where(meets | (F.col("has_null") & (without > 0)))
        held = self._open(near, rows.schema, path_as="path")
        path = quoted(held.columns[-1]).alias("path")
        held = held.select(*[quoted(k).alias(f"k{i}") for i, k in enumerate(keys)], path)
        wanted = rows.select(*[quoted(k).alias(f"n{i}") for i, k in enumerate(keys)])
        same = reduce(and_, [F.col(f"k{i}").eqNullSafe(F.col(f"n{i}")) for i in range(len(keys))])
        paths = held.join(wanted, same, "left_semi").select("path").distinct()
        return paths.select(listed_name(F.col("path")).alias("file"))

    def _open(self, files: DataFrame, schema: T.StructType, path_as: str | None = None) -> DataFrame:
        """The rows of some files; with ``path_as`` the path of each row's file comes as last column.

        More files than NAMED_FILES are not named one by one: all are opened and met with the list.
        """
        names = [r.file for r in files.select("file").limit(NAMED_FILES + 1).collect()]
        if not names:
            frame = self._spark.createDataFrame([], schema)
            return frame.withColumn(free_name(frame, path_as), F.lit("")) if path_as else frame
        reader, path = self._spark.read.schema(schema), F.col("_metadata.file_path")
        if len(names) <= NAMED_FILES:
            frame = reader.parquet(*names)
            return frame.select("*", path.alias(free_name(frame, path_as))) if path_as else frame
        frame = reader.option("recursiveFileLookup", "true").parquet(f"{self._folder}/files")
        at = free_name(frame, path_as or "path")
        frame = frame.select("*", path.alias(at))
        wanted = files.select(F.col("file").alias(f"{at}_"))
        frame = frame.join(wanted, listed_name(quoted(at)) == quoted(f"{at}_"), "left_semi")
        return frame if path_as else frame.drop(at)

    def _write_changes(
        self, run: str, schema: T.StructType, first_key: str, taken: DataFrame | None
    ) -> None:
        written = self._spark.read.schema(schema).parquet(f"{self._folder}/files/{run}")
        key = quoted(first_key)
        by_path = written.groupBy(F.col("_metadata.file_path").alias("path")).agg(
            F.count("*").alias("row_count"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            (F.count_if(key.isNull()) > 0).alias("has_null"),
        )
        added = by_path.withColumn("path", listed_name(F.col("path"))).withColumnRenamed("path", "file")
        changes = added.select(F.lit(run).alias("run"), F.lit(True).alias("added"), "*")
        if taken is not None:
            gone = taken.select(F.lit(run).alias("run"), F.lit(False).alias("added"), "file")
            changes = changes.unionByName(gone, allowMissingColumns=True)
        changes.write.mode("append").parquet(f"{self._folder}/changes")


def _changes(first_key: T.DataType) -> T.StructType:
    changes = T.StructType.fromDDL("run string, added boolean, file string, row_count bigint")
    return changes.add("low", first_key).add("high", first_key).add("has_null", "boolean")


def _type_of(df: DataFrame, column: str) -> T.DataType:
    return df.select(quoted(column)).schema[0].dataType


def _row_schema(last: Row) -> T.StructType:
    return T.StructType.fromJson(json.loads(last.row_schema))


def _as_before(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """``rows`` with the columns of the table in its order; an error if they are others."""
    ours = {f.name.lower(): f.dataType.simpleString() for f in schema}
    theirs = {f.name.lower(): f.dataType.simpleString() for f in rows.schema}
    if ours != theirs:
        differ = sorted(k for k in ours.keys() | theirs.keys() if ours.get(k) != theirs.get(k))
        raise LoadError(f"rows to merge differ from the table in {', '.join(differ)}")
    columns: list[Column] = [quoted(f.name) for f in schema]
    return rows.select(*[c.alias(f.name) for c, f in zip(columns, schema)])
