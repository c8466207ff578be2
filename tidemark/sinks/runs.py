"""The log of a folder that grows by runs: which of them count, in which order.

A run first writes its files, wherever nothing reads them yet, and is then published by one row in one
file.  A run that is killed before that never counts, and what readers see does not change.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import LoadError

LOGGED = "version bigint, run string, next_offset string, row_schema string"


def read_if_there(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A Parquet folder, or no rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class RunLog:
    """Published runs of a folder, one for each version from 1.

    Of two runs that were published as the same version the earlier counts; the other one finds
    out when it looks, and has to be made again.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._path = spark, f"{folder.rstrip('/')}/log"

    def runs(self) -> DataFrame:
        """``version, run, next_offset, row_schema`` of the runs that count."""
        logged = read_if_there(self._spark, self._path, LOGGED)
        if not logged.inputFiles():
            return logged
        published = F.struct(F.col("_metadata.file_modification_time").alias("at"), *logged.columns)
        first = logged.select("version", published.alias("p")).groupBy("version").agg(F.min("p").alias("p"))
        return first.select(*[F.col(f"p.{c}").alias(c) for c in logged.columns])

    def last(self) -> Row | None:
        """The newest run, None in a new folder."""
        return self.runs().orderBy(F.desc("version")).first()

    def publish(self, version: int, run: str, next_offset: str | None, row_schema: str = "") -> None:
        row = self._spark.createDataFrame([(version, run, next_offset, row_schema)], LOGGED)
        row.coalesce(1).write.mode("append").parquet(self._path)
        if self.runs().where((F.col("version") == version) & (F.col("run") == run)).isEmpty():
            raise LoadError(f"another run was published as version {version} first; make this one again")
