"""Sources Spark scans itself: a DataFrame, a query, a catalog table, or files."""

from __future__ import annotations

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import LoadError
from tidemark.sources.spec import LoadSpec


def open_frame(spark: SparkSession, spec: LoadSpec) -> DataFrame:
    """The whole source as a lazy DataFrame; pruning and push-down are Catalyst's."""
    if isinstance(spec.table, DataFrame):
        return spec.table
    if spec.query:
        return spark.sql(spec.query)
    if is_catalog_table(spark, spec):
        return spark.table(spec.table)
    if spec.named_table:
        raise LoadError(f"could not find table {spec.table}")
    return spark.read.format(spec.format).options(**spec.reader_options).load(spec.table)


def is_catalog_table(spark: SparkSession, spec: LoadSpec) -> bool:
    if not isinstance(spec.table, str) or "/" in spec.table:
        return False
    try:
        return spark.catalog.tableExists(spec.table)
    except ParseException:  # no table name, so a path
        return False
