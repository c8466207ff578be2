"""Provenance: where a loaded frame came from, kept on every column of its schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tidemark.functions.types import quoted
from tidemark.operators.columns import column_facts

# The provenance keys.
PROVENANCE_KEYS = (
    "tableName",
    "loadType",
    "lastOffset",
    "numPartitions",
    "sparkApplicationId",
    "partitionColumn",
)


def with_provenance(df: DataFrame, details: Mapping[str, str | int]) -> DataFrame:
    """Add ``details`` to the metadata of every column, next to what is there already.

    Metadata follows a column through later projections and into Parquet files, so
    ``details`` must hold no credentials.
    """
    # An alias per column, and not ``DataFrame.to``, whose metadata is lost on write.
    return df.select(
        *[quoted(f.name).alias(f.name, metadata={**f.metadata, **details}) for f in df.schema]
    )


def provenance_rows(df: DataFrame, counts: bool = False) -> DataFrame:
    """Provenance as rows ``(column, key, value)``, from the schema alone: no job reads ``df``.

    With ``counts`` one pass over ``df`` adds ``value_count``, the number of non-NULL values that
    the load put in the column.
    """
    facts = [
        {"at": i, "column": f.name, "key": key, "value": str(f.metadata[key])}
        for i, f in enumerate(df.schema)
        for key in PROVENANCE_KEYS
        if key in f.metadata
    ]
    if counts:
        return column_facts(df, facts, "column: string, key: string, value: string").drop("row_count")
    listed = [fact[name] for fact in facts for name in ("column", "key", "value")]
    # An inline table, which is a local relation; one row more keeps it from being empty.
    rows = ", ".join(["('', '', '')", *["(?, ?, ?)"] * len(facts)])
    spark = df.sparkSession
    inline = spark.sql(f"SELECT * FROM VALUES {rows} AS t(column, key, value)", args=listed)
    return inline.where("key <> ''")
