"""JDBC table sink."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "error", **properties: str) -> None:
    """Write to a database table: append, overwrite, ignore or error.

    Spark's own properties apply, such as ``batchsize``, ``truncate`` and
    ``numPartitions`` (the largest number of connections).
    """
    df.write.jdbc(url, table, mode=mode, properties=properties)
