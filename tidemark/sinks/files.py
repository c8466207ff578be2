"""File sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidemark.functions.types import quoted


def write_files(
    df: DataFrame,
    path: str,
    format: str = "parquet",
    mode: str = "error",
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
    **options: str,
) -> None:
    """Write in any file format and save mode, optionally into partition directories.

    As it stands each task writes a file into every directory it has rows for, and
    nothing is shuffled: 8 tasks that write 3 values of ``partition_by`` make up to 24 files, and
    10,000 tasks 30,000, so partitioned writes of large tables should rebalance.  ``rebalance`` trades one shuffle for fewer, evenly sized
    files; Spark then merges small partitions and splits large ones, so a directory
    that holds most of the rows is still written by many tasks.
    """
    if rebalance:
        df = df.hint("rebalance", *[quoted(c) for c in partition_by])
    writer = df.write.format(format).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
