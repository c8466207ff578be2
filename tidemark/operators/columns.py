"""Facts about columns, next to what one pass over the table counts in them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.types import quoted


def column_facts(df: DataFrame, facts: Sequence[Mapping[str, Any]], fields: str) -> DataFrame:
    """Rows of ``facts`` with ``value_count`` (non-NULL values) and ``row_count``.

    Each fact names its column by position under the key ``at``; ``fields`` lists the
    other keys and their types.  The facts go into the plan as one text literal, which
    stays cheap for tables of many columns.
    """
    counts = F.array(*[F.count(quoted(f.name)) for f in df.schema])
    listed = F.from_json(F.lit(json.dumps(list(facts))), f"array<struct<at: int, {fields}>>")
    counted = df.agg(counts.alias("__value_counts"), F.count("*").alias("row_count"))
    return (
        counted.select("__value_counts", "row_count", F.inline(listed))
        .withColumn("value_count", F.get("__value_counts", "at"))
        .drop("__value_counts", "at")
    )
