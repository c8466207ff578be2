"""Text encoding of binary columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import quoted


def base64_binary_columns(df: DataFrame) -> DataFrame:
    """Encode every top-level binary column as base64 text, names and order kept.

    Spark may break long base64 text into lines; the breaks are removed so that
    the result is the same under every setting.
    """
    if not any(isinstance(f.dataType, T.BinaryType) for f in df.schema):
        return df
    return df.select(
        *[
            F.replace(F.base64(quoted(f.name)), F.lit("\r\n"), F.lit("")).alias(
                f.name, metadata=f.metadata
            )
            if isinstance(f.dataType, T.BinaryType)
            else quoted(f.name)
            for f in df.schema
        ]
    )
