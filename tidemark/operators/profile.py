"""Table facts, each in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import WHOLE_NUMBERS, free_name, is_splittable, quoted
from tidemark.operators.columns import column_facts
from tidemark.operators.dedup import resolve_keys

# Fixed value: the row size reported when there is nothing to measure.
DEFAULT_ROW_SIZE = 5000

# Bytes and decimal digits of the fixed-width types.
WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
    T.DateType: 4,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DayTimeIntervalType: 8,
    T.YearMonthIntervalType: 4,
}
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def record_count(spark: SparkSession, query: str) -> DataFrame:
    """One row ``record_count``: first column of the query's first row, as a bigint."""
    return first_as_count(spark.sql(query))


def first_as_count(result: DataFrame) -> DataFrame:
    """The first column of a result of one row; a result of several rows is an error."""
    only = F.when(
        F.count("*") > 1,
        F.raise_error(F.lit("a record count is a query with one row, this one has several")),
    ).otherwise(F.max(quoted(result.columns[0]).cast("bigint")))
    rows = F.count("*").alias("__rows")
    counted = result.agg(only.cast("bigint").alias("record_count"), rows)
    return counted.where("__rows > 0").select("record_count")


def field_profile(df: DataFrame, auto_increment: bool = False) -> DataFrame:
    """One row per column: name, type, precision, scale, nullable, splittable, null_count.

    ``nullable`` is what the schema says (Parquet columns all are), ``null_count`` what the rows say.
    With ``auto_increment`` there is a column of that name, by :func:`auto_increments`.
    """
    facts = [
        {
            "at": i,
            "name": f.name,
            "type": f.dataType.simpleString(),
            "precision": _precision(f.dataType),
            "scale": _scale(f.dataType),
            "nullable": f.nullable,
            "splittable": is_splittable(f.dataType),
        }
        for i, f in enumerate(df.schema)
    ]
    fields = "name: string, type: string, precision: int, scale: int, nullable: boolean, splittable: boolean"
    profile = (
        column_facts(df, facts, fields)
        .withColumn("null_count", F.col("row_count") - F.col("value_count"))
        .drop("row_count", "value_count")
    )
    if not auto_increment:
        return profile
    # at most one row a column
    found = F.broadcast(auto_increments(df).selectExpr("name", "auto_increment AS counted"))
    joined = profile.join(found, "name", "left")
    return joined.withColumn("auto_increment", F.coalesce("counted", F.lit(False))).drop("counted")


def auto_increments(df: DataFrame) -> DataFrame:
    """``name, auto_increment`` of each whole-number column: whether it numbers the rows.

    Such a column has a value in every row, no value twice, and none left out between the least and
    the largest.  Extremes and counts rule out most columns first: without gaps and repeats
    the range is as wide as the table has rows.  The values of those that are left go into bitmaps of
    32,768 consecutive values each, whose set bits are counted: a bit a row, and exact.  Values are
    shuffled to their bitmap before that, so that rows in any order build each bitmap once.
    A table without rows has no such column.
    """
    columns = [f.name for f in df.schema if isinstance(f.dataType, WHOLE_NUMBERS)]
    if not columns:
        return df.sparkSession.createDataFrame([], "name string, auto_increment boolean")
    wide = "decimal(38,0)"
    dense = [
        (F.count(quoted(c)) == F.count(F.lit(1)))
        & (F.max(quoted(c)).cast(wide) - F.min(quoted(c)).cast(wide) + 1 == F.count(F.lit(1)).cast(wide))
        for c in columns
    ]
    # one row, which the optimiser puts into the second pass as a value
    candidates = df.agg(F.array(*[F.coalesce(d, F.lit(False)) for d in dense]).alias("dense")).scalar()
    values = [
        F.when(F.get(candidates, F.lit(i)), F.struct(F.lit(i).alias("at"), quoted(c).cast("bigint").alias("v")))
        for i, c in enumerate(columns)
    ]
    listed = df.select(F.explode(F.array_compact(F.array(*values))).alias("of"))
    bits = listed.select(
        F.col("of.at").alias("at"),
        F.bitmap_bucket_number("of.v").alias("bucket"),
        F.bitmap_bit_position("of.v").alias("bit"),
    )
    bitmaps = bits.repartition("at", "bucket").groupBy("at", "bucket")
    counted = bitmaps.agg(
        F.bitmap_count(F.bitmap_construct_agg("bit")).alias("distinct"), F.count("*").alias("rows")
    )
    unique = counted.groupBy("at").agg((F.sum("distinct") == F.sum("rows")).alias("unique"))
    names = F.array(*map(F.lit, columns))
    every = unique.agg(F.map_from_entries(F.collect_list(F.struct("at", "unique"))).alias("u"))
    listed = every.select("u", F.posexplode(names).alias("at", "name"))
    return listed.select("name", F.coalesce(F.try_element_at("u", "at"), F.lit(False)).alias("auto_increment"))


def _precision(dtype: T.DataType) -> int | None:
    return dtype.precision if isinstance(dtype, T.DecimalType) else DIGITS.get(type(dtype))


def _scale(dtype: T.DataType) -> int | None:
    if isinstance(dtype, T.DecimalType):
        return dtype.scale
    return 0 if type(dtype) in DIGITS else None


def avg_row_size(df: DataFrame) -> DataFrame:
    """One row ``avg_row_size``: mean bytes per row, rounded down; 5000 for no rows.

    Only columns of variable width are read; the others count with their width, NULL or not, at
    the top level and inside structs, arrays and maps alike, as they do in a row's memory.
    """
    fixed = sum(w for w in (_fixed_width(f.dataType) for f in df.schema) if w is not None)
    size = F.lit(fixed).cast("bigint")
    for f in df.schema:
        if _fixed_width(f.dataType) is None:
            size = size + F.coalesce(_bytes(quoted(f.name), f.dataType), F.lit(0))
    mean = F.call_function("div", F.sum(size), F.nullif(F.count("*"), F.lit(0)))
    return df.agg(F.coalesce(mean, F.lit(DEFAULT_ROW_SIZE).cast("bigint")).alias("avg_row_size"))


def _fixed_width(dtype: T.DataType) -> int | None:
    if isinstance(dtype, T.DecimalType):
        return 8 if dtype.precision <= 18 else 16
    return WIDTHS.get(type(dtype))


def _bytes(c: Column, dtype: T.DataType) -> Column:
    """Bytes of one value of variable width."""
    width = _fixed_width(dtype)
    if width is not None:
        return F.lit(width).cast("bigint")
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return F.octet_length(c).cast("bigint")
    if isinstance(dtype, T.StructType):
        parts = [F.coalesce(_bytes(c[f.name], f.dataType), F.lit(0)) for f in dtype]
        return sum(parts, F.lit(0).cast("bigint"))
    if isinstance(dtype, T.ArrayType):
        width = _fixed_width(dtype.elementType)
        if width is not None:
            return F.size(c).cast("bigint") * width
        return F.aggregate(
            c,
            F.lit(0).cast("bigint"),
            lambda acc, x: acc + F.coalesce(_bytes(x, dtype.elementType), F.lit(0)),
        )
    if isinstance(dtype, T.MapType):
        keys = _bytes(F.map_keys(c), T.ArrayType(dtype.keyType))
        values = _bytes(F.map_values(c), T.ArrayType(dtype.valueType))
        return keys + values
    return F.octet_length(F.to_json(F.struct(c))).cast("bigint")


def key_check(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Are these columns a primary key?

    One row: ``row_count``, ``null_key_rows``, ``duplicate_groups``,
    ``surplus_rows`` (rows beyond the first of their key), ``is_key``.
    """
    names = resolve_keys(df, keys)
    counted = free_name(df, "__rows")
    per_key = df.groupBy(*[quoted(k) for k in names]).agg(F.count("*").alias(counted))
    rows = quoted(counted)
    missing = F.lit(False)
    for k in names:
        missing = missing | quoted(k).isNull()
    facts = per_key.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.when(missing, rows)), F.lit(0)).alias("null_key_rows"),
        F.count_if(rows > 1).alias("duplicate_groups"),
        F.coalesce(F.sum(rows - 1), F.lit(0)).alias("surplus_rows"),
    )
    return facts.withColumn("is_key", (F.col("null_key_rows") == 0) & (F.col("surplus_rows") == 0))
