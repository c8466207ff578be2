"""JDBC tables, read by one query per stride.

The work of a load is split into SQL conditions over the partition column, so N
tasks query the database at the same time and each streams its own rows.

Bounds of wall-clock timestamps are the database's own values, whatever the time
zones of the session, the driver and the connection.  So they are asked for without a
zone; MySQL and MariaDB, whose drivers shift timestamps between zones (and whose
TIMESTAMP is always read as an instant), are asked for them as text and given text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T

from tidemark.errors import LoadError, OptionError
from tidemark.functions.types import (
    in_zone,
    is_number,
    is_timestamp,
    offset_literal,
    require_splittable,
)
from tidemark.operators.profile import first_as_count
from tidemark.plans.ranges import ColumnRange, bare_condition, read_range
from tidemark.plans.strides import (
    StridePlan,
    plan_strides,
    salted_predicates,
    sql_literal,
    stride_predicates,
)
from tidemark.sources.spec import LoadSpec

# URL prefixes of MySQL and MariaDB.
MYSQL_URLS = ("jdbc:mysql:", "jdbc:mariadb:")

# Strides that one counting query tells apart.
COUNTED_AT_ONCE = 500

# Rows per network round trip unless the caller says otherwise: most drivers would
# by default hold a whole stride in memory.
FETCH_SIZE = "10000"


def is_mysql(url: str) -> bool:
    return url.lower().startswith(MYSQL_URLS)


def quote_name(url: str, name: str) -> str:
    """A column name quoted the way the database at ``url`` quotes names."""
    mark = "`" if is_mysql(url) else '"'
    return mark + name.replace(mark, mark * 2) + mark


def table_field(schema: T.StructType, table: str, column: str) -> T.StructField:
    """The field of ``column``, by its exact name or else in any case."""
    found = [f for f in schema if f.name == column] or [
        f for f in schema if f.name.lower() == column.lower()
    ]
    if len(found) != 1:
        raise LoadError(f"could not find column {column} in {table}")
    return found[0]


def table_schema(spark: SparkSession, url: str, table: str, options: Mapping[str, str]) -> T.StructType:
    return _reader(spark, url, options).option("dbtable", table).load().schema


def range_field(url: str, schema: T.StructType, table: str, column: str) -> T.StructField:
    """The partition column's field, with the type its range is computed in."""
    field = require_splittable(table_field(schema, table, column))
    if is_mysql(url) and is_timestamp(field.dataType):
        return T.StructField(field.name, T.TimestampNTZType(), field.nullable)
    return field


def range_query(url: str, table: str, field: T.StructField, where: str | None = None) -> str:
    as_text = is_mysql(url) and is_timestamp(field.dataType)
    low, high = (
        f"CAST({f}({quote_name(url, field.name)}) AS CHAR)"
        if as_text
        else f"{f}({quote_name(url, field.name)})"
        for f in ("min", "max")
    )
    query = f"SELECT {low} AS min_value, {high} AS max_value FROM {table}"
    return f"{query} WHERE {bare_condition(where)}" if where else query


def jdbc_column_range(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    where: str | None = None,
    **options: str,
) -> ColumnRange:
    """Range of a column, over the rows that pass ``where``, computed by the database.

    Spark would fetch the column to find its range, so the aggregate is sent as a query.
    """
    schema = table_schema(spark, url, table, options)
    return _range(spark, url, table, range_field(url, schema, table, column), where, options)


def _range(
    spark: SparkSession,
    url: str,
    table: str,
    field: T.StructField,
    where: str | None,
    options: Mapping[str, str],
) -> ColumnRange:
    query = range_query(url, table, field, where)
    extremes = _reader(spark, url, options).option("query", query).load()
    return read_range(extremes, field.name, field.dataType)


def jdbc_record_count(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """One row ``record_count``: the scalar a query run by the database returns."""
    return first_as_count(_reader(spark, url, options).option("query", query).load())


def offset_sql(url: str, text: str, dtype: T.DataType) -> str:
    """A checked offset as SQL text, in the forms of ``sql_literal``."""
    offset_literal(text, dtype)  # raises on a malformed offset
    if is_number(dtype):
        return str(int(text))
    if isinstance(dtype, T.DateType):
        return f"{{d '{text}'}}"
    moment = f"{text[:10]} {text[11:] or '00:00:00'}"
    plain = is_mysql(url) or isinstance(dtype, T.TimestampType)
    return f"'{moment}'" if plain else f"{{ts '{moment}'}}"


def load_predicates(
    spec: LoadSpec, field: T.StructField, salt: T.StructField | None, plan: StridePlan | None
) -> list[str]:
    """One condition per parallel query; a full load also takes rows without a value."""
    name = quote_name(spec.url, field.name)
    predicates = stride_predicates(plan, name, not spec.is_incremental, is_mysql(spec.url))
    if salt is None:
        return predicates
    return salted_predicates(predicates, quote_name(spec.url, salt.name), spec.salt_buckets)


def bisected(
    spark: SparkSession, spec: LoadSpec, field: T.StructField, where: str | None, plan: StridePlan
) -> StridePlan:
    """A plan of which every stride holds at most ``spec.max_partition_rows`` rows.

    The database counts the rows of all strides in one grouped query.  Strides that hold more are
    halved and their halves counted by the next one, until none holds more or what is left is one
    value, which no range can part (``saltColumn`` can).  A level asks only about the strides halved last,
    and bounds the rows it reads by them.
    """
    name = quote_name(spec.url, field.name)

    def literal(position: int) -> str:
        return sql_literal(position, field.dataType, is_mysql(spec.url))

    def condition(start: int, stop: int, closed: bool) -> str:
        return f"{name} >= {literal(start)} AND {name} {'<=' if closed else '<'} {literal(stop)}"

    def counts(strides: list[tuple[int, int, bool]]) -> dict[int, int]:
        cases = " ".join(f"WHEN {condition(*s)} THEN {i}" for i, s in enumerate(strides))
        within = condition(strides[0][0], *strides[-1][1:])
        if where:
            within = f"({bare_condition(where)}) AND {within}"
        numbered = f"SELECT CASE {cases} END AS stride_number FROM {spec.table} WHERE {within}"
        query = f"SELECT stride_number, COUNT(*) AS row_count FROM ({numbered}) counted GROUP BY stride_number"
        found = _reader(spark, spec.url, spec.reader_options).option("query", query).load()
        asked = found.where("stride_number IS NOT NULL").collect()  # COUNTED_AT_ONCE rows at most
        return {int(r["stride_number"]): int(r["row_count"]) for r in asked}

    settled: list[int] = []
    bounds = plan.bounds()
    open_ = [(start, stop, i == len(bounds) - 1) for i, (start, stop) in enumerate(bounds)]
    while open_:
        halves: list[tuple[int, int, bool]] = []
        for at in range(0, len(open_), COUNTED_AT_ONCE):
            some = open_[at : at + COUNTED_AT_ONCE]
            held = counts(some)
            for i, (start, stop, closed) in enumerate(some):
                middle = (start + stop + 1) // 2
                # the last stride is closed, so its top may be parted off as well
                parts = start < middle and (middle < stop or closed)
                if held.get(i, 0) <= spec.max_partition_rows or not parts:
                    settled.append(start)
                else:
                    halves += [(start, middle, False), (middle, stop, closed)]
        open_ = halves
    starts = tuple(sorted(settled))
    return StridePlan(plan.column, plan.dtype, plan.low, plan.high, 0, len(starts), starts)


def read_properties(spec: LoadSpec) -> dict[str, str]:
    """Spark's JDBC properties: the caller's own, and a fetch size if there is none."""
    given = dict(spec.reader_options)
    if not any(k.lower() == "fetchsize" for k in given):
        given["fetchsize"] = FETCH_SIZE
    return given


def open_jdbc(
    spark: SparkSession, spec: LoadSpec
) -> tuple[DataFrame, ColumnRange | None, StridePlan | None]:
    """The load as a lazy DataFrame with one partition per condition, its range and strides."""
    properties = read_properties(spec)
    if not spec.partition_column:
        return spark.read.jdbc(spec.url, spec.table, properties=properties), None, None
    schema = table_schema(spark, spec.url, spec.table, spec.reader_options)
    field = range_field(spec.url, schema, spec.table, spec.partition_column)
    salt = table_field(schema, spec.table, spec.salt_column) if spec.salt_column else None
    if salt is not None and not is_number(salt.dataType):
        raise OptionError(f"saltColumn {salt.name!r} is not a whole number column")
    where = None
    if spec.offset:
        offset = in_zone(spec.offset, spec.offset_zone, field.dataType)
        past = offset_sql(spec.url, offset, field.dataType)
        where = f"{quote_name(spec.url, field.name)} > {past}"
    found = _range(spark, spec.url, spec.table, field, where, spec.reader_options)
    plan = plan_strides(found, spec.num_partitions)
    if spec.max_partition_rows and plan is not None:
        plan = bisected(spark, spec, field, where, plan)
    predicates = load_predicates(spec, field, salt, plan)
    frame = spark.read.jdbc(spec.url, spec.table, predicates=predicates, properties=properties)
    return frame, found, plan


def _reader(spark: SparkSession, url: str, options: Mapping[str, str]) -> DataFrameReader:
    kept = {k: v for k, v in options.items() if k.lower() != "prefertimestampntz"}
    reader = spark.read.format("jdbc").option("url", url).options(**kept)
    return reader.option("preferTimestampNTZ", "true")
