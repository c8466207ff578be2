"""Queries over the test tables, and the SQL that checks them.

Every query goes through the library's public API and reads whole tables.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.sinks.staging import fresh_path

try:  # the operators for training data are an optional part, with libraries of their own
    import tidemark.llm.queries as training_data
except ModuleNotFoundError as missing:
    if not (missing.name or "").startswith(("tidemark.llm", "corpus_pipeline")):
        warnings.warn(f"no queries for training data: {missing}", stacklevel=2)
    training_data = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"
LINE_KEYS = ["l_orderkey", "l_linenumber"]
NULLED_KEY = "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderkey END"


def entry(spark: SparkSession) -> DataFrame:
    """Incremental load of events by timestamp."""
    return incr_timestamp(spark, SMOKE_DIR)


def _path(sf_dir: str, table: str) -> str:
    return f"{sf_dir.rstrip('/')}/{table}.parquet"


def _view(spark: SparkSession, sf_dir: str, table: str) -> str:
    name = f"loaded_{table}"
    spark.read.parquet(_path(sf_dir, table)).createOrReplaceTempView(name)
    return name


def _full(spark: SparkSession, column: str, strides: int | None = None) -> tm.Loader:
    load = tm.loader(spark).options(loadType="full", partitionColumn=column)
    return load.option("numPartitions", strides) if strides else load


def _incremental(
    spark: SparkSession, column: str, offset: str, strides: int | None = None
) -> tm.Loader:
    load = tm.loader(spark).options(partitionColumn=column, offset=offset)
    return load.option("numPartitions", strides) if strides else load


# --- loads ------------------------------------------------------------------


def full_scan(spark, sf_dir):
    return tm.loader(spark).option("loadType", "full").load(_path(sf_dir, "customer")).df


def bootstrap_scan(spark, sf_dir):
    return tm.loader(spark).option("dbtable", _view(spark, sf_dir, "supplier")).load().df


def full_ranged(spark, sf_dir):
    load = _full(spark, "o_orderkey", 8).option("layout", "stride")
    return load.load(_path(sf_dir, "orders")).df


def _orders_nulled(spark, sf_dir):
    return spark.read.parquet(_path(sf_dir, "orders")).withColumn("k", F.expr(NULLED_KEY))


def full_ranged_nulls(spark, sf_dir):
    load = _full(spark, "k", 8).option("layout", "stride")
    return load.load(_orders_nulled(spark, sf_dir)).df


def incr_numeric(spark, sf_dir):
    return _incremental(spark, "o_orderkey", "2000").load(_path(sf_dir, "orders")).df


def incr_numeric_footers(spark, sf_dir):
    load = _incremental(spark, "o_orderkey", "2000").option("footerStats", True)
    return load.load(_path(sf_dir, "orders")).df


def incr_timestamp_footers(spark, sf_dir):
    load = _incremental(spark, "ts", "2024-01-10 00:00:00").option("footerStats", True)
    return load.load(_path(sf_dir, "events")).df


def incr_zone_map(spark, sf_dir):
    """Two runs over a folder that grows, each opening the files past its offset by the zone map."""
    events, path, zones = spark.read.parquet(_path(sf_dir, "events")), fresh_path(spark), fresh_path(spark)
    horizon = F.lit("2024-01-20 06:00:00").cast("timestamp_ntz")
    events.where(F.col("ts") <= horizon).repartitionByRange(6, "ts").write.parquet(path)
    first = _incremental(spark, "ts", "2024-01-10 00:00:00").option("zoneMap", zones).load(path)
    events.where(F.col("ts") > horizon).repartitionByRange(3, "ts").write.mode("append").parquet(path)
    second = _incremental(spark, "ts", first.next_offset).option("zoneMap", zones).load(path)
    return first.df.unionByName(second.df)


def offset_outlives_files(spark, sf_dir):
    """Two runs over a folder whose files are replaced between the first one's rows and its offset."""
    events, path = spark.read.parquet(_path(sf_dir, "events")), fresh_path(spark)
    horizon = F.lit("2024-01-20 06:00:00").cast("timestamp_ntz")
    events.where(F.col("ts") <= horizon).write.parquet(path)
    first = _incremental(spark, "ts", "2024-01-10 00:00:00").load(path)
    rows = tm.stage(first.df)
    events.write.mode("overwrite").parquet(path)
    return rows.unionByName(_incremental(spark, "ts", first.next_offset).load(path).df)


def merged_target(spark, sf_dir):
    """Two loads merged into one target: the newest line of each order over both."""
    lines, folder = spark.read.parquet(_path(sf_dir, "lineitem")), fresh_path(spark)
    horizon = F.lit("1995-06-17 00:00:00").cast("timestamp_ntz")
    at_first = lines.where(F.col("l_shipdate").isNull() | (F.col("l_shipdate") <= horizon))
    offset = _full(spark, "l_shipdate").merge_into(folder, ["l_orderkey"], at_first)
    _incremental(spark, "l_shipdate", offset).merge_into(folder, ["l_orderkey"], lines)
    return tm.MergeTarget(spark, folder, ["l_orderkey"], "l_shipdate").read()


def late_rows(spark, sf_dir):
    """Three runs over a table of which every tenth row is committed a run too late, so that some of
    them lie below the first offset."""
    events, folder = spark.read.parquet(_path(sf_dir, "events")), fresh_path(spark)
    found = []
    for until, late_until in [
        ("2024-01-15 00:00:00", "2024-01-01 00:00:00"),
        ("2024-01-20 06:00:00", "2024-01-15 00:00:00"),
        ("2100-01-01 00:00:00", "2100-01-01 00:00:00"),
    ]:
        horizon = F.when(F.col("event_id") % 10 == 0, late_until).otherwise(until)
        there = events.where(F.col("ts") <= horizon.cast("timestamp_ntz"))
        load = _incremental(spark, "ts", "2024-01-10 00:00:00")
        run = load.load_late(["event_id"], folder, 30 * 86_400, there)
        found.append(run.df)
        run.confirm()
    return found[0].unionByName(found[1]).unionByName(found[2])


def incr_timestamp(spark, sf_dir):
    return _incremental(spark, "ts", "2024-01-10 00:00:00").load(_path(sf_dir, "events")).df


def incr_timestamp_t(spark, sf_dir):
    return _incremental(spark, "ts", "2024-01-15T12:00:00").load(_path(sf_dir, "events")).df


def incr_date(spark, sf_dir):
    orders = spark.read.parquet(_path(sf_dir, "orders"))
    dated = orders.withColumn("d", F.col("o_orderdate").cast("date"))
    return _incremental(spark, "d", "1998-06-30").load(dated).df


def incr_empty_count(spark, sf_dir):
    loaded = _incremental(spark, "ts", "2030-01-01 00:00:00").load(_path(sf_dir, "events"))
    return loaded.df.agg(F.count("*").alias("row_count"))


def incr_pushdown(spark, sf_dir):
    loaded = _incremental(spark, "ts", "2024-01-10 00:00:00").load(_path(sf_dir, "events"))
    return loaded.df.where(F.col("event_type") == "click").select("event_id", "ts", "value")


def incr_chain(spark, sf_dir):
    """Two runs in a row: rows that arrive after the first are loaded by the second."""
    events = spark.read.parquet(_path(sf_dir, "events"))
    at_first = events.where(F.col("ts") <= F.lit("2024-01-20 06:00:00").cast("timestamp_ntz"))
    first = _incremental(spark, "ts", "2024-01-10 00:00:00").load(at_first)
    second = _incremental(spark, "ts", first.next_offset).load(events)
    return first.df.unionByName(second.df)


def incr_into(spark, sf_dir):
    """Two runs written to one place, each in one pass over its source."""
    events, path = spark.read.parquet(_path(sf_dir, "events")), fresh_path(spark)
    at_first = events.where(F.col("ts") <= F.lit("2024-01-20 06:00:00").cast("timestamp_ntz"))
    offset = _incremental(spark, "ts", "2024-01-10 00:00:00").load_into(path, at_first)
    _incremental(spark, "ts", offset).load_into(path, events)
    return spark.read.parquet(path)


def incr_bounded(spark, sf_dir):
    """An increment of a source that grows after its range was looked up.

    Rows past the horizon are there only in another time zone, which stands for rows that arrive
    while the load is read: they are left to the next run.
    """
    horizon = F.lit("2024-01-20 06:00:00").cast("timestamp_ntz")
    arrived = F.current_timezone() == "Etc/GMT+7"
    source = spark.read.parquet(_path(sf_dir, "events")).where((F.col("ts") <= horizon) | arrived)
    loaded = _incremental(spark, "ts", "2024-01-10 00:00:00").load(source)
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Etc/GMT+7")
    try:
        return tm.stage(loaded.df)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- ranges and strides -----------------------------------------------------


def range_full(spark, sf_dir):
    return tm.range_frame(spark.read.parquet(_path(sf_dir, "orders")), "o_orderkey")


def range_filtered(spark, sf_dir):
    orders = spark.read.parquet(_path(sf_dir, "orders"))
    return tm.range_frame(orders, "o_orderdate", "where o_totalprice > 250000")


def next_offset(spark, sf_dir):
    loaded = _incremental(spark, "ts", "2024-01-10 00:00:00").load(_path(sf_dir, "events"))
    return tm.next_offset_frame(loaded.df, "ts")


def _summary(loaded: tm.LoadResult) -> DataFrame:
    return tm.stride_summary(loaded.df, loaded.strides)


def stride_numeric(spark, sf_dir):
    return _summary(_incremental(spark, "o_orderkey", "2000", 7).load(_path(sf_dir, "orders")))


def stride_timestamp(spark, sf_dir):
    load = _incremental(spark, "ts", "2024-01-10 00:00:00", 10)
    return _summary(load.load(_path(sf_dir, "events")))


def stride_date(spark, sf_dir):
    orders = spark.read.parquet(_path(sf_dir, "orders"))
    dated = orders.select(F.col("o_orderdate").cast("date").alias("d"))
    return _summary(_full(spark, "d", 12).load(dated))


def stride_balanced(spark, sf_dir):
    """Strides of about equal rows over a skewed key, as one row of facts about them."""
    lines = spark.read.parquet(_path(sf_dir, "lineitem"))
    skewed = lines.withColumn("k", F.expr("l_orderkey * l_orderkey * 7 + l_linenumber"))
    loaded = _full(spark, "k", 16).option("balancedStrides", True).load(skewed)
    summary = tm.stride_summary(loaded.df, loaded.strides)
    return summary.agg(
        F.count("*").alias("strides"),
        F.sum("row_count").alias("row_count"),
        (F.max("row_count") <= 1.2 * F.avg("row_count")).alias("even"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
    )


def stride_predicates(spark, sf_dir):
    """Rows each condition of a parallel read selects, counted in one pass; -1: those without
    a value."""
    orders = _orders_nulled(spark, sf_dir)
    loaded = _full(spark, "k", 9).load(orders)
    conditions = tm.stride_predicates(loaded.strides, "`k`", keep_nulls=True)
    counts = [
        F.struct(
            F.lit(i if i < loaded.strides.count else -1).cast("bigint").alias("stride_id"),
            F.count_if(F.expr(condition)).alias("row_count"),
        )
        for i, condition in enumerate(conditions)
    ]
    return orders.agg(F.array(*counts).alias("counts")).select(F.inline("counts"))


def stride_layout(spark, sf_dir):
    """Rows per stride, counted from the partitions of the stride layout."""
    load = _full(spark, "k", 8).option("layout", "stride")
    loaded = load.load(_orders_nulled(spark, sf_dir))
    stride = tm.stride_id(loaded.strides)
    partitions = loaded.df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(stride).alias("stride_id"), F.max(stride).alias("last"), F.count("*").alias("n")
    )
    return partitions.groupBy("stride_id").agg(
        F.sum("n").alias("row_count"), F.bool_and(F.expr("stride_id = last")).alias("unmixed")
    )


# --- table facts ------------------------------------------------------------


def provenance_rows(spark, sf_dir):
    loaded = _incremental(spark, "o_orderkey", "2000", 7).load(_view(spark, sf_dir, "orders"))
    mine = F.col("value") == spark.conf.get("spark.app.id")
    by_session = F.when(F.col("key") == "sparkApplicationId", mine.cast("string"))
    listed = tm.provenance_rows(loaded.df, counts=True)
    return listed.withColumn("value", F.coalesce(by_session, "value"))


def record_count(spark, sf_dir):
    view = _view(spark, sf_dir, "lineitem")
    return tm.record_count(spark, f"SELECT count(*) FROM {view} WHERE l_quantity > 25")


def field_profile(spark, sf_dir):
    typed = _orders_nulled(spark, sf_dir).selectExpr(
        "*",
        "CAST(o_orderdate AS DATE) AS d",
        "CAST(o_totalprice AS DECIMAL(12, 2)) AS price",
        "o_orderkey + 0 IS NOT NULL AS keyed",
    )
    return tm.field_profile(typed)


def field_profile_footers(spark, sf_dir):
    return tm.field_profile(tm.footer_frame(spark, _path(sf_dir, "customer")))


def auto_increment(spark, sf_dir):
    """The profile of two tables with the columns that number their rows."""
    shifted = spark.read.parquet(_path(sf_dir, "orders")).withColumn("k", F.expr("7 - o_orderkey"))
    tables = {"orders": shifted, "lineitem": spark.read.parquet(_path(sf_dir, "lineitem"))}
    profiles = [
        tm.field_profile(df, auto_increment=True).select(
            F.lit(table).alias("table"), "name", "type", "null_count", "auto_increment"
        )
        for table, df in tables.items()
    ]
    return profiles[0].unionByName(profiles[1])


def avg_row_size(spark, sf_dir):
    return tm.avg_row_size(spark.read.parquet(_path(sf_dir, "orders")))


def key_check(spark, sf_dir):
    return tm.key_check(spark.read.parquet(_path(sf_dir, "lineitem")), LINE_KEYS)


NUMBERED_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")


def key_candidates(spark, sf_dir):
    """The minimal keys of lineitem among its whole-number columns."""
    lines = spark.read.parquet(_path(sf_dir, "lineitem"))
    found = tm.key_candidates(lines, NUMBERED_COLUMNS, max_columns=4)
    return found.select(F.array_join("key_columns", ",").alias("key_columns"))


# --- row transforms ---------------------------------------------------------


def normalise_timestamps(spark, sf_dir):
    events = spark.read.parquet(_path(sf_dir, "events"))
    text = F.expr(
        """CASE event_id % 4
             WHEN 0 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')
             WHEN 1 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
             WHEN 2 THEN date_format(ts, 'yyyy-MM-dd')
             ELSE date_format(ts, "yyyy-MM-dd'T'41:mm:ss") END"""
    )
    return events.select("event_id", tm.normalise_timestamp(text).alias("moment"))


def dedup_keys(spark, sf_dir):
    """The survivor of each key: how many there are, and whether a row of the table equals it."""
    lines = spark.read.parquet(_path(sf_dir, "lineitem"))
    survivors = tm.dedup_any(lines, LINE_KEYS)
    marked = survivors.withColumn("mine", F.lit(1)).unionByName(lines.withColumn("mine", F.lit(0)))
    whole_rows = marked.groupBy(*lines.columns).agg(
        F.sum("mine").alias("survivors"), F.count_if(F.col("mine") == 0).alias("rows")
    )
    return (
        whole_rows.where("survivors > 0")
        .groupBy(*LINE_KEYS)
        .agg(F.sum("survivors").alias("survivors"), F.bool_and(F.col("rows") > 0).alias("is_row"))
    )


def dedup_latest(spark, sf_dir):
    lines = spark.read.parquet(_path(sf_dir, "lineitem"))
    return tm.dedup_latest(lines, LINE_KEYS, "l_shipdate")


def dedup_latest_nested(spark, sf_dir):
    """Latest rows where the values are in a struct with a map, which Spark does not order."""
    lines = spark.read.parquet(_path(sf_dir, "lineitem")).select(
        *LINE_KEYS,
        "l_shipdate",
        F.struct(
            "l_returnflag",
            F.create_map(F.col("l_linestatus"), F.col("l_suppkey")).alias("by_status"),
        ).alias("nested"),
    )
    latest = tm.dedup_latest(lines, LINE_KEYS, "l_shipdate")
    return latest.selectExpr(
        *LINE_KEYS,
        "l_shipdate",
        "nested.l_returnflag AS flag",
        "map_keys(nested.by_status)[0] AS status",
        "map_values(nested.by_status)[0] AS supplier",
    )


def incr_dedup(spark, sf_dir):
    load = _incremental(spark, "l_shipdate", "1998-01-01 00:00:00")
    return load.load_deduplicated(LINE_KEYS, _path(sf_dir, "lineitem")).df


def base64_binary(spark, sf_dir):
    documents = spark.read.parquet(_path(sf_dir, "documents"))
    return tm.base64_binary_columns(
        documents.select("doc_id", F.col("text").cast("binary").alias("body"), "lang")
    )


# --- sinks ------------------------------------------------------------------


def sink_roundtrip(spark, sf_dir):
    path = fresh_path(spark)
    tm.write_files(spark.read.parquet(_path(sf_dir, "orders")), path, format="orc")
    return spark.read.orc(path)


def sink_partitioned(spark, sf_dir):
    path = fresh_path(spark)
    orders = spark.read.parquet(_path(sf_dir, "orders"))
    tm.write_files(orders, path, partition_by=["o_orderstatus"])
    return spark.read.parquet(path).select(*orders.columns)


def staged_parquet(spark, sf_dir):
    view = _view(spark, sf_dir, "orders")
    return tm.stage_query(
        spark, f"SELECT o_orderkey, o_totalprice FROM {view} WHERE o_totalprice > 100000"
    )


def staged_load(spark, sf_dir):
    """An increment of a query, staged as Parquet and read from there."""
    query = f"SELECT o_orderkey, o_totalprice FROM {_view(spark, sf_dir, 'orders')}"
    load = _incremental(spark, "o_orderkey", "2000").options(query=query, tempdir=fresh_path(spark))
    return load.load().df.where(F.col("o_totalprice") > 100000)


def queries() -> dict[str, Query]:
    listed = [
        full_scan,
        bootstrap_scan,
        full_ranged,
        full_ranged_nulls,
        incr_numeric,
        incr_numeric_footers,
        incr_timestamp_footers,
        incr_zone_map,
        offset_outlives_files,
        merged_target,
        late_rows,
        incr_timestamp,
        incr_timestamp_t,
        incr_date,
        incr_empty_count,
        incr_pushdown,
        incr_chain,
        incr_into,
        incr_bounded,
        range_full,
        range_filtered,
        next_offset,
        stride_numeric,
        stride_timestamp,
        stride_date,
        stride_balanced,
        stride_predicates,
        stride_layout,
        provenance_rows,
        record_count,
        field_profile,
        field_profile_footers,
        auto_increment,
        avg_row_size,
        key_check,
        key_candidates,
        normalise_timestamps,
        dedup_keys,
        dedup_latest,
        dedup_latest_nested,
        incr_dedup,
        base64_binary,
        sink_roundtrip,
        sink_partitioned,
        staged_parquet,
        staged_load,
    ]
    found = {query.__name__: query for query in listed}
    return found | (training_data.queries() if training_data else {})


LATEST_LINE = """
    QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST,
            l_suppkey DESC NULLS LAST, l_quantity DESC NULLS LAST,
            l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
            l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST,
            l_linestatus DESC NULLS LAST) = 1
"""
LATEST_OF_ORDER = LATEST_LINE.replace("l_orderkey, l_linenumber", "l_orderkey").replace(
    "l_quantity DESC", "l_linenumber DESC NULLS LAST, l_quantity DESC"
)


def _number_strides(rows: str, n: int) -> str:
    """Stride of each row ``(x, v)`` of ``rows`` by the closed form; NULL is in stride 0."""
    return f"""
        WITH t AS ({rows}),
        r AS (SELECT min(x) AS lo, max(x) AS hi FROM t),
        p AS (SELECT lo, hi, CASE WHEN hi = lo THEN 1
                                  WHEN (hi - lo) // {n} < 1 THEN hi - lo
                                  ELSE {n} END AS n FROM r),
        s AS (SELECT CASE WHEN x IS NULL OR n = 1 THEN 0
                          ELSE least(n - 1, (x - lo) // ((hi - lo) // n)) END AS stride_id, v
              FROM t, p)
    """


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | (training_data.oracle_sql() if training_data else {})


def _oracle_sql() -> dict[str, str]:
    past_events = "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00'"
    nulled = f"SELECT *, {NULLED_KEY} AS k FROM orders"
    provenance = ", ".join(
        f"('{key}', '{value}')"
        for key, value in (
            ("tableName", "loaded_orders"),
            ("loadType", "incremental"),
            ("lastOffset", "2000"),
            ("numPartitions", "7"),
            ("partitionColumn", "o_orderkey"),
            ("sparkApplicationId", "true"),
        )
    )
    order_columns = (
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    )
    column_counts = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS value_count
            FROM orders WHERE o_orderkey > 2000"""
        for c in order_columns
    )

    def profile(*columns: tuple[str, ...]) -> str:
        return " UNION ALL ".join(
            f"""SELECT '{name}' AS name, '{kind}' AS type, CAST({precision} AS INTEGER) AS precision,
                       CAST({scale} AS INTEGER) AS scale, {not_null} AS nullable,
                       {splittable} AS splittable, count(*) FILTER (WHERE {name} IS NULL) AS null_count FROM t"""
            for name, kind, precision, scale, splittable, not_null in (
                (*c, "true")[:6] for c in columns
            )
        )

    def numbered(table: str, source: str, columns: tuple[tuple[str, str], ...]) -> str:
        whole = "count(*) > 0 AND count(DISTINCT {0}) = count(*) AND max({0}) - min({0}) + 1 = count(*)"
        return " UNION ALL ".join(
            f"""SELECT '{table}' AS "table", '{name}' AS name, '{kind}' AS type,
                       count(*) - count({name}) AS null_count,
                       {whole.format(name) if kind in ("int", "bigint") else "false"} AS auto_increment
                FROM {source}"""
            for name, kind in columns
        )

    order_types = tuple(
        zip(order_columns, ("bigint", "bigint", "string", "double", "timestamp_ntz", "string"))
    )
    line_types = (
        ("l_orderkey", "bigint"),
        ("l_partkey", "bigint"),
        ("l_suppkey", "bigint"),
        ("l_linenumber", "int"),
        ("l_quantity", "double"),
        ("l_extendedprice", "double"),
        ("l_discount", "double"),
        ("l_tax", "double"),
        ("l_returnflag", "string"),
        ("l_linestatus", "string"),
        ("l_shipdate", "timestamp_ntz"),
    )
    unique_sets = " UNION ALL ".join(
        f"""SELECT {list(s)} AS s, count(*) > 0 AND count(DISTINCT ({", ".join(s)},)) = count(*)
                   AND {" AND ".join(f"count({c}) = count(*)" for c in s)} AS is_key FROM lineitem"""
        for size in range(1, 5)
        for s in combinations(NUMBERED_COLUMNS, size)
    )
    nulled_profile = profile(
        ("o_orderkey", "bigint", "19", "0", "true"),
        ("o_custkey", "bigint", "19", "0", "true"),
        ("o_orderstatus", "string", "NULL", "NULL", "false"),
        ("o_totalprice", "double", "NULL", "NULL", "false"),
        ("o_orderdate", "timestamp_ntz", "NULL", "NULL", "true"),
        ("o_orderpriority", "string", "NULL", "NULL", "false"),
        ("k", "bigint", "19", "0", "true"),
        ("d", "date", "NULL", "NULL", "true"),
        ("price", "decimal(12,2)", "12", "2", "false"),
        ("keyed", "boolean", "NULL", "NULL", "false", "false"),
    )
    customer_profile = profile(
        ("c_custkey", "bigint", "19", "0", "true"),
        ("c_name", "string", "NULL", "NULL", "false"),
        ("c_nationkey", "int", "10", "0", "true"),
        ("c_acctbal", "double", "NULL", "NULL", "false"),
        ("c_mktsegment", "string", "NULL", "NULL", "false"),
    )
    stride_columns = (
        "stride_id, count(*) AS row_count, min(v) AS min_value, max(v) AS max_value"
    )
    return {
        "full_scan": "SELECT * FROM customer",
        "bootstrap_scan": "SELECT * FROM supplier",
        "full_ranged": "SELECT * FROM orders",
        "full_ranged_nulls": nulled,
        "incr_numeric": "SELECT * FROM orders WHERE o_orderkey > 2000",
        "incr_numeric_footers": "SELECT * FROM orders WHERE o_orderkey > 2000",
        "incr_timestamp_footers": past_events,
        "incr_zone_map": past_events,
        "offset_outlives_files": past_events,
        "merged_target": f"SELECT * FROM lineitem {LATEST_OF_ORDER}",
        "late_rows": """
            SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00'
                OR (event_id % 10 = 0 AND ts > TIMESTAMP '2024-01-01 00:00:00')
        """,
        "incr_timestamp": past_events,
        "incr_timestamp_t": "SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15 12:00:00'",
        "incr_date": """
            SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders
            WHERE CAST(o_orderdate AS DATE) > DATE '1998-06-30'
        """,
        "incr_empty_count": """
            SELECT count(*) AS row_count FROM events WHERE ts > TIMESTAMP '2030-01-01 00:00:00'
        """,
        "incr_pushdown": f"""
            SELECT event_id, ts, value FROM ({past_events}) WHERE event_type = 'click'
        """,
        "incr_chain": past_events,
        "incr_into": past_events,
        "incr_bounded": f"{past_events} AND ts <= TIMESTAMP '2024-01-20 06:00:00'",
        "range_full": """
            SELECT min(o_orderkey) AS min_value, max(o_orderkey) AS max_value FROM orders
        """,
        "range_filtered": """
            SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value
            FROM orders WHERE o_totalprice > 250000
        """,
        "next_offset": f"SELECT max(ts) AS next_offset FROM ({past_events})",
        "stride_numeric": _number_strides(
            "SELECT o_orderkey AS x, o_orderkey AS v FROM orders WHERE o_orderkey > 2000", 7
        )
        + f"SELECT {stride_columns} FROM s GROUP BY stride_id",
        "stride_timestamp": f"""
            WITH t AS ({past_events}),
            r AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM t),
            p AS (SELECT lo, (hi // 1000000 - lo // 1000000) // 10 AS step FROM r),
            s AS (SELECT least(9, (epoch_us(ts) - lo) // (step * 1000000)) AS stride_id, ts AS v
                  FROM t, p)
            SELECT {stride_columns} FROM s GROUP BY stride_id
        """,
        "stride_date": _number_strides(
            """SELECT CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) AS x,
                      CAST(o_orderdate AS DATE) AS v FROM orders""",
            12,
        )
        + f"SELECT {stride_columns} FROM s GROUP BY stride_id",
        "stride_balanced": """
            WITH t AS (SELECT l_orderkey * l_orderkey * 7 + l_linenumber AS k FROM lineitem)
            SELECT CAST(16 AS BIGINT) AS strides, count(*) AS row_count, true AS even,
                   min(k) AS min_value, max(k) AS max_value FROM t
        """,
        "stride_predicates": _number_strides(
            f"SELECT k AS x, k AS v FROM ({nulled})", 9
        )
        + """SELECT CASE WHEN v IS NULL THEN -1 ELSE stride_id END AS stride_id,
                    count(*) AS row_count FROM s GROUP BY ALL""",
        "stride_layout": _number_strides(f"SELECT k AS x, k AS v FROM ({nulled})", 8)
        + "SELECT stride_id, count(*) AS row_count, true AS unmixed FROM s GROUP BY stride_id",
        "provenance_rows": f"""
            SELECT "column", key, value, value_count
            FROM ({column_counts}), (VALUES {provenance}) AS p(key, value)
        """,
        "record_count": "SELECT count(*) AS record_count FROM lineitem WHERE l_quantity > 25",
        "field_profile": f"""
            WITH n AS ({nulled}),
            t AS (SELECT *, CAST(o_orderdate AS DATE) AS d,
                         CAST(o_totalprice AS DECIMAL(12, 2)) AS price,
                         o_orderkey IS NOT NULL AS keyed FROM n)
            {nulled_profile}
        """,
        "field_profile_footers": f"WITH t AS (SELECT * FROM customer) {customer_profile}",
        "auto_increment": f"""
            WITH o AS (SELECT *, 7 - o_orderkey AS k FROM orders)
            {numbered("orders", "o", (*order_types, ("k", "bigint")))} UNION ALL
            {numbered("lineitem", "lineitem", line_types)}
        """,
        "avg_row_size": """
            SELECT CAST(sum(32 + strlen(o_orderstatus) + strlen(o_orderpriority)) // count(*)
                        AS BIGINT) AS avg_row_size
            FROM orders
        """,
        "key_check": """
            WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n
                       FROM lineitem GROUP BY l_orderkey, l_linenumber)
            SELECT CAST(sum(n) AS BIGINT) AS row_count,
                   CAST(coalesce(sum(n) FILTER (WHERE l_orderkey IS NULL
                                                   OR l_linenumber IS NULL), 0) AS BIGINT)
                       AS null_key_rows,
                   count(*) FILTER (WHERE n > 1) AS duplicate_groups,
                   CAST(sum(n - 1) AS BIGINT) AS surplus_rows,
                   sum(n - 1) = 0 AND count(*) FILTER (WHERE l_orderkey IS NULL
                                                   OR l_linenumber IS NULL) = 0 AS is_key
            FROM g
        """,
        "key_candidates": f"""
            WITH u AS ({unique_sets})
            SELECT array_to_string(s, ',') AS key_columns FROM u
            WHERE is_key AND NOT EXISTS (
                SELECT 1 FROM u AS v WHERE v.is_key AND len(v.s) < len(u.s) AND list_has_all(u.s, v.s))
        """,
        "normalise_timestamps": """
            SELECT event_id, TRY_CAST(CASE event_id % 4
                WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f')
                WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
                WHEN 2 THEN strftime(ts, '%Y-%m-%d')
                ELSE strftime(ts, '%Y-%m-%dT41:%M:%S') END AS TIMESTAMP) AS moment
            FROM events
        """,
        "dedup_keys": """
            SELECT DISTINCT l_orderkey, l_linenumber, CAST(1 AS BIGINT) AS survivors, true AS is_row
            FROM lineitem
        """,
        "dedup_latest_nested": """
            SELECT l_orderkey, l_linenumber, l_shipdate, l_returnflag AS flag,
                   l_linestatus AS status, l_suppkey AS supplier
            FROM (SELECT *, concat(length(l_linestatus), ':', l_linestatus,
                                   length(CAST(l_suppkey AS VARCHAR)), ':', l_suppkey) AS m
                  FROM lineitem)
            QUALIFY row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC NULLS LAST,
                    concat(length(l_returnflag), ':', l_returnflag, length(m), ':', m) DESC) = 1
        """,
        "dedup_latest": f"SELECT * FROM lineitem {LATEST_LINE}",
        "incr_dedup": f"""
            SELECT * FROM lineitem WHERE l_shipdate > TIMESTAMP '1998-01-01 00:00:00' {LATEST_LINE}
        """,
        "base64_binary": """
            SELECT doc_id, to_base64(encode(text)) AS body, lang FROM documents
        """,
        "sink_roundtrip": "SELECT * FROM orders",
        "sink_partitioned": "SELECT * FROM orders",
        "staged_load": """
            SELECT o_orderkey, o_totalprice FROM orders
            WHERE o_orderkey > 2000 AND o_totalprice > 100000
        """,
        "staged_parquet": """
            SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000
        """,
    }
