"""JDBC loads, with Spark's reader replaced by one that answers from a Spark view.

No database is started: the stand-in runs the SQL texts the loader sends, so what
is checked is the texts, the options, and the rows they select.
"""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import tidemark as tm
from tidemark.sources.jdbc import offset_sql, quote_name, range_query

MYSQL = "jdbc:mysql://localhost/test?user=fred&password=secret"
OTHER = "jdbc:other://localhost/test"
LONG, DATE, NTZ, ZONED = T.LongType(), T.DateType(), T.TimestampNTZType(), T.TimestampType()


def spark_sql(text):
    """JDBC escapes, quoted names and MySQL's text type in Spark's form."""
    text = re.sub(r'"([^"]*)"', r"`\1`", text).replace(" AS CHAR)", " AS STRING)")
    text = re.sub(r"\{ts '([^']*)'\}", r"TIMESTAMP_NTZ'\1'", text)
    return re.sub(r"\{d '([^']*)'\}", r"DATE'\1'", text)


class StandInReader:
    def __init__(self, spark, log, options=None):
        self.spark, self.log, self.given = spark, log, options or {}

    def format(self, name):
        assert name == "jdbc"
        return self

    def option(self, key, value):
        return StandInReader(self.spark, self.log, {**self.given, key: value})

    def options(self, **options):
        return StandInReader(self.spark, self.log, {**self.given, **options})

    def load(self):
        self.log.append(self.given)
        if "query" in self.given:
            return self.spark.sql(spark_sql(self.given["query"]))
        return self.table(self.given["dbtable"])

    def table(self, name):
        return self.spark.sql(f"SELECT * FROM {name}")

    def jdbc(self, url, table, predicates=None, properties=None):
        self.log.append({"url": url, "dbtable": table, "predicates": predicates, **properties})
        rows = self.table(table)
        if predicates is None:
            return rows
        # A row comes back once per query that selects it.
        matches = "+".join(f"IF({spark_sql(p)}, 1, 0)" for p in predicates)
        counted = rows.withColumn("matches", F.expr(matches)).where("matches > 0")
        copies = counted.withColumn("copy", F.explode(F.expr("sequence(1, matches)")))
        return copies.drop("matches", "copy")


class StandInSession:
    def __init__(self, spark):
        self.conf, self.log = spark.conf, []
        self.read = StandInReader(spark, self.log)


# The table, columns and offsets of the acceptance cases.
@pytest.fixture
def session(spark):
    rows = spark.range(1000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("booking_id"),
        F.expr("timestamp_ntz'2020-08-24 00:00:00.25' + make_dt_interval(0, 0, id, 0)").alias("last_updated"),
        F.expr("date_add(date'2020-08-01', cast(id as int))").alias("day"),
        F.col("id").cast("double").alias("amount"),
    )
    rows.createOrReplaceTempView("booking")
    return StandInSession(spark)


def load(session, **options):
    return tm.loader(session).options(url=MYSQL, **options)


CASES = [
    ("booking_id", "500", "booking_id > 500", "998"),
    ("last_updated", "2020-08-24T08:18:07.0", "last_updated > timestamp_ntz'2020-08-24 08:18:07'", "2020-08-24 16:39:00.25"),
    ("day", "2021-08-24", "day > date'2021-08-24'", "2023-04-27"),
]


@pytest.mark.parametrize("column, offset, condition, top", CASES)
@pytest.mark.parametrize("strides, url", [(1, MYSQL), (10, MYSQL), (10, OTHER)])
def test_incremental(spark, session, column, offset, condition, top, strides, url):
    options = {"url": url, "partitionColumn": column, "offset": offset, "numPartitions": strides}
    loaded = tm.loader(session).options(**options).load("booking")
    want = spark.table("booking").where(condition)
    assert loaded.df.count() == want.count() and loaded.df.exceptAll(want).count() == 0
    assert loaded.next_offset == top
    scan = session.log[-1]
    assert len(scan["predicates"]) == strides and scan["url"] == url
    name = f"`{column}`" if url == MYSQL else f'"{column}"'
    assert all(name in p for p in scan["predicates"])


@pytest.mark.parametrize("column", ["booking_id", "last_updated", "day"])
def test_full_in_strides_keeps_missing_values(spark, session, column):
    loaded = load(session, loadType="full", partitionColumn=column, numPartitions=24).load("booking")
    assert loaded.df.exceptAll(spark.table("booking")).count() == 0 and loaded.df.count() == 1000
    predicates = session.log[-1]["predicates"]
    assert len(predicates) == 25 and [p for p in predicates if "IS NULL" in p] == predicates[-1:]


def test_default_number_of_strides(session):
    load(session, partitionColumn="last_updated", offset="2020-08-24 00:00:00").load("booking")
    assert len(session.log[-1]["predicates"]) == 100


def test_documented_number_of_strides(spark, session):
    found = tm.column_range(spark.table("booking"), "last_updated")
    plan = tm.plan_strides(found, 900)
    predicates = tm.stride_predicates(plan, "`last_updated`", keep_nulls=True)
    assert len(predicates) == 901 and len(set(predicates)) == 901


def test_query_in_strides(spark, session):
    query = "SELECT booking_id, day FROM booking WHERE amount < 600"
    loaded = load(session, query=query, partitionColumn="day", offset="2021-08-24", numPartitions=8).load()
    want = spark.sql(f"{query} AND day > date'2021-08-24'")
    assert loaded.df.exceptAll(want).count() == 0 and loaded.df.count() == want.count()
    assert len(session.log[-1]["predicates"]) == 8
    assert session.log[-1]["dbtable"] == f"({query}) load_query"


def test_full_in_one_query(session):
    loaded = load(session, loadType="full", dbtable="booking", fetchsize=7).load()
    assert loaded.df.count() == 1000 and loaded.next_offset is None
    (only,) = session.log
    assert only == {"url": MYSQL, "dbtable": "booking", "predicates": None, "fetchsize": "7"}


def test_empty_increment(session):
    loaded = load(session, partitionColumn="booking_id", offset="5000").load("booking")
    assert loaded.df.count() == 0 and loaded.next_offset == "5000" and loaded.strides is None
    assert session.log[-1]["predicates"] == ["1=0"]


def test_only_missing_values(spark, session):
    spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 1 AS v").createOrReplaceTempView("unkeyed")
    assert load(session, loadType="full", partitionColumn="k").load("unkeyed").df.count() == 1
    assert load(session, partitionColumn="k", offset="1").load("unkeyed").df.count() == 0


def test_range_is_read_without_time_zones_and_in_batches(session):
    load(session, partitionColumn="last_updated", offset="2020-08-24", preferTimestampNTZ="false").load("booking")
    schema, extremes, scan = session.log
    assert schema["preferTimestampNTZ"] == extremes["preferTimestampNTZ"] == "true"
    assert scan["preferTimestampNTZ"] == "false" and scan["fetchsize"] == "10000"


def test_password_is_not_kept_as_provenance(session):
    loaded = load(session, partitionColumn="booking_id", offset="5").load("booking")
    metadata = loaded.df.schema["amount"].metadata
    assert metadata["tableName"] == "booking" and "secret" not in str(metadata)


def test_missing_column_and_wrong_type(session):
    with pytest.raises(tm.LoadError, match="could not find column"):
        load(session, loadType="full", partitionColumn="nothing").load("booking")
    with pytest.raises(tm.OptionError, match="whole number, date or timestamp"):
        load(session, loadType="full", partitionColumn="amount").load("booking")
    with pytest.raises(tm.LoadError):
        load(session, loadType="full").load("no_such_table")


def test_cause_of_a_failed_connection_is_kept(spark):
    with pytest.raises(tm.LoadError) as failure:
        tm.loader(spark).options(url="jdbc:nothing:here", loadType="full").load("booking")
    assert "driver" in str(failure.value.__cause__)


def test_quoting(spark, session):
    assert quote_name(MYSQL, "a`b") == "`a``b`"
    assert quote_name("jdbc:postgresql://h/d", 'a"b') == '"a""b"'
    fields = spark.table("booking").schema
    assert range_query("jdbc:postgresql://h/d", "booking", fields["day"], " where day > 3") == (
        'SELECT min("day") AS min_value, max("day") AS max_value FROM booking WHERE day > 3'
    )
    assert range_query(MYSQL, "booking", fields["last_updated"]) == (
        "SELECT CAST(min(`last_updated`) AS CHAR) AS min_value, "
        "CAST(max(`last_updated`) AS CHAR) AS max_value FROM booking"
    )


@pytest.mark.parametrize(
    "url, dtype, text, sql",
    [
        (MYSQL, NTZ, "2020-08-24T18:18:07.5", "'2020-08-24 18:18:07.5'"),
        (MYSQL, NTZ, "2020-08-24", "'2020-08-24 00:00:00'"),
        (OTHER, NTZ, "2020-08-24T18:18:07.5", "{ts '2020-08-24 18:18:07.5'}"),
        (OTHER, ZONED, "2020-08-24 18:18:07+05:30", "'2020-08-24 18:18:07+05:30'"),
        (OTHER, DATE, "2020-08-24", "{d '2020-08-24'}"),
        (MYSQL, LONG, "+4345454", "4345454"),
    ],
)
def test_offset_text(url, dtype, text, sql):
    assert offset_sql(url, text, dtype) == sql


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("url", [MYSQL, OTHER])
def test_column_read_as_an_instant(spark, zone, url):
    """The hour in which New York sets its clocks back, as an instant."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # The stand-in database keeps the time of the session, as MySQL's connections do.
        start = 1_730_606_400 if url == OTHER else 1_730_563_200
        rows = spark.range(240).selectExpr(f"timestamp_seconds({start} + id * 60) AS t", "id")
        rows.createOrReplaceTempView("instants")
        session, seen, offset = StandInSession(spark), [], "2024-11-01 00:00:00"
        # MySQL compares wall-clock values, any other database instants
        for last in (40, 130, 240):
            rows.where(F.col("id") < last).createOrReplaceTempView("instants")
            options = {"url": url, "partitionColumn": "t", "offset": offset, "numPartitions": 6}
            loaded = tm.loader(session).options(offsetZone="Z", **options).load("instants")
            seen += [r.id for r in loaded.df.collect()]
            offset = loaded.next_offset
        assert sorted(seen) == list(range(240))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_table_facts_computed_by_the_database(session):
    everything = tm.jdbc_column_range(session, MYSQL, "booking", "booking_id")
    assert (everything.low, everything.high) == (1, 998)
    filtered = tm.jdbc_column_range(session, MYSQL, "booking", "day", "where booking_id < 10")
    assert (filtered.low_text, filtered.high_text) == ("2020-08-02", "2020-08-09")
    count = tm.jdbc_record_count(session, MYSQL, "SELECT count(*) AS n FROM booking WHERE amount < 10")
    assert count.first().record_count == 10


@pytest.mark.parametrize("load_type, offset", [("full", ""), ("incremental", "2020-08-20")])
def test_salted_strides(spark, session, load_type, offset):
    options = {"loadType": load_type, "offset": offset, "partitionColumn": "day", "numPartitions": 5}
    loaded = load(session, saltColumn="booking_id", saltBuckets=4, **options).load("booking")
    want = load(session, **options).load("booking").df
    assert loaded.df.count() == want.count() and loaded.df.exceptAll(want).count() == 0
    assert len(session.log[2]["predicates"]) == (24 if load_type == "full" else 20)


def test_salt_of_negative_numbers(spark, session):
    spark.range(-20, 20).selectExpr("id AS k", "id").createOrReplaceTempView("signed")
    options = {"loadType": "full", "partitionColumn": "k", "numPartitions": 2}
    loaded = load(session, saltColumn="id", saltBuckets=3, **options).load("signed")
    assert sorted(r.id for r in loaded.df.collect()) == list(range(-20, 20))


def test_salt_must_be_a_whole_number(session):
    with pytest.raises(tm.OptionError, match="whole number"):
        load(
            session, loadType="full", partitionColumn="day", saltColumn="amount", saltBuckets=2
        ).load("booking")


def test_writer_gets_mode_and_properties():
    class Writer:
        def jdbc(self, *args, **kwargs):
            self.call = (args, kwargs)

    class Frame:
        write = Writer()

    tm.write_jdbc(Frame, MYSQL, "booking", mode="append", batchsize="500")
    assert Frame.write.call == (
        (MYSQL, "booking"),
        {"mode": "append", "properties": {"batchsize": "500"}},
    )


def counting_queries(session):
    return [entry["query"] for entry in session.log if "row_count" in entry.get("query", "")]


@pytest.mark.parametrize("url", [MYSQL, OTHER])
@pytest.mark.parametrize("column", ["k", "moment", "day"])
@pytest.mark.parametrize("most", [1, 7, 100])
def test_hot_strides_are_bisected(spark, url, column, most):
    rows = spark.range(400).selectExpr(
        "id * id * id AS k",
        "timestamp_ntz'2020-01-01 00:00:00.5' + make_dt_interval(0, 0, 0, id * id * id * 0.01) AS moment",
        "date_add(date'2020-01-01', CAST(id * id AS INT)) AS day",
    )
    rows.createOrReplaceTempView("skewed")
    session = StandInSession(spark)
    options = {"url": url, "partitionColumn": column, "loadType": "full", "numPartitions": 6, "maxPartitionRows": most}
    loaded = tm.loader(session).options(**options).load("skewed")
    assert loaded.df.count() == 400 and loaded.df.exceptAll(rows).count() == 0
    predicates = session.log[-1]["predicates"]
    counted = rows.agg(*[F.count_if(F.expr(spark_sql(p))) for p in predicates]).first()
    assert sum(counted) == 400 and max(counted) <= most and loaded.strides.count == len(predicates) - 1
    # one grouped count a level, and later ones ask about fewer rows
    asked = counting_queries(session)
    assert 1 <= len(asked) <= 40 and len(asked) < len(predicates)


def test_bisected_strides_of_an_increment(spark):
    spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN 500 ELSE id END AS k").createOrReplaceTempView("hot_key")
    session = StandInSession(spark)
    loaded = load(session, partitionColumn="k", offset="100", numPartitions=4, maxPartitionRows=50).load("hot_key")
    want = spark.table("hot_key").where("k > 100")
    assert loaded.df.exceptAll(want).count() == 0 and loaded.df.count() == want.count()
    predicates = session.log[-1]["predicates"]
    counted = list(want.agg(*[F.count_if(F.expr(spark_sql(p))) for p in predicates]).first())
    hot = [n for n in counted if n > 50]
    assert hot == [335] and any("`k` >= 500 AND `k` < 501" in p for p in predicates)
    assert all("> 100" in q for q in counting_queries(session))


def test_bisecting_a_table_of_one_value_or_none(spark):
    spark.range(90).selectExpr("7 AS k", "CAST(NULL AS BIGINT) AS n").createOrReplaceTempView("flat")
    for column, rows in (("k", 90), ("n", 90)):
        session = StandInSession(spark)
        options = {"partitionColumn": column, "loadType": "full", "maxPartitionRows": 5}
        assert load(session, **options).load("flat").df.count() == rows
