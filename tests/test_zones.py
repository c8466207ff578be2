"""Facts of single files, zone maps, offsets that outlive files, balanced strides, auto-increment."""

from __future__ import annotations

import datetime
import uuid
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.plans.zones import ZoneMap
from tidemark.sources import footers

COLUMNS = {
    "tiny": "CAST(id % 100 AS TINYINT)",
    "small": "CAST(id AS SMALLINT)",
    "whole": "CAST(id * 3 AS INT)",
    "long": "id * 10000000000 - 5",
    "day": "date_add(DATE'1969-12-20', CAST(id AS INT))",
    "wall": "CAST(timestamp_micros(id * 86400123456 - 99) AS TIMESTAMP_NTZ)",
    "moment": "timestamp_micros(id * 86400123456 - 99)",
}


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def table(spark, start, stop):
    made = [f"IF(id % 4 = 3, NULL, {text}) AS {name}" for name, text in COLUMNS.items()]
    return spark.range(start, stop, 1, 1).selectExpr(*made, "CAST(NULL AS TIMESTAMP_NTZ) AS empty")


@pytest.fixture(autouse=True)
def instants_with_statistics(spark):
    """Spark's older form of instants has no statistics in footers."""
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    yield
    spark.conf.unset("spark.sql.parquet.outputTimestampType")


def test_instants_without_statistics_are_scanned(spark, folder):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    write(spark, folder, 0, 30)
    assert listed(tm.file_facts(spark, folder, "moment")) == by_scan(spark, folder, "moment")


def write(spark, path, *borders, mode="append"):
    """A file for each two borders."""
    for start, stop in zip(borders, borders[1:]):
        table(spark, start, stop).write.mode(mode).parquet(path)


def blank_data(path):
    """Overwrite everything but the footers, so that reading a column fails or gives nonsense."""
    for file in Path(path.removeprefix("file:")).glob("*.parquet"):
        data = bytearray(file.read_bytes())
        footer = int.from_bytes(data[-8:-4], "little") + 8
        data[4:-footer] = b"\xff" * (len(data) - footer - 4)
        file.write_bytes(data)
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def by_scan(spark, path, column):
    c = F.col(column)
    place = footers.axis(c, spark.read.parquet(path).schema[column].dataType).cast("bigint")
    rows = spark.read.parquet(path).groupBy(F.input_file_name().alias("file")).agg(
        F.count("*"), F.count("*") - F.count(c), F.min(place), F.max(place)
    )
    return sorted((r[0].rsplit("/", 1)[-1], *r[1:]) for r in rows.collect())


def listed(facts):
    rows = facts.select("file", "row_count", "null_count", "low", "high").collect()
    return sorted((r[0].rsplit("/", 1)[-1], *r[1:]) for r in rows)


@pytest.mark.parametrize("column", [*COLUMNS, "empty"])
def test_facts_of_files_come_from_footers_alone(spark, folder, column):
    write(spark, folder, 0, 40, 41, 100, 160)
    expected = by_scan(spark, folder, column)
    blank_data(folder)
    assert listed(tm.file_facts(spark, folder, column)) == expected


def test_units_and_types_of_other_writers(spark, folder):
    path = Path(folder)
    path.mkdir()
    moments = [datetime.datetime(2020, 1, 1, 0, 0, 0, 123000), None, datetime.datetime(1960, 5, 5)]
    for unit in ("ms", "us"):
        pq.write_table(pa.table({"k": pa.array(moments, pa.timestamp(unit))}), path / f"{unit}.parquet")
    pq.write_table(pa.table({"k": pa.array(moments, pa.timestamp("us"))}), path / "bare.parquet", write_statistics=False)
    pq.write_table(pa.table({"other": [1, 2]}), path / "without.parquet")
    pq.write_table(pa.table({"k": pa.array([], pa.timestamp("us"))}), path / "none.parquet", write_statistics=False)
    found = {f: rest for f, *rest in listed(tm.file_facts(spark, folder, "k"))}
    epoch = datetime.datetime(1970, 1, 1)
    low, high = ((m - epoch) // datetime.timedelta(microseconds=1) for m in (moments[2], moments[0]))
    assert found.pop("without.parquet") == [2, 2, None, None]
    assert found.pop("none.parquet") == [0, 0, None, None]
    assert set(found) == {"ms.parquet", "us.parquet", "bare.parquet"}
    assert all(v == [3, 1, low, high] for v in found.values())


def test_unsigned_numbers_are_scanned(spark, folder):
    Path(folder).mkdir()
    pq.write_table(pa.table({"k": pa.array([1, 2**32 - 1], pa.uint32())}), Path(folder) / "u.parquet")
    assert footers._footer_facts(f"{folder}/u.parquet", "k") is None
    assert listed(tm.file_facts(spark, folder, "k"))[0][1:] == (2, 0, 1, 2**32 - 1)


def test_directory_columns_and_odd_names(spark, folder):
    path = folder + "/a b+c%20é"
    rows = spark.range(20).selectExpr("id AS k", "id DIV 7 AS part")
    rows.repartition(1).write.partitionBy("part").parquet(path)
    assert sorted(r[1:] for r in listed(tm.file_facts(spark, path, "part"))) == [(6, 0, 2, 2), (7, 0, 0, 0), (7, 0, 1, 1)]
    assert sorted(r[1:] for r in listed(tm.file_facts(spark, path, "K"))) == [(6, 0, 14, 19), (7, 0, 0, 6), (7, 0, 7, 13)]
    loaded = tm.loader(spark).options(partitionColumn="part", offset="0", zoneMap=folder + "/zones").load(path)
    assert sorted(map(tuple, loaded.df.collect())) == [(k, k // 7) for k in range(7, 20)] and loaded.next_offset == "2"


def test_unreachable_stores_are_scanned(spark, folder, monkeypatch):
    def nothing_told(batches):
        for batch in batches:
            nothing = [pa.nulls(batch.num_rows, pa.int64())] * 4 + [pa.array([False] * batch.num_rows)]
            names = [*batch.schema.names, "row_count", "null_count", "low", "high", "known"]
            yield pa.RecordBatch.from_arrays([*batch.columns, *nothing], names=names)

    write(spark, folder, 0, 30, 60)
    expected = by_scan(spark, folder, "wall")
    monkeypatch.setattr(footers, "_footer_reader", lambda column: nothing_told)
    assert listed(tm.file_facts(spark, folder, "wall")) == expected


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles"])
@pytest.mark.parametrize("column", ["wall", "moment"])
def test_timestamp_range_from_footers(spark, folder, column, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        write(spark, folder, 0, 40, 90)
        full = tm.loader(spark).options(loadType="full", partitionColumn=column)
        by_column = full.load(folder)
        offset = "1970-02-01 00:00:00" + ("+00:00" if column == "moment" else "")
        increment = tm.loader(spark).options(partitionColumn=column, offset=offset)
        rows = increment.load(folder).df.count()
        for load, source in ((full, by_column), (increment, increment.load(folder))):
            found = load.option("footerStats", True).load(folder)
            assert found.next_offset == source.next_offset and found.range.high == source.range.high
        assert full.option("footerStats", True).load(folder).range == by_column.range
        assert increment.option("footerStats", True).load(folder).df.count() == rows
        past = increment.options(offset=by_column.next_offset, footerStats=True).load(folder)
        assert past.df.count() == 0 and past.next_offset == by_column.next_offset
        blank_data(folder)
        assert full.option("footerStats", True).load(folder).next_offset == by_column.next_offset
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def opened(df):
    return sorted(f.rsplit("/", 1)[-1] for f in df.inputFiles())


def test_zone_map_opens_only_files_past_the_offset(spark, folder):
    data, zones = folder + "/data", folder + "/zones"
    write(spark, data, 0, 100, 200, 300)
    load = tm.loader(spark).options(partitionColumn="whole", zoneMap=zones)
    first = load.option("offset", "450").load(data)
    assert sorted(r.whole for r in first.df.collect()) == [3 * i for i in range(151, 300) if i % 4 != 3]
    assert first.next_offset == str(3 * 298) and len(opened(first.df)) == 2
    # files that arrive are found, and files that cannot hold newer rows stay closed
    write(spark, data, 300, 340)
    second = load.option("offset", first.next_offset).load(data)
    assert len(opened(second.df)) == 1 and second.next_offset == str(3 * 338)
    assert sorted(r.whole for r in second.df.collect()) == [3 * i for i in range(300, 340) if i % 4 != 3]
    third = load.option("offset", second.next_offset).load(data)
    assert third.df.count() == 0 and opened(third.df) == [] and third.next_offset == second.next_offset
    # the zone map reads no footer twice
    facts = spark.read.parquet(zones)
    assert facts.count() == facts.select("file").distinct().count() == 4
    full = tm.loader(spark).options(loadType="full", partitionColumn="whole", zoneMap=zones).load(data)
    assert full.df.count() == 340 and full.range.low == 0


def test_zone_map_follows_replaced_files(spark, folder):
    data, zones = folder + "/data", folder + "/zones"
    write(spark, data, 0, 50, 100)
    load = tm.loader(spark).options(partitionColumn="whole", offset="30", zoneMap=zones)
    assert load.load(data).next_offset == "294"
    table(spark, 0, 60).coalesce(1).write.mode("overwrite").parquet(data)
    again = load.load(data)
    assert again.next_offset == str(3 * 58) and again.df.count() == len([i for i in range(11, 60) if i % 4 != 3])


def test_zone_map_of_one_file_and_its_limits(spark, sf_dir, folder):
    load = tm.loader(spark).options(partitionColumn="ts", offset="2024-01-10 00:00:00", zoneMap=folder)
    path = f"{sf_dir}/events.parquet"
    plain = tm.loader(spark).options(partitionColumn="ts", offset="2024-01-10 00:00:00").load(path)
    loaded = load.load(path)
    assert loaded.next_offset == plain.next_offset and loaded.df.count() == plain.df.count()
    with pytest.raises(tm.OptionError):
        load.load(spark.read.parquet(path))
    with pytest.raises(tm.OptionError):
        load.option("layout", "stride").load(path)
    with pytest.raises(tm.OptionError):
        tm.loader(spark).option("zoneMap", folder).load(path)
    with pytest.raises(tm.OptionError):
        ZoneMap(spark, f"{sf_dir}/lineitem.parquet", "l_quantity", folder)


def test_many_files_are_not_named(spark, folder, monkeypatch):
    monkeypatch.setattr(footers, "NAMED_FILES", 1)
    import tidemark.plans.zones as zones_module

    monkeypatch.setattr(zones_module, "NAMED_FILES", 1)
    data = folder + "/data"
    write(spark, data, 0, 50, 100, 150)
    load = tm.loader(spark).options(partitionColumn="whole", offset="200", zoneMap=folder + "/zones")
    loaded = load.load(data)
    assert sorted(r.whole for r in loaded.df.collect()) == [3 * i for i in range(67, 150) if i % 4 != 3]


# --- offsets that outlive the files -------------------------------------------------


@pytest.mark.parametrize("options", [{}, {"footerStats": True}, {"zoneMap": "zones"}])
def test_next_offset_outlives_replaced_files(spark, folder, options):
    data = folder + "/data"
    if "zoneMap" in options:
        options = {"zoneMap": f"{folder}/zones"}
    write(spark, data, 0, 50, 90)
    loaded = tm.loader(spark).options(partitionColumn="whole", offset="30", **options).load(data)
    assert loaded.df.count() == len([i for i in range(11, 90) if i % 4 != 3])
    table(spark, 0, 200).write.mode("overwrite").parquet(data)  # compacted, and more rows came
    assert loaded.next_offset == str(3 * 89 if 89 % 4 != 3 else 3 * 88)


# --- balanced strides ------------------------------------------------------------------


def skewed(spark, n=60_000):
    return spark.range(n, numPartitions=6).selectExpr(
        "id * id * id AS k", "CAST(id * id % 9973 AS INT) AS hot", "id AS v",
        "timestamp_micros(id * id * 1000) AS moment", "CAST(timestamp_micros(id * id * 1000) AS TIMESTAMP_NTZ) AS wall",
        "date_add(DATE'1970-01-01', CAST(sqrt(id) * 30 AS INT)) AS day",
    )


@pytest.mark.parametrize("column", ["k", "moment", "wall", "day"])
@pytest.mark.parametrize("n", [1, 2, 10, 100])
def test_balanced_strides_hold_even_shares(spark, column, n):
    rows = skewed(spark)
    plan = tm.plan_balanced(rows, tm.column_range(rows, column), n)
    counts = {r.stride_id: r.row_count for r in tm.stride_summary(rows, plan).collect()}
    assert plan.count == n == len(counts) and sum(counts.values()) == 60_000
    if column != "day":  # which repeats values
        assert max(counts.values()) <= 1.2 * 60_000 / n


def test_rows_within_bounds_are_those_of_the_database(spark, tmp_path):
    rows = skewed(spark).select("k", "v")
    rows.write.parquet(str(tmp_path / "rows"))
    plan = tm.plan_balanced(rows, tm.column_range(rows, "k"), 37)
    counted = {r.stride_id: r.row_count for r in tm.stride_summary(rows, plan).collect()}
    for i, (low, high) in enumerate(plan.bounds()):
        closing = "<=" if i == plan.count - 1 else "<"
        sql = f"SELECT count(*) FROM '{tmp_path}/rows/*.parquet' WHERE k >= {low} AND k {closing} {high}"
        assert duckdb.sql(sql).fetchall()[0][0] == counted[i]
    conditions = tm.stride_predicates(plan, "k", keep_nulls=True)
    assert len(conditions) == 38
    counts = rows.agg(*[F.count_if(F.expr(c)) for c in conditions]).first()
    assert list(counts) == [counted[i] for i in range(37)] + [0]


def test_balanced_strides_of_hot_values_and_nulls(spark):
    rows = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 100 = 1 THEN NULL ELSE id END AS k")
    plan = tm.plan_balanced(rows, tm.column_range(rows, "k"), 9)
    counts = {r.stride_id: r.row_count for r in tm.stride_summary(rows, plan).collect()}
    assert sum(counts.values()) == 9000 and plan.count < 9 and set(counts) == set(range(plan.count))
    one = rows.where("k = 7")
    assert tm.plan_balanced(one, tm.column_range(one, "k"), 9).count == 1
    none = rows.where("k IS NULL")
    assert tm.plan_balanced(none, tm.column_range(none, "k"), 9) is None
    with pytest.raises(tm.OptionError):
        tm.plan_balanced(rows, tm.column_range(rows, "k"), 0)


def test_balanced_strides_at_the_ends_of_the_long_range(spark):
    rows = spark.sql(f"SELECT explode(array({-(2**63)}L, -1L, 0L, 1L, {2**63 - 2}L, {2**63 - 1}L)) AS k")
    plan = tm.plan_balanced(rows, tm.column_range(rows, "k"), 3)
    assert sum(r.row_count for r in tm.stride_summary(rows, plan).collect()) == 6


@pytest.mark.parametrize("layout", ["scan", "stride"])
def test_loads_with_balanced_strides(spark, layout):
    rows = skewed(spark, 6000)
    load = tm.loader(spark).options(partitionColumn="k", loadType="full", numPartitions=8, layout=layout)
    loaded = load.option("balancedStrides", True).load(rows)
    assert loaded.strides.count == 8 and loaded.df.count() == 6000
    if layout == "stride":
        held = loaded.df.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in held) <= 900 and loaded.partitions <= 16
    again = load.option("balancedStrides", True).load_deduplicated(["v"], rows)
    assert again.strides.count == 8
    with pytest.raises(tm.OptionError):
        tm.loader(spark).options(loadType="full", balancedStrides=True).load(rows)


# --- auto-increment ------------------------------------------------------------------------


def auto(df):
    return {r.name: r.auto_increment for r in tm.auto_increments(df).collect()}


def test_auto_increment_columns(spark):
    rows = spark.range(100_000, numPartitions=7).repartition(5, F.rand(1)).selectExpr(
        "id AS zero", "id - 50000 AS below", f"id + {2**63 - 100_000} AS top", f"id - {2**63 - 1} AS bottom",
        "CAST(id + 1 AS INT) AS one", "id * 2 AS gaps", "IF(id = 5, 6, id) AS twice",
        "IF(id = 5, NULL, id) AS missing", "CASE WHEN id = 5 THEN 7 WHEN id = 99 THEN 98 ELSE id END AS swapped",
        "CAST(id % 100 AS TINYINT) AS tiny", "CAST(id AS STRING) AS words", "CAST(id AS DECIMAL(12, 0)) AS money",
    )
    assert auto(rows) == {
        "zero": True, "below": True, "top": True, "bottom": True, "one": True, "gaps": False, "twice": False,
        "missing": False, "swapped": False, "tiny": False,
    }
    profile = {r.name: r.auto_increment for r in tm.field_profile(rows, auto_increment=True).collect()}
    assert len(profile) == 12 and not profile["words"] and not profile["money"] and profile["below"]


def test_auto_increment_of_few_rows(spark):
    one = spark.sql("SELECT 5L AS k, CAST(NULL AS INT) AS n, 'x' AS s")
    assert auto(one) == {"k": True, "n": False}
    assert auto(one.where("false")) == {"k": False, "n": False}
    assert auto(one.select("s")) == {}
    assert [r.auto_increment for r in tm.field_profile(one.select("s"), auto_increment=True).collect()] == [False]
    clash = spark.range(9).selectExpr("id AS at", "id AS bucket", "id AS bit", "id AS of", "8 - id AS dense", "id AS `a.b`")
    assert set(auto(clash).values()) == {True} and len(auto(clash)) == 6


def test_key_check_of_a_column_named_like_a_helper(spark):
    rows = spark.range(9).selectExpr("id AS __rows", "id % 3 AS __ROWS_")
    assert tm.key_check(rows, ["__rows"]).first().is_key
    assert tm.key_check(rows, ["__rows_"]).first().surplus_rows == 6
