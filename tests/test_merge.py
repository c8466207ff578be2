"""Merges into a target in versions, and rows that are committed late."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import tidemark as tm
from tidemark.plans import merge as merges

SCHEMA = "key bigint, part string, changed bigint, value string"


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / uuid.uuid4().hex)


def made(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema).coalesce(2)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def newest(rows):
    """Per key the largest row by changed, then value; NULL loses."""
    best = {}
    for row in rows:
        rank = [(v is not None, v) for v in row[2:]]
        if row[:2] not in best or rank > best[row[:2]][0]:
            best[row[:2]] = (rank, row)
    return sorted((row for _, row in best.values()), key=repr)


def random_rows(seed, count):
    pick = random.Random(seed)
    return [
        (
            pick.choice([None, *range(60)]),
            pick.choice([None, "", "a", "b"]),
            pick.choice([None, *range(40)]),
            pick.choice([None, "x", "y", "z"]),
        )
        for _ in range(count)
    ]


@pytest.mark.parametrize("named_files", [10_000, 1])
def test_versions_hold_the_newest_row_of_each_key(spark, folder, monkeypatch, named_files):
    monkeypatch.setattr(merges, "NAMED_FILES", named_files)
    target = tm.MergeTarget(spark, folder, ["KEY", "part"], "changed")
    seen, old = [], None
    for version, count in enumerate([200, 40, 0, 1, 300], start=1):
        rows = random_rows(version, count)
        if old is not None:
            before = rows_of(old)
        assert target.merge(made(spark, rows), str(version)) == version
        seen += rows
        if old is not None:
            assert rows_of(old) == before  # an open version does not change
        old = target.read()
        assert rows_of(old) == newest(seen)
        assert target.next_offset() == str(version)
        assert target.files().agg(F.sum("row_count")).first()[0] == len(newest(seen))


def test_files_without_a_matched_key_keep_their_names(spark, folder):
    target = tm.MergeTarget(spark, folder, ["id"], "changed")
    rows = spark.range(0, 4000, 1, 4).selectExpr("id", "id AS changed")
    for low in range(0, 4000, 1000):  # four files of a thousand keys
        target.merge(rows.where(f"id >= {low} AND id < {low + 1000}").coalesce(1))
    before = {r.file: (r.low, r.high) for r in target.files().collect()}
    assert len(before) >= 4
    target.merge(spark.createDataFrame([(1500, 9999), (1501, 9999)], "id bigint, changed bigint"))
    after = {r.file for r in target.files().collect()}
    lost = [before[f] for f in before.keys() - after]
    assert lost and all(low <= 1501 and high >= 1500 for low, high in lost)
    assert target.read().where("changed = 9999").count() == 2
    assert target.read().count() == 4000
    target.merge(spark.createDataFrame([(9000, 1)], "id bigint, changed bigint"))
    assert after < {r.file for r in target.files().collect()}


def test_a_killed_merge_leaves_the_version_before(spark, folder):
    target = tm.MergeTarget(spark, folder, ["key", "part"], "changed")
    rows = random_rows(7, 80)
    target.merge(made(spark, rows), "7")
    broken = made(spark, rows).withColumn("value", F.expr("CAST(raise_error('lost') AS STRING)"))
    with pytest.raises(PySparkException):
        target.merge(broken, "8")
    # files and changes were written, but the run was not published
    stop = target._log.publish
    target._log.publish = lambda *_: (_ for _ in ()).throw(KeyboardInterrupt)
    with pytest.raises(KeyboardInterrupt):
        target.merge(made(spark, [(1, "a", 99, "new")]), "9")
    assert rows_of(target.read()) == newest(rows)
    assert target.next_offset() == "7"
    target._log.publish = stop
    target.merge(made(spark, [(1, "a", 99, "new")]), "9")
    assert rows_of(target.read()) == newest([*rows, (1, "a", 99, "new")])


def test_the_later_of_two_writers_fails(spark, folder):
    first = tm.MergeTarget(spark, folder, ["key", "part"], "changed")
    second = tm.MergeTarget(spark, folder, ["key", "part"], "changed")
    publish = second._log.publish

    def late(*given):
        first.merge(made(spark, [(1, "a", 1, "first")]))
        publish(*given)

    second._log.publish = late
    with pytest.raises(tm.LoadError, match="version 1 first"):
        second.merge(made(spark, [(2, "a", 2, "second")]))
    assert rows_of(first.read()) == [(1, "a", 1, "first")]
    assert first.merge(made(spark, [(3, "a", 2, "third")])) == 2


def test_columns_with_odd_names_and_other_schemas(spark, folder):
    schema = "`file` bigint, `k0` bigint, `a.b` string, `low` bigint"
    target = tm.MergeTarget(spark, folder, ["file", "a.b"], "low")
    target.merge(spark.createDataFrame([(1, 2, "x", 3), (2, 2, "y", 3)], schema))
    shuffled = spark.createDataFrame([(1, 7, "x", 4)], schema).select("`a.b`", "low", "k0", "file")
    target.merge(shuffled)
    assert rows_of(target.read()) == [(1, 7, "x", 4), (2, 2, "y", 3)]
    with pytest.raises(tm.LoadError, match="more"):
        target.merge(spark.createDataFrame([(1, 7, "x", 4, 1)], schema + ", more int"))
    with pytest.raises(tm.LoadError, match="k0"):
        target.merge(spark.createDataFrame([(1, "7", "x", 4)], schema.replace("`k0` bigint", "`k0` string")))


def test_empty_targets(spark, folder):
    target = tm.MergeTarget(spark, folder, ["key"], "changed")
    assert target.next_offset() is None
    with pytest.raises(tm.LoadError, match="nothing"):
        target.read()
    target.merge(made(spark, []))
    assert target.read().columns == ["key", "part", "changed", "value"]
    assert target.read().isEmpty()
    target.merge(made(spark, [(1, "a", 1, "x")]))
    assert rows_of(target.read()) == [(1, "a", 1, "x")]


def test_merge_into_keeps_its_offset(spark, folder):
    rows = made(spark, [(1, "a", 1, "x"), (2, "a", 5, "x")])
    load = tm.loader(spark).option("partitionColumn", "changed")
    assert load.option("loadType", "full").merge_into(folder, ["key"], rows) == "5"
    target = tm.MergeTarget(spark, folder, ["key"], "changed")
    more = rows.union(made(spark, [(1, "b", 8, "y"), (9, "a", 4, "late")]))
    assert load.option("offset", target.next_offset()).merge_into(folder, ["key"], more) == "8"
    assert rows_of(target.read()) == [(1, "b", 8, "y"), (2, "a", 5, "x")]
    with pytest.raises(tm.OptionError):
        tm.loader(spark).merge_into(folder, ["key"], rows)


MOMENTS = {
    "bigint": ("moment", 10),
    "decimal(20,0)": ("CAST(moment AS DECIMAL(20,0))", 10),
    "date": ("date_add(DATE'2024-02-20', CAST(moment AS INT))", 10),
    "timestamp": ("timestamp_seconds(moment)", 10),
    "timestamp_ntz": ("CAST(timestamp_seconds(moment) AS TIMESTAMP_NTZ)", 10),
}
FIRST = {
    "bigint": "100",
    "decimal(20,0)": "100",
    "date": "2024-05-30",
    "timestamp": "1970-01-01 00:01:40Z",
    "timestamp_ntz": "1970-01-01 00:01:40",
}


@pytest.mark.parametrize("kind", MOMENTS)
def test_late_rows_are_delivered_once(spark, folder, kind):
    text, overlap = MOMENTS[kind]
    pick, arrived = random.Random(kind), []
    load = tm.loader(spark).options(partitionColumn="at", offset=FIRST[kind])
    # rows as (id, moment); the source only grows
    steps = [
        [(i, pick.randrange(80, 120)) for i in range(40)],
        [(100 + i, pick.randrange(95, 131)) for i in range(40)] + [(None, 118), (None, None), (7, 118)],
        [(200 + i, pick.randrange(100, 140)) for i in range(40)],
        [],
    ]
    offset, seen, before = 100, [], set()
    for step in steps:
        arrived = arrived + step
        source = spark.createDataFrame(arrived, "id bigint, moment bigint").coalesce(3)
        source = source.selectExpr("id", "moment", f"{text} AS at")
        run = load.load_late(["id"], folder, overlap, source)
        got = sorted(map(repr, ((r.id, r.moment) for r in run.df.collect())))
        there = {r for r in arrived if r[1] is not None and r[1] > offset - overlap}
        late = [r for r in there if r[1] <= offset and r not in before] if seen else []
        fresh = [r for r in there if r[1] > offset]
        assert got == sorted(map(repr, [*fresh, *late]))
        # not confirmed: delivered again
        again = load.load_late(["id"], folder, overlap, source)
        assert sorted(map(repr, ((r.id, r.moment) for r in again.df.collect()))) == got
        assert run.confirm() == run.next_offset
        before |= there
        seen.append(got)
        offset = max([offset, *[r[1] for r in fresh]])
    assert any(late_rows := seen[1]) and seen[3] == []
    delivered = [r for got in seen for r in got]
    assert len(delivered) == len(set(delivered))


def test_late_rows_of_a_full_start_and_odd_names(spark, folder):
    schema = "`at` bigint, `k0` string, `row` string, `a.b` bigint"
    load = tm.loader(spark).options(partitionColumn="at", loadType="full")
    rows = [(1, "a", "r", 1), (50, "b", "s", 2), (None, "c", "t", 3)]
    first = load.load_late(["a.b", "K0"], folder, 5, spark.createDataFrame(rows, schema))
    assert rows_of(first.df) == sorted(rows, key=repr)
    assert first.confirm() == "50"
    rows += [(45, "b", "too late", 9), (46, "b", "late", 9), (50, "b", "copy", 2), (51, "b", "r", 2)]
    second = load.load_late(["a.b", "k0"], folder, 5, spark.createDataFrame(rows, schema))
    assert second.df.columns == ["at", "k0", "row", "a.b"]
    assert rows_of(second.df) == [(46, "b", "late", 9), (51, "b", "r", 2)]
    second.confirm()
    with pytest.raises(tm.LoadError, match="other keys"):
        load.load_late(["a.b"], folder, 5, spark.createDataFrame(rows, schema))


def test_late_rows_of_files_that_change_before_the_run_is_confirmed(spark, folder, tmp_path):
    path = str(tmp_path / "source")
    table = spark.range(0, 100, 1, 1).selectExpr("id", "id AS at")
    table.write.parquet(path)
    load = tm.loader(spark).options(partitionColumn="at", offset="89")
    first = load.load_late(["id"], folder, 20, path)
    spark.range(500, 503, 1, 1).selectExpr("id", "id - 410 AS at").write.mode("append").parquet(path)
    assert first.df.count() == 10
    assert first.confirm() == "99"
    second = load.load_late(["id"], folder, 20, path)
    assert rows_of(second.df) == [(500, 90), (501, 91), (502, 92)]


def test_late_rows_options(spark, folder):
    rows = made(spark, [(1, "a", 1, "x")])
    with pytest.raises(tm.OptionError):
        tm.loader(spark).load_late(["key"], folder, 5, rows)
    load = tm.loader(spark).options(partitionColumn="changed", offset="0")
    with pytest.raises(tm.OptionError):
        load.load_late(["key"], folder, -1, rows)
    empty = load.load_late(["key"], folder, 5, rows.where("false"))
    assert empty.df.isEmpty() and empty.confirm() == "0"
