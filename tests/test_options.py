"""Option rules of a load."""

from __future__ import annotations

import pytest

import tidemark as tm
from tidemark.sources.spec import LoadSpec

MYSQL = "jdbc:mysql://host/shop?user=u&password=p"


def test_defaults():
    spec = LoadSpec.of({"url": MYSQL}, "booking")
    assert spec.is_jdbc and spec.is_incremental
    assert (spec.table, spec.offset, spec.partition_column) == ("booking", "", "")
    assert spec.num_partitions == 100 and spec.layout == "scan"


@pytest.mark.parametrize(
    "options, effective",
    [
        ({"loadType": "incremental", "offset": "2020-08-24 18:18:07.0", "numPartitions": 10}, 10),
        ({"loadType": "incremental", "offset": "2020-08-24 18:18:07.0"}, 100),
        ({"loadType": "full", "numPartitions": 1204}, 1204),
        ({"loadType": "full"}, 100),
    ],
)
def test_documented_usage(options, effective):
    spec = LoadSpec.of(
        {"url": MYSQL, "dbtable": "booking", "partitionColumn": "last_updated", **options}
    )
    assert spec.num_partitions == effective


def test_full_load_without_column():
    spec = LoadSpec.of({"url": MYSQL, "dbtable": "booking", "loadType": "full"})
    assert not spec.is_incremental and not spec.partition_column


def test_names_and_load_type_in_any_case():
    spec = LoadSpec.of({"DBTABLE": "t", "LOADTYPE": "FULL", "partitioncolumn": "c"})
    assert spec.load_type == "full" and spec.partition_column == "c"


def test_dbtable_comes_before_the_argument_of_load():
    assert LoadSpec.of({"dbtable": "a"}, "b").table == "a"
    assert LoadSpec.of({"path": "c"}, "b").table == "b"
    assert LoadSpec.of({"path": "c"}).table == "c"


@pytest.mark.parametrize(
    "options",
    [
        {},
        {"dbtable": ""},
        {"dbtable": "t", "offset": "1"},
        {"dbtable": "t", "partitionColumn": "c"},
        {"dbtable": "t", "loadType": "full", "offset": "1", "partitionColumn": "c"},
        {"dbtable": "t", "loadType": "full", "offset": "1"},
        {"dbtable": "t", "loadType": "delta"},
        {"dbtable": "t", "numPartitions": "0"},
        {"dbtable": "t", "numPartitions": "-3"},
        {"dbtable": "t", "numPartitions": "ten"},
        {"dbtable": "t", "format": "jdbc"},
        {"dbtable": "t", "format": "parquet", "url": MYSQL},
        {"dbtable": "t", "layout": "hashed"},
        {"dbtable": "t", "layout": "stride"},
        {"dbtable": "t", "footerStats": "perhaps"},
        {"dbtable": "t", "query": "SELECT 1"},
        {"path": "t", "query": "SELECT 1"},
        {"dbtable": "t", "url": MYSQL, "saltColumn": "id"},
        {"dbtable": "t", "url": MYSQL, "saltColumn": "id", "saltBuckets": "4"},
        {"dbtable": "t", "loadType": "full", "partitionColumn": "c", "saltColumn": "id", "saltBuckets": "4"},
    ],
)
def test_bad_options(options):
    with pytest.raises(tm.OptionError):
        LoadSpec.of(options)


def test_credentials_outside_the_url_are_ignored():
    with pytest.warns(UserWarning, match="ignored"):
        spec = LoadSpec.of({"url": MYSQL, "dbtable": "t", "user": "u", "password": "p"})
    assert not spec.reader_options


def test_other_options_reach_the_reader():
    spec = LoadSpec.of({"url": MYSQL, "dbtable": "t", "fetchsize": 500, "header": True})
    assert spec.reader_options == {"fetchsize": "500", "header": "true"}


def test_missing_sources_and_columns(spark, sf_dir):
    with pytest.raises(tm.LoadError):
        tm.loader(spark).option("dbtable", "no_such_table").load()
    with pytest.raises(tm.LoadError) as failure:
        tm.loader(spark).load("/no/such/path")
    assert "PATH_NOT_FOUND" in str(failure.value.__cause__)
    with pytest.raises(tm.LoadError) as failure:
        load = tm.loader(spark).options(loadType="full", partitionColumn="nothing")
        load.load(f"{sf_dir}/orders.parquet")
    assert "UNRESOLVED_COLUMN" in str(failure.value.__cause__)
