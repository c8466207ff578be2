"""Load options and the rules they obey."""

from __future__ import annotations

import warnings
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from tidemark.errors import OptionError
from tidemark.functions.timestamps import is_zone

# Option names, load types and the default number of partitions.
URL, DBTABLE, PATH, FORMAT = "url", "dbtable", "path", "format"
LOAD_TYPE, OFFSET = "loadType", "offset"
PARTITION_COLUMN, NUM_PARTITIONS = "partitionColumn", "numPartitions"
FULL, INCREMENTAL = "full", "incremental"
DEFAULT_NUM_PARTITIONS = 100

# Options of this library.
LAYOUT, FOOTER_STATS, MAX_PARTITION_ROWS = "layout", "footerStats", "maxPartitionRows"
SALT_COLUMN, SALT_BUCKETS = "saltColumn", "saltBuckets"
QUERY, TEMPDIR, OFFSET_ZONE = "query", "tempdir", "offsetZone"
ZONE_MAP, BALANCED, LATE_RANGE = "zoneMap", "balancedStrides", "lateRange"
SCAN, STRIDE = "scan", "stride"

OWN_OPTIONS = (
    URL,
    DBTABLE,
    PATH,
    FORMAT,
    LOAD_TYPE,
    OFFSET,
    PARTITION_COLUMN,
    NUM_PARTITIONS,
    LAYOUT,
    FOOTER_STATS,
    MAX_PARTITION_ROWS,
    SALT_COLUMN,
    SALT_BUCKETS,
    QUERY,
    TEMPDIR,
    OFFSET_ZONE,
    ZONE_MAP,
    BALANCED,
    LATE_RANGE,
)
CREDENTIALS = ("user", "password")


@dataclass(frozen=True)
class LoadSpec:
    """Checked options of one load."""

    table: str | DataFrame
    url: str | None = None
    named_table: bool = False
    format: str = "parquet"
    load_type: str = INCREMENTAL
    offset: str = ""
    partition_column: str = ""
    num_partitions: int = DEFAULT_NUM_PARTITIONS
    layout: str = SCAN
    footer_stats: bool = False
    max_partition_rows: int | None = None
    salt_column: str = ""
    salt_buckets: int = 1
    query: str = ""
    tempdir: str = ""
    offset_zone: str = ""
    zone_map: str = ""
    balanced: bool = False
    late_range: bool = False
    reader_options: Mapping[str, str] = field(default_factory=dict)

    @property
    def is_jdbc(self) -> bool:
        return self.url is not None

    @property
    def is_incremental(self) -> bool:
        return self.load_type == INCREMENTAL

    @property
    def table_name(self) -> str:
        if self.query:
            return QUERY
        return self.table if isinstance(self.table, str) else "dataframe"

    @classmethod
    def of(cls, options: Mapping[str, Any], source: str | DataFrame | None = None) -> LoadSpec:
        """Check ``options`` (names in any case) and the argument of ``load``."""
        given = {k.lower(): _text(v) for k, v in options.items() if v is not None}

        def option(name: str, default: str = "") -> str:
            return given.get(name.lower(), default)

        url = option(URL) or None
        file_format = option(FORMAT, "jdbc" if url else "parquet").lower()
        if file_format == "jdbc" and url is None:
            raise OptionError("a JDBC source needs the option url")
        if file_format != "jdbc" and url is not None:
            raise OptionError(f"the option url does not go with format {file_format}")

        table = option(DBTABLE) or source
        if table is None:
            table = option(PATH)
        query = option(QUERY)
        if query:
            if isinstance(table, DataFrame) or table:
                raise OptionError("load a query or a table, not both")
            # The database gets the query as a subquery it can add conditions to.
            table = f"({query}) load_query" if url else query
        if isinstance(table, str) and not table:
            raise OptionError("name the table with the option dbtable or in load(name)")
        if isinstance(table, DataFrame) and url is not None:
            raise OptionError("load a DataFrame or a JDBC table, not both")

        load_type = option(LOAD_TYPE, INCREMENTAL).lower()
        offset, column = option(OFFSET), option(PARTITION_COLUMN)
        if load_type == INCREMENTAL:
            if bool(offset) != bool(column):
                raise OptionError(
                    "an incremental load takes both offset and partitionColumn, or neither"
                )
        elif load_type == FULL:
            if offset:
                raise OptionError("a full load takes no offset")
        else:
            raise OptionError(f"loadType is full or incremental, not {load_type!r}")

        layout = option(LAYOUT, SCAN).lower()
        if layout not in (SCAN, STRIDE):
            raise OptionError(f"layout is scan or stride, not {layout!r}")
        if layout == STRIDE and not column:
            raise OptionError("the stride layout needs a partitionColumn")

        zone_map = option(ZONE_MAP)
        if zone_map and (not column or url is not None):
            raise OptionError("zoneMap is for loads of a path of Parquet files with a partitionColumn")
        balanced = _flag(BALANCED, option(BALANCED))
        if balanced and (url is not None or not column):
            raise OptionError("balancedStrides is for loads with a partitionColumn that Spark reads itself")

        offset_zone = option(OFFSET_ZONE)
        if offset_zone and not is_zone(offset_zone):
            raise OptionError(f"offsetZone is Z or +HH:mm, not {offset_zone!r}")

        salt_column = option(SALT_COLUMN)
        salt_buckets = _positive(SALT_BUCKETS, option(SALT_BUCKETS))
        if bool(salt_column) != bool(salt_buckets):
            raise OptionError("saltColumn and saltBuckets go together")
        if salt_column and (url is None or not column):
            raise OptionError("saltColumn is for JDBC loads with a partitionColumn")

        if url is not None and any(name in given for name in CREDENTIALS):
            warnings.warn("user and password are ignored; put them in the url", stacklevel=3)
        known = {name.lower() for name in (*OWN_OPTIONS, *CREDENTIALS)}
        return cls(
            table=table,
            url=url,
            named_table=bool(option(DBTABLE)),
            format=file_format,
            load_type=load_type,
            offset=offset,
            partition_column=column,
            num_partitions=_positive(NUM_PARTITIONS, option(NUM_PARTITIONS)) or DEFAULT_NUM_PARTITIONS,
            layout=layout,
            footer_stats=_flag(FOOTER_STATS, option(FOOTER_STATS)),
            max_partition_rows=_positive(MAX_PARTITION_ROWS, option(MAX_PARTITION_ROWS)),
            salt_column=salt_column,
            salt_buckets=salt_buckets or 1,
            query=query,
            tempdir=option(TEMPDIR),
            offset_zone=offset_zone,
            zone_map=zone_map,
            balanced=balanced,
            late_range=_flag(LATE_RANGE, option(LATE_RANGE)),
            reader_options={k: _text(v) for k, v in options.items() if k.lower() not in known},
        )


def _text(value: Any) -> str:
    return str(value).lower() if isinstance(value, bool) else str(value)


def _positive(name: str, text: str) -> int | None:
    if not text:
        return None
    try:
        n = int(text)
    except ValueError:
        raise OptionError(f"{name} is a whole number, not {text!r}") from None
    if n < 1:
        raise OptionError(f"{name} must be at least 1, not {n}")
    return n


def _flag(name: str, text: str) -> bool:
    if text.lower() not in ("", "true", "false"):
        raise OptionError(f"{name} is true or false, not {text!r}")
    return text.lower() == "true"
