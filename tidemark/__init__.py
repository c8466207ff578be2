"""Incremental, range-partitioned loading of tables with Spark."""

from tidemark.errors import LoadError, OptionError
from tidemark.functions import base64_binary_columns, is_splittable, normalise_timestamp
from tidemark.operators import (
    auto_increments,
    avg_row_size,
    dedup_any,
    dedup_latest,
    field_profile,
    key_candidates,
    key_check,
    provenance_rows,
    record_count,
    stride_layout,
    with_provenance,
)
from tidemark.plans.late import LateLoad
from tidemark.plans.loader import Loader, LoadResult, loader
from tidemark.plans.merge import MergeTarget
from tidemark.plans.ranges import (
    ColumnRange,
    column_range,
    footer_frame,
    footer_range,
    next_offset_frame,
    range_frame,
)
from tidemark.plans.strides import (
    StridePlan,
    plan_balanced,
    plan_strides,
    stride_id,
    stride_predicates,
    stride_summary,
)
from tidemark.plans.zones import ZoneMap
from tidemark.sinks import (
    hold_staged,
    stage,
    stage_query,
    stage_table,
    sweep_staged,
    write_files,
    write_jdbc,
)
from tidemark.sources.footers import file_facts
from tidemark.sources.jdbc import jdbc_column_range, jdbc_record_count

__all__ = [
    "ColumnRange",
    "LateLoad",
    "LoadError",
    "LoadResult",
    "Loader",
    "MergeTarget",
    "OptionError",
    "StridePlan",
    "ZoneMap",
    "auto_increments",
    "avg_row_size",
    "base64_binary_columns",
    "column_range",
    "dedup_any",
    "dedup_latest",
    "field_profile",
    "file_facts",
    "footer_frame",
    "footer_range",
    "hold_staged",
    "is_splittable",
    "jdbc_column_range",
    "jdbc_record_count",
    "key_candidates",
    "key_check",
    "loader",
    "next_offset_frame",
    "normalise_timestamp",
    "plan_balanced",
    "plan_strides",
    "provenance_rows",
    "range_frame",
    "record_count",
    "stage",
    "stage_query",
    "stage_table",
    "stride_id",
    "stride_layout",
    "stride_predicates",
    "stride_summary",
    "sweep_staged",
    "with_provenance",
    "write_files",
    "write_jdbc",
]
