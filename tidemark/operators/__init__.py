"""DataFrame operators."""

from tidemark.operators.dedup import dedup_any, dedup_latest
from tidemark.operators.keys import key_candidates
from tidemark.operators.layout import stride_layout
from tidemark.operators.profile import (
    auto_increments,
    avg_row_size,
    field_profile,
    key_check,
    record_count,
)
from tidemark.operators.provenance import provenance_rows, with_provenance

__all__ = [
    "auto_increments",
    "avg_row_size",
    "dedup_any",
    "dedup_latest",
    "field_profile",
    "key_candidates",
    "key_check",
    "provenance_rows",
    "record_count",
    "stride_layout",
    "with_provenance",
]
