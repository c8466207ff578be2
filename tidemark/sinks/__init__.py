"""Where rows go."""

from tidemark.sinks.files import write_files
from tidemark.sinks.jdbc import write_jdbc
from tidemark.sinks.staging import (
    fresh_path,
    hold_staged,
    shared_dir,
    stage,
    stage_query,
    stage_table,
    sweep_staged,
)

__all__ = [
    "fresh_path",
    "hold_staged",
    "shared_dir",
    "stage",
    "stage_query",
    "stage_table",
    "sweep_staged",
    "write_files",
    "write_jdbc",
]
