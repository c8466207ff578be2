"""Column-level functions."""

from tidemark.functions.binary import base64_binary_columns
from tidemark.functions.timestamps import normalise_timestamp
from tidemark.functions.types import is_splittable

__all__ = ["base64_binary_columns", "is_splittable", "normalise_timestamp"]
