"""Words of whole texts as numpy spans: the helper that the text operators share.

An Arrow column of strings is one byte buffer with offsets, so the words of many
documents are found, and hashed to 64 bits, by a few array operations.  Bytes decide:
white space is ``[\\x20\\x09-\\x0D]`` and case is folded for A-Z only, which never cuts a
UTF-8 sequence.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that one round of array operations takes; a longer text is a round of its own.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_RANDOM = np.random.default_rng(20260)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MULTIPLY = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def empty_if_null(column: Column) -> Column:
    """A text column with NULL read as empty."""
    return F.coalesce(column, F.lit(""))


def batch_slices(batch: pa.RecordBatch, column: str | int) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about SLICE_BYTES of text each, without copying."""
    offsets = _offsets(batch.column(column))
    start = 0
    while start < batch.num_rows:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
        stop = min(max(stop, start + 1), batch.num_rows)
        yield batch.slice(start, stop - start)
        start = stop


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    ends = np.frombuffer(texts.buffers()[1], kind) if texts.buffers()[1] else np.zeros(1, kind)
    return ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of strings, end to end, and the n + 1 offsets of its rows."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    offsets = _offsets(texts)
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes, cut at row borders; runs before each row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    borders = offsets[(offsets > 0) & (offsets < len(inside))]
    first[borders] = inside[borders]
    last[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the bytes; words before each row (n + 1 numbers)."""
    return spans(~SPACE[data], offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLY
    h = (h ^ (h >> np.uint64(32))) * _MULTIPLY
    return h ^ (h >> np.uint64(32))


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        table[0] = 1
        table = np.cumprod(table, dtype=np.uint64)
        if n <= 2 * SLICE_BYTES:
            _powers[base] = table
    return table[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, the same wherever the span lies."""
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power_table(_BASE, len(data)), out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * _power_table(_BASE_INVERSE, len(data) + 1)[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def shingles(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of k words of one text; of the whole text if it is shorter."""
    n = len(word_hashes)
    k = min(k, n)
    if not n:
        return word_hashes
    h = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        h = mix(h + word_hashes[j : n - k + 1 + j])
    return h
