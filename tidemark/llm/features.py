"""Sparse hashed words and structure statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.host_rules import measure
from tidemark.llm.text import LOWER, span_hashes, spans, text_bytes

STRUCTURE = (
    "words",
    "word_length",
    "symbols",
    "duplicate_lines",
    "repeated_words",
    "capitals",
    "digits",
    "punctuation",
    "distinct_words",
    "lines",
)

CAPITAL = np.zeros(256, bool)
CAPITAL[0x41:0x5B] = True
DIGIT = np.zeros(256, bool)
DIGIT[0x30:0x3A] = True
#: Letters, digits and every byte of the characters beyond ASCII.
LETTER = np.zeros(256, bool)
LETTER[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[list(b".,;:!?\"'()-")] = True


def _totals(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def hashed_words(
    texts: pa.Array, buckets: int, stems: tuple[int, ...] = ()
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets of each text's words and how often each occurs.

    A word is a run of letters and digits, with A-Z folded; with ``stems`` the first so many
    bytes of longer words count as words too.
    """
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, before = spans(LETTER[data], offsets)
    cuts = [ends, *(np.minimum(ends, starts + n) for n in stems)]
    places = np.stack([span_hashes(data, starts, cut) % np.uint64(buckets) for cut in cuts])
    places = places.astype(np.int64)
    for i in range(len(before) - 1):
        yield np.unique(places[:, before[i] : before[i + 1]], return_counts=True)


def structure(texts: pa.Array, distinct: np.ndarray) -> np.ndarray:
    """STRUCTURE of each text, as logarithms and shares; zeros for an empty text."""
    found = measure(texts)
    data, offsets = text_bytes(texts)
    n, chars = found["n_words"], found["word_chars"]
    some, letters = np.maximum(n, 1), np.maximum(chars, 1)
    lines = _totals(data == 0x0A, offsets) + 1
    return np.column_stack(
        [
            np.log1p(n),
            np.log1p(chars / some),
            found["n_symbols"] / letters,
            found["n_dup_lines"] / lines,
            found["n_repeat_words"] / some,
            _totals(CAPITAL[data], offsets) / letters,
            _totals(DIGIT[data], offsets) / letters,
            _totals(PUNCTUATION[data], offsets) / letters,
            distinct / some,
            np.log1p(lines / some),
        ]
    )
