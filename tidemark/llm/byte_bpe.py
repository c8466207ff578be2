"""Byte-level BPE through sentencepiece, from a file of ranks.

A sentencepiece BPE model is serialised directly from the vocabulary: every token's bytes
become characters, one for each byte, its score is the negative rank, and the normaliser is
the identity.  sentencepiece then merges the pair of the best score, the leftmost on ties,
which is the rule of the rank file.  Pre-tokens are cut by the pattern and encoded one by
one; ids are decoded by the inverse mapping.

The pattern's letters and digits are those of tiktoken.  The ``regex`` package knows newer ones: where it takes
a character for another class, the pattern sees a stand-in of tiktoken's class.
"""

from __future__ import annotations

import base64
import struct
import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.text import empty_if_null

#: Pre-tokens whose ids a task remembers; beyond it the memory starts anew.
CACHE_ENTRIES = 400_000

#: Byte b is written as the character of code point 0x100 + b.
_TO_CHARACTER = {b: 0x100 + b for b in range(256)}

_encoders: dict[tuple[str, str], Encoder] = {}


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file in the order of their ranks, which have no gaps."""
    with open(path, "rb") as file:
        pairs = [line.split() for line in file if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens[rank] for rank in range(len(tokens))]


def as_characters(token: bytes) -> str:
    return token.decode("latin-1").translate(_TO_CHARACTER)


@cache
def classed_otherwise() -> dict[int, str]:
    """Code points that tiktoken puts into another class than ``regex``, with a stand-in of tiktoken's class:
    a letter, a digit or a mark that is neither.

    Found by encoding every character with single bytes as tokens and a class as pattern, since
    tiktoken passes over what a pattern does not match.
    """
    import tiktoken

    single = {bytes([b]): b for b in range(256)}
    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    theirs, ours = {}, {}
    for stand_in, pattern in (("x", r"\p{L}"), ("0", r"\p{N}")):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        held = bytes(probe.encode_ordinary(every)).decode()
        theirs |= dict.fromkeys(map(ord, held), stand_in)
        ours |= dict.fromkeys(map(ord, regex.findall(pattern, every)), stand_in)
    return {c: theirs.get(c, "!") for c in theirs.keys() | ours.keys() if theirs.get(c) != ours.get(c)}


@cache
def _is_classed_otherwise() -> np.ndarray:
    marked = np.zeros(sys.maxunicode + 1, bool)
    marked[list(classed_otherwise())] = True
    return marked


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    """A protocol-buffer field: a varint, a 32-bit float or a run of bytes."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """The serialised model; piece i is token i, and the unknown piece comes last.

    Fixed values of the format: in a piece 1 text, 2 score, 3 kind (1 normal, 2 unknown); in the
    trainer part 3 model kind (2: BPE) and 4 size; in the normaliser part 1 name, 3 dummy
    prefix, 4 removal of white space, 5 escape of white space.
    """
    pieces = [
        _field(1, _field(1, as_characters(t).encode()) + _field(2, -float(rank)) + _field(3, 1))
        for rank, t in enumerate(tokens)
    ]
    unknown = _field(1, _field(1, b"<unk>") + _field(2, 0.0) + _field(3, 2))
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens))
    normaliser = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join([*pieces, unknown, _field(2, trainer), _field(3, normaliser)])


class Encoder:
    """Encodes and decodes texts; one for each task's process."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.tokens = read_ranks(path)
        self.pattern = regex.compile(pattern)
        self.pieces = sentencepiece.SentencePieceProcessor(
            model_proto=sentencepiece_model(self.tokens)
        )
        self.known: dict[str, bytes] = {}

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text, as tiktoken finds them."""
        if not text.isascii():
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            if _is_classed_otherwise()[points].any():
                seen = text.translate(classed_otherwise())
                return [text[slice(*m.span())] for m in self.pattern.finditer(seen)]
        return self.pattern.findall(text)

    def encode_bytes(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers, end to end."""
        found = self.cut(text)
        missing = [t for t in set(found) if t not in self.known]
        if missing:
            if len(self.known) + len(missing) > CACHE_ENTRIES:
                self.known.clear()
                missing = list(set(found))
            written = [as_characters(t.encode()) for t in missing]
            for token, ids in zip(missing, self.pieces.encode(written, num_threads=1)):
                self.known[token] = np.array(ids, "<i4").tobytes()
        return b"".join(map(self.known.__getitem__, found))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), "<i4").tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encoder(path: str, pattern: str) -> Encoder:
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def _lists(parts: list[bytes]) -> pa.Array:
    lengths = np.array([0, *(len(p) // 4 for p in parts)], np.int64).cumsum()
    values = pa.Array.from_buffers(pa.int32(), int(lengths[-1]), [None, pa.py_buffer(b"".join(parts))])
    return pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), values)


def encode(
    df: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids"
) -> DataFrame:
    """``df`` with a column ``ids_col`` of token ids in place of its text.

    ``path`` names the rank file, which every executor has.  NULL and empty texts get an empty
    list; every other column passes through, but one
    already called ``ids_col``, which is replaced.  Repeated rows are encoded each; an empty table
    stays empty.
    """
    if ids_col.lower() != text_col.lower():
        df = df.drop(ids_col)
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                ids = _lists([coder.encode_bytes(t) for t in batch.column(at).to_pylist()])
                columns = list(batch.columns)
                columns[at] = ids
                names = list(batch.schema.names)
                names[at] = ids_col
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = T.StructType(list(df.schema))
    schema.fields[at] = T.StructField(ids_col, T.ArrayType(T.IntegerType()))
    schema = T.StructType(schema.fields)
    return df.withColumn(text_col, empty_if_null(F.col(f"`{text_col}`"))).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``df`` with a binary column ``bytes_col`` of the bytes its ids stand for (NULL: none), which
    replaces a column of that name."""
    df = df.drop(bytes_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = np.array(read_ranks(path), object)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                lists = batch.column(ids_col)
                decoded = [b"".join(tokens[x.values.to_numpy()].tolist()) if x.is_valid else b"" for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(decoded, pa.binary())],
                    names=[*batch.schema.names, bytes_col],
                )

    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField(bytes_col, T.BinaryType())]))


def ids_digest(ids: Column) -> Column:
    """Hex SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
