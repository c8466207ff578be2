"""Packing along a space-filling curve.

Hashed document vectors are projected to a few dimensions, documents are range-sorted by
their Hilbert key, and every range packs its documents, in the order of the curve, into
sequences without gaps.  The rest of a range is cut into sequences whose lengths are powers
of two, so that nothing is padded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import (
    LOWER,
    batch_slices,
    empty_if_null,
    span_hashes,
    text_bytes,
    words,
)
from tidemark.sinks.staging import stage

SEQUENCE = 4096
END_ID = 2
DIMENSIONS = 4
BITS = 10
#: Buckets of the hashed document vector.
BUCKETS = 1 << 14
#: Chunks between white space whose ids a process remembers, and the characters of the longest.
CACHE_ENTRIES = 500_000
LONGEST_CACHED = 64

_PUNCTUATED = re.compile(r"(.*[^\W_])([!-&(-/:-@\[-`{-~]+)").fullmatch
_PROJECTION = np.random.default_rng(5).standard_normal((BUCKETS, DIMENSIONS))
_tokenizers: dict[str, Tokenizer] = {}


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of whole coordinates below ``2 ** bits``, one row for a point.

    The coordinates are turned into the transposed index bit by bit from the top (reflect or
    swap the lower bits of the first axis), gray-coded, and their bits interleaved.
    """
    x = points.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q, low = np.uint64(b), (one << np.uint64(b)) - one
        for i in range(n):
            high = (x[i] >> q) & one == one
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> np.uint64(b)) & one == one, (one << np.uint64(b)) - one, np.uint64(0))
    x ^= flip
    index = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << one | (x[i] >> np.uint64(b)) & one
    return index


def curve_keys(texts: pa.Array) -> np.ndarray:
    """Hilbert key of each text; a text without words lies in the middle."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, before = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    n = np.diff(before)
    sums = np.zeros((len(n), DIMENSIONS))
    full = np.flatnonzero(n)
    if len(full):
        vectors = _PROJECTION[hashes & np.uint64(BUCKETS - 1)]
        sums[full] = np.add.reduceat(vectors, before[:-1][full], axis=0)
    means = sums / np.maximum(n, 1)[:, None]
    cells = 1 << BITS
    points = np.clip((0.5 + means) * cells, 0, cells - 1).astype(np.int64)
    return hilbert_index(points, BITS).astype(np.int64)


class Tokenizer:
    """Ids of texts by the tokenizers library, chunk by chunk.

    The vocabulary's normaliser and pattern never join what white space parts, so the ids of a text are
    those of its chunks, and a chunk met before is looked up.  Nor do they join most letters and
    digits with a mark of ASCII punctuation after them (an apostrophe aside); which characters are
    parted from it, the library's own normaliser and pattern tell.  An added token of the
    vocabulary is matched before all that; a chunk that holds one is not parted.  A process remembers
    CACHE_ENTRIES chunks and then starts anew.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path)
        self.known: dict[str, bytes] = {}
        self.parted: dict[str, bool] = {}
        self.ends_word = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        added = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()]
        self.holds_added = re.compile("|".join(added) or "(?!)").search

    def _encode_words(self, found: list[str]) -> dict[str, bytes]:
        """Ids of pieces; those of letters alone go through the library as one text, whose ids
        are parted where words end."""
        run = [w for w in found if w.isalpha()]
        joined = self.library.encode_batch_fast([" ".join(run)], add_special_tokens=False)[0]
        ids = np.array(joined.ids, "<u4")
        ends = ((np.flatnonzero(self.ends_word[ids]) + 1) * 4).tolist()
        if len(ends) != len(run):  # a word that the normaliser parts
            run, ends = [], []
        held, new, start = ids.tobytes(), {}, 0
        for word, end in zip(run, ends):
            new[word] = held[start:end]
            start = end
        rest = [w for w in found if w not in new]
        encodings = self.library.encode_batch_fast(rest, add_special_tokens=False)
        new.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(rest, encodings))
        return new

    def _parts(self, character: str) -> bool:
        """Whether punctuation after this character is a piece of its own."""
        if character not in self.parted:
            normal = self.library.normalizer
            written = f"{character}("
            written = normal.normalize_str(written) if normal else written
            pieces = self.library.pre_tokenizer.pre_tokenize_str(written)
            self.parted[character] = len(pieces) > 1 and pieces[-1][0].removesuffix("</w>") == "("
        return self.parted[character]

    def _learn(self, missing: set[str]) -> None:
        """Remember the ids of chunks, parted from the punctuation at their end where that may be."""
        known = self.known
        words = {c for c in missing if c.isalpha()}
        pieces, parted = set(words), []
        for chunk in missing - words:
            found = _PUNCTUATED(chunk)
            if found and self._parts(found[1][-1]) and not self.holds_added(chunk):
                head, tail = found.groups()
                parted.append((chunk, head, tail))
                pieces.add(head)
                pieces.add(tail)
            else:
                pieces.add(chunk)
        new = self._encode_words([p for p in pieces if p not in known])
        known.update(new)
        known.update((chunk, known[head] + known[tail]) for chunk, head, tail in parted)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as 32-bit integers, end to end."""
        rows = []
        for text in texts:
            for space in "\t\n\v\f\r":
                if space in text:
                    text = text.replace(space, " ")
            rows.append(text.split(" "))
        known = self.known
        missing = set().union(*rows).difference(known)
        if missing and len(known) + len(missing) > CACHE_ENTRIES:
            known.clear()
            missing = set().union(*rows)
        if missing:
            self._learn(missing)
        encoded = [b"".join(map(known.__getitem__, row)) for row in rows]
        for chunk in missing:
            if len(chunk) > LONGEST_CACHED:
                del known[chunk]
        return encoded


def tokenizer(path: str) -> Tokenizer:
    if path not in _tokenizers:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, ids binary"
)


class Packer:
    """Cuts a stream of documents into sequences; holds one unfinished sequence at most."""

    def __init__(self, sequence: int, first_id: int):
        self.sequence, self.next_id = sequence, first_id
        self.open: list[tuple[int | None, int, int, bytes]] = []
        self.filled = 0

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[tuple]:
        total, at = len(ids) // 4, 0
        while at < total:
            n = min(total - at, self.sequence - self.filled)
            self.open.append((doc_id, at, total, ids[4 * at : 4 * (at + n)]))
            at += n
            self.filled += n
            if self.filled == self.sequence:
                yield from self._close(self.open)
                self.open, self.filled = [], 0

    def finish(self) -> Iterator[tuple]:
        """The rest, in sequences whose lengths are powers of two."""
        while self.filled:
            length = 1 << (self.filled.bit_length() - 1)
            taken, rest, room = [], [], length
            for doc_id, start, total, ids in self.open:
                n = min(room, len(ids) // 4)
                if n:
                    taken.append((doc_id, start, total, ids[: 4 * n]))
                if 4 * n < len(ids):
                    rest.append((doc_id, start + n, total, ids[4 * n :]))
                room -= n
            yield from self._close(taken)
            self.open, self.filled = rest, self.filled - length

    def _close(self, pieces: list[tuple]) -> Iterator[tuple]:
        offset = 0
        for doc_id, start, total, ids in pieces:
            yield doc_id, start, len(ids) // 4, total, self.next_id, offset, ids
            offset += len(ids) // 4
        self.next_id += 1


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    sequence: int = SEQUENCE,
    end_id: int = END_ID,
    partitions: int | None = None,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``sequence`` tokens: doc_id, start, length,
    doc_tokens, sequence_id, offset, ids (little-endian 32-bit).

    A document is its text's ids and then ``end_id``; a NULL or empty text is ``end_id`` alone.
    Every row is packed, also with a NULL or repeated id; an empty table gives no pieces.  Other
    columns are not read.  Sequence ids are unique; ranges lie along the curve.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        packer = Packer(sequence, TaskContext.get().partitionId() << 32)
        rows: list[tuple] = []
        for batch in batches:
            for part in batch_slices(batch, "text"):
                doc_ids, texts = (c.to_pylist() for c in part.columns)
                for doc_id, ids in zip(doc_ids, coder.encode_many(texts)):
                    rows.extend(packer.add(doc_id, ids + end))
                if rows:
                    yield _pieces(rows)
                    rows = []
        rows.extend(packer.finish())
        if rows:
            yield _pieces(rows)

    documents = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        empty_if_null(F.col(f"`{text_col}`")).alias("text"),
    )
    return _along_the_curve(documents, n).select("doc_id", "text").mapInArrow(packed, PIECES)


#: Bits below the curve key that part documents with one key, and bytes that count as one place.
TIE_BITS = 12
PLACE_BYTES = 1024


def _along_the_curve(documents: DataFrame, n: int) -> DataFrame:
    """``doc_id, text`` in n partitions along the curve, each in the order of the curve and all of
    about the same bytes.

    Keys are computed once and staged with the texts.  A sketch of their quantiles, in which a document
    counts for its bytes, gives the borders, n - 1 numbers; documents with one key are dealt by a hash
    of their row, so that copies of one text do not pile up.
    """

    @F.arrow_udf("bigint")
    def curve_key(texts: pa.Array) -> pa.Array:
        slices = batch_slices(pa.RecordBatch.from_arrays([texts], ["text"]), "text")
        keys = [curve_keys(part.column("text")) for part in slices]
        return pa.array(np.concatenate([np.zeros(0, np.int64), *keys]))

    tie = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << TIE_BITS))
    keyed = stage(
        documents.withColumn("row", tie).withColumn("key", curve_key("text")).select(
            "doc_id", "text", F.expr(f"shiftleft(key, {TIE_BITS}) | row").alias("code")
        )
    )
    places = F.expr(f"explode(sequence(0, octet_length(text) div {PLACE_BYTES}))").alias("place")
    shares = [i / n for i in range(1, n)]
    borders = np.zeros(0, np.int64)
    if shares:
        sketch = F.percentile_approx("code", shares, max(10_000, 20 * n)).alias("borders")
        found = keyed.select("code", places).agg(sketch).first()
        borders = np.array(found["borders"] or [], np.int64)

    @F.arrow_udf("int")
    def range_of(codes: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(borders, codes.to_numpy(), "left"), pa.int32())

    dealt = keyed.withColumn("range", range_of("code")).repartitionById(n, "range")
    return dealt.sortWithinPartitions("code", "doc_id", "text")


def _pieces(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 6 + [pa.binary()]
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
    )
