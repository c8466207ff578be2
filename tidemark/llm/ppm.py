"""Language-model scoring: prediction by partial matching over bytes, and a word baseline.

The contexts of up to five bytes form a trie with counts of the symbols that followed them in
the training texts (bytes with A-Z folded, and the end of the text).  A symbol that a context has
not seen is coded as an escape, whose weight is the number of distinct symbols seen, and then
by the next shorter context, without the symbols that the longer one excludes.  A document's
score is its code length.  Every context of the training texts has a node.  The trie is a table in
bins by the last two bytes of the contexts, so that a bin holds all suffixes of its contexts
(those under two bytes, 257 at most, go to every bin).  Bins are filled evenly, at most MOST_BINS of them
at any size of the input; beyond that every bin has copies in proportion to the keys it holds, and
chunks of documents are dealt over the copies.  A chunk sends each of its
distinct contexts with their symbols to one copy of their bin, which answers with code lengths.

The baseline needs the corpus count of every word.  Words stay with their chunk of documents:
a chunk sends each of its distinct words once, as a 64-bit hash in one array for each
shard, shards sum the counts, and answer every chunk with an array in the same order.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import (
    LOWER,
    SLICE_BYTES,
    batch_slices,
    empty_if_null,
    span_hashes,
    text_bytes,
    words,
)
from tidemark.sinks.staging import stage

ORDER = 5
#: Last bytes of a context that decide on its shard.
SHARD_BYTES = 2
END = 256
SYMBOLS = 257
FOLDS, HELD_FOLD = 7, 2
#: Bins that suffixes are dealt into, whatever the size of the input.
MOST_BINS = 1024
#: Bytes of text in a chunk of documents.
CHUNK_BYTES = 8 << 20
#: Keys that a task keeps summed while it counts symbols; up to twice as many, with 50 bytes each, meet in a sum.
TASK_KEYS = 1 << 20
#: The hash that stands for the end of a text among the words.
END_WORD = np.uint64(0x5EED0FE2D)


def held_out(id_col: str = "doc_id") -> F.Column:
    """Whether a document is kept from training; a NULL id is never trained on."""
    fold = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_FOLD, F.lit(True))


def contexts_and_symbols(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ORDER bytes before every symbol of the texts as one number (bytes before the start
    are 0), the symbols, and the n + 1 offsets of the texts' symbols."""
    n = len(offsets) - 1
    starts = offsets + np.arange(n + 1)
    symbols = np.full(len(data) + n, END, np.int64)
    row = np.repeat(np.arange(n), np.diff(offsets))
    symbols[np.arange(len(data)) + row] = LOWER[data]
    contexts = np.zeros(len(symbols), np.int64)
    for back in range(1, ORDER + 1):
        before = np.zeros(len(symbols), np.int64)
        before[back:] = symbols[:-back]
        for j in range(back):
            at = starts[:-1] + j
            before[at[at < starts[1:]]] = 0
        contexts |= before << (8 * (back - 1))
    return contexts, symbols, starts


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    every = every[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    return every[new], np.add.reduceat(np.concatenate(counts)[order], np.flatnonzero(new))


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the symbols after the contexts of a task's texts.

    Slices are summed whenever they hold 2 * TASK_KEYS keys; sums of more than TASK_KEYS go out, and
    the same keys may come again.
    """
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for batch in batches:
        for part in batch_slices(batch, "text"):
            contexts, symbols, _ = contexts_and_symbols(*text_bytes(part.column("text")))
            contexts <<= 9
            contexts |= symbols
            key, n = np.unique(contexts, return_counts=True)
            del contexts, symbols
            keys.append(key)
            counts.append(n)
            if sum(map(len, keys)) > 2 * TASK_KEYS:
                key, n = _summed(keys, counts)
                keys, counts = [key], [n]
                if len(key) > TASK_KEYS:
                    yield from _count_rows(key, n)
                    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    yield from _count_rows(*_summed(keys, counts))


def _count_rows(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(key), 100_000):
        k = key[start : start + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k >> 9), pa.array((k & 511).astype(np.int32)), pa.array(n[start : start + 100_000])],
            names=["context", "symbol", "n"],
        )


def symbol_counts(documents: DataFrame) -> DataFrame:
    """``context, symbol, n`` over all texts of ``documents``, summed in each task first."""
    counted = documents.select("text").mapInArrow(_task_counts, "context bigint, symbol int, n bigint")
    return counted.groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def _found(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted values, and whether they are there."""
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return at, known[at] == wanted


def _suffixes(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & ((1 << (8 * order + 9)) - 1)


@dataclass
class Short:
    """What every shard has: keys (``context << 9 | symbol``) and counts of order 1, and the only
    contexts of the orders from SHARD_BYTES on that have nodes, if the caller bounds them."""

    keys: np.ndarray
    counts: np.ndarray
    most: dict[int, np.ndarray]


class Shard:
    """The nodes of a shard and code lengths by them.

    A node has the sum and number of its counts, and what is left of those of its parent (its
    longest suffix with a node) without its own symbols.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, short: Short):
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.nodes: list[np.ndarray] = []
        self.facts: list[np.ndarray] = []
        for order in range(ORDER + 1):
            own = (short.keys, short.counts) if order < SHARD_BYTES else (keys, counts)
            key, n = _summed([_suffixes(own[0], order)], [own[1]])
            if order in short.most:
                keep = np.isin(key >> 9, short.most[order])
                key, n = key[keep], n[keep]
            node, first, distinct = np.unique(key >> 9, return_index=True, return_counts=True)
            facts = np.zeros((4, len(node)))
            if len(node):
                facts[:2] = np.add.reduceat(n, first), distinct
            open_ = np.ones(len(node), bool)
            for shorter in range(order - 1, -1, -1):
                at, hit = _found(self.nodes[shorter], node & ((1 << 8 * shorter) - 1))
                hit &= open_
                place, seen = _found(self.keys[shorter], _suffixes(key, shorter))
                if hit.any():
                    of_parent = np.add.reduceat(np.where(seen, self.counts[shorter][place], 0), first)
                    facts[2:, hit] = self.facts[shorter][:2, at[hit]]
                    facts[2:, hit] -= np.stack([of_parent[hit], distinct[hit]])
                open_ &= ~hit
            self.keys.append(key)
            self.counts.append(n)
            self.nodes.append(node)
            self.facts.append(facts)

    def lengths(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the chance of the symbol of each key after its context.

        The longest known suffix codes the symbol or an escape, and each shorter one what is
        left to it.
        """
        chance = np.ones(len(keys))
        size, escape = np.full(len(keys), -1.0), np.ones(len(keys))
        open_ = np.arange(len(keys))
        for order in range(ORDER, -1, -1):
            own = _suffixes(keys[open_], order)
            at, known = _found(self.nodes[order], own >> 9)
            rows, at, own = open_[known], at[known], own[known]
            if not len(rows):
                continue
            total, distinct, left, left_distinct = self.facts[order][:, at]
            entered = size[rows] >= 0
            whole = np.where(entered, np.maximum(size[rows], 1), total + distinct)
            escape_here = np.where(entered, escape[rows], distinct / (total + distinct))
            place, seen = _found(self.keys[order], own)
            chance[rows] *= np.where(seen, self.counts[order][place] / whole, escape_here)
            size[rows] = left + left_distinct
            escape[rows] = np.where(left_distinct > 0, left_distinct / np.maximum(left + left_distinct, 1), 1)
            if order == 0:
                chance[rows[~seen]] /= np.maximum(SYMBOLS - distinct[~seen], 1)
            done = np.zeros(len(keys), bool)
            done[rows[seen]] = True
            open_ = open_[~done[open_]]
        if not len(self.nodes[0]):
            chance[:] = 1 / SYMBOLS
        return np.log10(chance)


@dataclass
class Bins:
    """Which bin each suffix of SHARD_BYTES belongs to, and the copies of each bin.

    Copy k of bin b is part ``first[b] + k``; a chunk asks copy ``chunk mod copies``.
    """

    bin_of: np.ndarray
    first: np.ndarray
    copies: np.ndarray

    @classmethod
    def of(cls, suffixes: np.ndarray, keys: np.ndarray, parts: int) -> Bins:
        """Bins for about ``parts`` parts of even numbers of keys; suffixes that have none go anywhere."""
        count = min(parts, MOST_BINS)
        weight = np.zeros(1 << 8 * SHARD_BYTES, np.int64)
        weight[suffixes] = keys
        bin_of = np.arange(len(weight)) % count
        loads = [(0, b) for b in range(count)]
        for suffix in np.argsort(-weight, kind="stable")[: len(suffixes)].tolist():
            load, b = heapq.heappop(loads)  # the emptiest bin
            bin_of[suffix] = b
            heapq.heappush(loads, (load + int(weight[suffix]), b))
        held = np.bincount(bin_of, weight, count)
        copies = np.maximum(np.rint(held / max(held.sum(), 1) * parts), 1).astype(np.int64)
        return cls(bin_of, np.concatenate([[0], np.cumsum(copies)[:-1]]), copies)

    @property
    def parts(self) -> int:
        return int(self.copies.sum())

    def bins(self, keys: np.ndarray) -> np.ndarray:
        """The bin of each ``context << 9 | symbol``."""
        return self.bin_of[keys >> 9 & ((1 << 8 * SHARD_BYTES) - 1)]

    def part(self, chunk: int, bin_: int) -> int:
        return int(self.first[bin_] + chunk % self.copies[bin_])


def _bins(counts: DataFrame, parts: int) -> Bins:
    """From the keys of every suffix, 65,536 numbers at most."""
    suffix = F.expr(f"context & {(1 << 8 * SHARD_BYTES) - 1}L").alias("suffix")
    found = counts.groupBy(suffix).agg(F.count("*").alias("n")).toPandas()
    return Bins.of(found["suffix"].to_numpy(np.int64), found["n"].to_numpy(np.int64), parts)


def _short(counts: DataFrame, max_contexts: int | None) -> Short:
    """At most 257 contexts with their symbols, and what the caller bounds, reach the driver."""

    def suffix(order: int) -> F.Column:
        return F.expr(f"context & {(1 << 8 * order) - 1}L").alias("context")

    first = counts.groupBy(suffix(1), "symbol").agg(F.sum("n").alias("n")).toPandas()
    most = {}
    for order in range(SHARD_BYTES, ORDER + 1) if max_contexts is not None else ():
        totals = counts.groupBy(suffix(order)).agg(F.sum("n").alias("total"))
        top = totals.orderBy(F.desc("total"), "context").limit(max_contexts).toPandas()
        most[order] = np.sort(top["context"].to_numpy(np.int64))
    keys = first["context"].to_numpy(np.int64) << 9 | first["symbol"].to_numpy(np.int64)
    return Short(keys, first["n"].to_numpy(np.int64), most)


def _pressed(data: bytes) -> bytes:
    """Compressed bytes, behind their length: what chunks stage and send is most of the disk."""
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpressed(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, which pack well, compressed."""
    return _pressed(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def _from_planes(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(_unpressed(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys by their steps."""
    return _planes(np.diff(keys, prepend=0).astype("<i8"))


def _unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data, "<i8"))


def _lengths(counts: DataFrame, staged: DataFrame, short: Short, bins: Bins) -> DataFrame:
    """``chunk, shard, logs``: code lengths of the keys of every chunk, by bin.

    In a part the counts of its bin come first, and the keys of the chunks are answered in passing.
    """
    broadcast = counts.sparkSession.sparkContext.broadcast(short)
    own_bins = counts.sparkSession.sparkContext.broadcast(bins)

    @F.arrow_udf("array<int>")
    def parts_of(keys: pa.Array) -> pa.Array:
        """Every part that holds a copy of the bin of a key."""
        held = own_bins.value
        of = held.bins(keys.to_numpy())
        first, copies = held.first[of], held.copies[of]
        ends = np.concatenate([[0], np.cumsum(copies)])
        parts = np.arange(ends[-1]) + np.repeat(first - ends[:-1], copies)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(parts, pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, counts, nodes = None, [], [], None
        for batch in batches:
            shard_ids = batch.column("part").to_numpy()
            trained = batch.column("keys").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((np.diff(shard_ids) != 0) | (trained[1:] != trained[:-1])) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(shard_ids)]):
                part = batch.slice(start, stop - start)
                if at != shard_ids[start]:
                    at, keys, counts, nodes = shard_ids[start], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], None
                if trained[start]:
                    keys.append(part.column("key").to_numpy())
                    counts.append(part.column("n").to_numpy())
                    continue
                if nodes is None:
                    nodes = Shard(np.concatenate(keys), np.concatenate(counts), broadcast.value)
                    keys, counts = [], []
                for chunk, bin_, wanted in zip(*(part.column(c) for c in ("chunk", "shard", "keys"))):
                    logs = _planes(nodes.lengths(_unpacked_keys(wanted.as_py())).astype("<f4"))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk.as_py()], pa.int64()), pa.array([bin_.as_py()], pa.int32()), pa.array([logs], pa.binary())],
                        names=["chunk", "shard", "logs"],
                    )

    known = counts.withColumn("key", F.expr("shiftleft(context, 9) | symbol")).select(
        F.explode(parts_of("key")).alias("part"),
        F.lit(None).cast("int").alias("shard"),
        F.lit(None).cast("bigint").alias("chunk"),
        "key",
        "n",
        F.lit(None).cast("binary").alias("keys"),
    )
    asked = staged.where("keys IS NOT NULL").selectExpr(
        "part", "shard", "chunk", "CAST(NULL AS bigint) AS key", "CAST(NULL AS bigint) AS n", "keys"
    )
    return (
        known.unionByName(asked)
        .repartitionById(bins.parts, "part")
        .sortWithinPartitions("part", F.asc_nulls_first("chunk"), "shard")
        .mapInArrow(run, "chunk bigint, shard int, logs binary")
    )


def _slices(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Distinct keys, the place of every symbol's among them, and the symbols' offsets, for slices
    of about SLICE_BYTES of whole texts."""
    start = 0
    while start < len(offsets) - 1:
        stop = int(np.searchsorted(offsets, offsets[start] + SLICE_BYTES, "right")) - 1
        stop = max(stop, start + 1)
        a, b = offsets[start], offsets[stop]
        contexts, symbols, starts = contexts_and_symbols(data[a:b], offsets[start : stop + 1] - a)
        known, place = np.unique(contexts << 9 | symbols, return_inverse=True)
        yield known, place.astype(np.int32), starts
        start = stop


def _dealt(known: list[np.ndarray], bins: Bins) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct keys of slices, their order by bin, and the n + 1 borders of the bins."""
    keys = np.unique(np.concatenate(known))
    of = bins.bins(keys)
    order = np.argsort(of, kind="stable")
    return keys, order, np.searchsorted(of[order], np.arange(len(bins.copies) + 1))


STAGED = (
    "chunk bigint, shard int, part int, words binary, counts binary, keys binary, doc_ids array<bigint>, "
    "held array<boolean>, text binary, sizes binary, before binary, places binary"
)
_STAGED = {
    "chunk": pa.int64(),
    "shard": pa.int32(),
    "part": pa.int32(),
    "words": pa.binary(),
    "counts": pa.binary(),
    "keys": pa.binary(),
    "doc_ids": pa.list_(pa.int64()),
    "held": pa.list_(pa.bool_()),
    "text": pa.binary(),
    "sizes": pa.binary(),
    "before": pa.binary(),
    "places": pa.binary(),
}


def _staged_row(**values) -> pa.RecordBatch:
    columns = [pa.array([values.get(name)], kind) for name, kind in _STAGED.items()]
    return pa.RecordBatch.from_arrays(columns, names=list(_STAGED))


def _chunk_rows(chunk: int, shards: int, bins: Bins, rows: list[tuple]) -> Iterator[pa.RecordBatch]:
    """A chunk's own row, a row for each shard with its words and their training counts, and
    a row for each bin with the keys of its contexts and symbols; every row by itself.

    ``rows`` are doc_ids, held, folded bytes, sizes, word hashes and words of each document, by slice.
    """
    ids = [i for r in rows for i in r[0]]
    held, sizes, per_doc = (np.concatenate([r[k] for r in rows]) for k in (1, 3, 5))
    known, place = np.unique(np.concatenate([r[4] for r in rows]), return_inverse=True)
    data = np.concatenate([r[2] for r in rows])
    rows.clear()
    count = np.uint64(shards)
    order = np.argsort(known % count, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    place, known = rank[place], known[order]
    yield _staged_row(
        chunk=chunk,
        doc_ids=ids,
        held=held.tolist(),
        text=_pressed(data.tobytes()),
        sizes=sizes.astype("<i8").tobytes(),
        before=per_doc.astype("<i8").tobytes(),
        places=_planes(place.astype("<u4")),
    )
    trained = np.repeat(~held, per_doc)
    counts = np.bincount(place[trained], minlength=len(known))
    del place, trained, rank, order
    ends = np.searchsorted(known % count, np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(ends)).tolist():
        some = slice(ends[s], ends[s + 1])
        yield _staged_row(chunk=chunk, shard=s, words=known[some].tobytes(), counts=_planes(counts[some].astype("<i8")))
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    keys, by_bin, borders = _dealt([k for k, _, _ in _slices(data, offsets)], bins)
    for b in np.flatnonzero(np.diff(borders)).tolist():
        wanted = keys[by_bin[borders[b] : borders[b + 1]]]
        yield _staged_row(chunk=chunk, shard=b, part=bins.part(chunk, b), keys=_packed_keys(wanted))


def _chunks(documents: DataFrame, shards: int, bins: Bins) -> DataFrame:
    shared = documents.sparkSession.sparkContext.broadcast(bins)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, rows, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            for part in batch_slices(batch, "text"):
                data, offsets = text_bytes(part.column("text"))
                data = LOWER[data]
                a, b, before = words(data, offsets)
                hashes = np.insert(span_hashes(data, a, b), before[1:], END_WORD)
                held = part.column("held").to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").to_pylist()
                rows.append((ids, held, data, np.diff(offsets), hashes, np.diff(before) + 1))
                size += len(data)
                if size > CHUNK_BYTES:
                    yield from _chunk_rows(chunk, shards, shared.value, rows)
                    chunk, rows, size = chunk + 1, [], 0
        if rows:
            yield from _chunk_rows(chunk, shards, shared.value, rows)

    return documents.select("doc_id", "held", "text").mapInArrow(run, STAGED)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corpus counts of the words of every chunk, for one or more shards; what the shard adds to
    the training tokens and to the distinct ones comes with its first chunk."""
    by_shard: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for chunk, shard, known, counts in zip(*(c.to_pylist() for c in batch.columns)):
            row = chunk, np.frombuffer(known, np.uint64), _from_planes(counts, "<i8")
            by_shard.setdefault(shard, []).append(row)
    for shard, rows in by_shard.items():
        every, back = np.unique(np.concatenate([r[1] for r in rows]), return_inverse=True)
        total = np.bincount(back, np.concatenate([r[2] for r in rows]), len(every)).astype("<i8")
        at = 0
        for i, (chunk, known, _) in enumerate(rows):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([chunk], pa.int64()),
                    pa.array([shard], pa.int32()),
                    pa.array([_planes(total[back[at : at + len(known)]])], pa.binary()),
                    pa.array([0 if i else int(total.sum())], pa.int64()),
                    pa.array([0 if i else int(np.count_nonzero(total))], pa.int64()),
                ],
                names=["chunk", "shard", "totals", "tokens", "distinct"],
            )
            at += len(known)


SCORED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def score(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    training: F.Column | None = None,
    max_contexts: int | None = None,
) -> DataFrame:
    """SCORED of each row of ``df``: log10 probabilities of its whole text.

    Learns from the rows where ``training`` holds (by default, those not :func:`held_out`).  NULL and
    empty texts are the end alone.  Without training rows every word is unknown and every byte
    equally likely.  Repeated rows are scored and counted each; other columns are not
    read; an empty table gives no rows.  With ``max_contexts`` only so many contexts of each order, the
    most frequent ones, have nodes, and rarer ones are read by their longest suffix that has one.
    """
    spark = df.sparkSession
    held = held_out(id_col) if training is None else ~F.coalesce(training, F.lit(False))
    documents = df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        held.alias("held"),
        empty_if_null(F.col(f"`{text_col}`")).alias("text"),
    )
    symbols = stage(symbol_counts(documents.where(~F.col("held"))))
    short = _short(symbols, max_contexts)
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bins = _bins(symbols, shards)
    staged = stage(_chunks(documents, shards, bins))
    answers = stage(
        staged.where("words IS NOT NULL")
        .select("chunk", "shard", "words", "counts")
        .repartitionById(shards, "shard")
        .mapInArrow(
            _answers, "chunk bigint, shard int, totals binary, tokens bigint, distinct bigint"
        )
    )
    sums = answers.agg(F.sum("tokens").alias("n"), F.sum("distinct").alias("v")).first()
    lengths = _lengths(symbols, staged, short, bins)
    n, v = int(sums["n"] or 0), int(sums["v"] or 0)

    def finish(key, chunks: pd.DataFrame, totals: pd.DataFrame) -> pd.DataFrame:
        row = chunks.iloc[0]
        totals = totals.sort_values("shard")
        held_parts = totals["totals"].dropna()
        counts = np.concatenate([_from_planes(t, "<i8") for t in held_parts])
        found = counts[_from_planes(row["places"], "<u4")]
        per_doc = np.frombuffer(row["before"], "<i8")
        at = np.concatenate([[0], np.cumsum(per_doc)[:-1]])
        base = np.add.reduceat(np.log10(found + 1.0), at) - per_doc * np.log10(n + v + 1.0)
        sizes = np.frombuffer(row["sizes"], "<i8")
        slices = list(_slices(np.frombuffer(_unpressed(row["text"]), np.uint8), np.concatenate([[0], np.cumsum(sizes)])))
        keys, by_bin, _ = _dealt([k for k, _, _ in slices], bins)
        logs = np.empty(len(keys))
        logs[by_bin] = np.concatenate([_from_planes(t, "<f4") for t in totals["logs"].dropna()])
        scores = [
            np.add.reduceat(logs[np.searchsorted(keys, known)][place], starts[:-1])
            for known, place, starts in slices
        ]
        return pd.DataFrame(
            {
                "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"),
                "held_out": row["held"],
                "n_tokens": per_doc,
                "n_known": np.add.reduceat((found > 0).astype(np.int64), at),
                "train_tokens": n,
                "base_score": base,
                "score": np.concatenate(scores),
            }
        )

    both = answers.select("chunk", "shard", "totals").unionByName(lengths, allowMissingColumns=True)
    chunks = staged.where("doc_ids IS NOT NULL").select("chunk", "doc_ids", "held", "text", "sizes", "before", "places")
    return (
        chunks.groupBy("chunk")
        .cogroup(both.groupBy("chunk"))
        .applyInPandas(finish, SCORED)
    )
