"""Exact deduplication by Grace hashing.

Records are partitioned by a hash of their content into spill files, again and again with
other bits of the hash, until a bucket fits an open-addressing table whose entries are
compared by complete content.  The routine runs twice: inside every task over the texts it
has read, so that a task sends one row for each distinct text whatever the number of
copies, and, after a shuffle by content hash, over those representatives.  Rows and
representatives travel apart: a text goes through the shuffle once for each task that has
it, and no task gathers the members of a group.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import re
import tempfile
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.functions.types import free_name
from tidemark.llm.text import empty_if_null
from tidemark.sinks.staging import stage

#: Bytes of content that a bucket's table may hold.
TABLE_BYTES = 64 << 20
FAN_OUT = 16
HASH_BITS = 128
WHITE_SPACE = r"[\x20\x09-\x0D]+"
_SPACES = re.compile(WHITE_SPACE)
NO_ID = (1, 0)


class Record(NamedTuple):
    """A text with the number (or the values) of its best row: the one least in ``order``."""

    content: bytes
    order: tuple
    row: object
    count: int


class Table:
    """An open-addressing table with linear probing; slots hold places in ``records``."""

    def __init__(self, size: int):
        self.slots = [-1] * (1 << max(4, (2 * size).bit_length()))
        self.records: list[Record] = []

    def add(self, h: int, record: Record) -> int:
        """The place of the record's content, which is added if no entry equals it."""
        mask = len(self.slots) - 1
        slot = h & mask
        while (place := self.slots[slot]) >= 0:
            held = self.records[place]
            if held.content == record.content:
                best = min(held, record, key=lambda r: (r.order, r.row))
                self.records[place] = Record(
                    held.content, best.order, best.row, held.count + record.count
                )
                return place
            slot = (slot + 1) & mask
        self.slots[slot] = len(self.records)
        self.records.append(record)
        return len(self.records) - 1


def content_hash(content: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=HASH_BITS // 8).digest(), "little")


def grace(
    records: Iterable[Record], table_bytes: int = TABLE_BYTES, depth: int = 0, size: int | None = None
) -> Iterator[tuple[list[Record], list[tuple[int, int]]]]:
    """Buckets of classes: the merged records of each, and ``(row, place)`` of every record.

    Memory is bounded by ``table_bytes`` and the distinct texts of one bucket.  When the bits
    of the hash are used up, which only copies of one text can bring about, the table takes
    the rest, as copies add no content to it.
    """
    held: list[Record] = []
    seen = 0
    source = iter(records)
    splittable = (depth + 1) * 4 <= HASH_BITS
    for record in source:
        held.append(record)
        seen += len(record.content) + 100
        if seen > table_bytes and splittable:
            break
    else:
        yield _bucket(held)
        return
    with tempfile.TemporaryDirectory(prefix="grace-") as folder:
        files = [open(os.path.join(folder, str(i)), "wb") for i in range(FAN_OUT)]
        try:
            counts, first = [0] * FAN_OUT, [None] * FAN_OUT
            single = [True] * FAN_OUT
            for part in (held, source):
                for record in part:
                    i = (content_hash(record.content) >> (4 * depth)) % FAN_OUT
                    pickle.dump(tuple(record), files[i])
                    counts[i] += 1
                    if first[i] is None:
                        first[i] = record.content
                    elif single[i] and first[i] != record.content:
                        single[i] = False
                held = []
        finally:
            for file in files:
                file.close()
        for i in range(FAN_OUT):
            if counts[i]:
                path = os.path.join(folder, str(i))
                if single[i]:
                    yield _bucket(_spilled(path))
                else:
                    yield from grace(_spilled(path), table_bytes, depth + 1, counts[i])
                os.remove(path)


def _spilled(path: str) -> Iterator[Record]:
    with open(path, "rb") as file:
        while True:
            try:
                yield Record(*pickle.load(file))
            except EOFError:
                return


def _bucket(records: Iterable[Record]) -> tuple[list[Record], list[tuple[int, int]]]:
    table, places = Table(1024), []
    for record in records:
        if 2 * len(table.records) >= len(table.slots):
            table = _grown(table)
        h = content_hash(record.content) >> 64
        places.append((record.row, table.add(h, record)))
    return table.records, places


def _grown(table: Table) -> Table:
    larger = Table(2 * len(table.slots))
    for record in table.records:
        larger.add(content_hash(record.content) >> 64, record)
    return larger


LOCAL = "row bigint, leader bigint, doc_id bigint, sha string, content string, first bigint, n bigint, shard bigint"
LOCAL_ARROW = pa.schema(
    [
        ("row", pa.int64()),
        ("leader", pa.int64()),
        ("doc_id", pa.int64()),
        ("sha", pa.string()),
        ("content", pa.string()),
        ("first", pa.int64()),
        ("n", pa.int64()),
        ("shard", pa.int64()),
    ]
)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each document, and one with content for each distinct text of the task."""
    ids: list[int | None] = []
    rows: list[int] = []

    def records():
        for batch in batches:
            for row, doc_id, content in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                ids.append(doc_id)
                order = NO_ID if doc_id is None else (0, doc_id)
                yield Record(content.encode(), order, len(rows) - 1, 1)

    for classes, members in grace(records()):
        shas = [hashlib.sha256(r.content).hexdigest() for r in classes]
        nulls = [None] * len(members)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[m] for m, _ in members], pa.int64()),
                pa.array([rows[classes[p].row] for _, p in members], pa.int64()),
                pa.array([ids[m] for m, _ in members], pa.int64()),
                pa.array([shas[p] for _, p in members], pa.string()),
                *(pa.array(nulls, f.type) for f in list(LOCAL_ARROW)[4:]),
            ],
            schema=LOCAL_ARROW,
        )
        for start in range(0, len(classes), 256):
            part = classes[start : start + 256]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[r.row] for r in part], pa.int64()),
                    pa.array([rows[r.row] for r in part], pa.int64()),
                    pa.array([ids[r.row] for r in part], pa.int64()),
                    pa.array([None] * len(part), pa.string()),
                    pa.array([r.content.decode() for r in part], pa.string()),
                    pa.array([ids[r.row] for r in part], pa.int64()),
                    pa.array([r.count for r in part], pa.int64()),
                    pa.array([content_hash(r.content) % (1 << 62) for r in part], pa.int64()),
                ],
                schema=LOCAL_ARROW,
            )


GLOBAL = "leader bigint, keep_row bigint, keep_id bigint, group_size bigint"


def _global(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Class of every leader of a hash partition."""

    def records():
        for batch in batches:
            for row, doc_id, content, n in zip(*(c.to_pylist() for c in batch.columns)):
                order = NO_ID if doc_id is None else (0, doc_id)
                yield Record(content.encode(), order, row, n)

    for classes, members in grace(records()):
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([row for row, _ in members], pa.int64()),
                pa.array([classes[p].row for _, p in members], pa.int64()),
                pa.array(
                    [None if (o := classes[p].order) == NO_ID else o[1] for _, p in members],
                    pa.int64(),
                ),
                pa.array([classes[p].count for _, p in members], pa.int64()),
            ],
            names=["leader", "keep_row", "keep_id", "group_size"],
        )


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``df``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after each run of white space becomes one space; a NULL
    text is empty, and empty texts form one group.  The smallest id of a group stays; rows
    with a NULL id stay only if no row of the group has one, and of several rows with the
    same id one stays.  An empty table gives no rows.  Other columns are not read.
    """
    text = F.regexp_replace(empty_if_null(F.col(f"`{text_col}`")), WHITE_SPACE, " ")
    rows = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        text.alias("content"),
    )
    local = stage(rows.mapInArrow(_local, LOCAL))
    leaders = local.where(F.col("content").isNotNull())
    classes = (
        leaders.repartition(_partitions(df), "shard")
        .select("row", "first", "content", "n")
        .mapInArrow(_global, GLOBAL)
    )
    found = (
        local.where(F.col("content").isNull())
        .select("row", "leader", "doc_id", "sha")
        .join(classes, "leader")
    )
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def drop_exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that :func:`exact_duplicates` keeps, with all columns of ``df``.

    Of rows with one id and equal texts, the least by its written-out values stays.  The
    rows travel once, from the tasks that read them to the hash partitions.
    """
    shard, names = free_name(df, "shard"), list(df.columns)
    # names as Spark resolves them, in any case
    exact, lower = {n: i for i, n in enumerate(names)}, {n.lower(): i for i, n in enumerate(names)}
    id_at, text_at = (exact.get(c, lower[c.lower()]) for c in (id_col, text_col))

    def best(batches, schema):
        def records():
            for batch in batches:
                for values in zip(*(c.to_pylist() for c in batch.columns)):
                    values = values[: len(names)]
                    doc_id, text = values[id_at], values[text_at]
                    content = _SPACES.sub(" ", text or "").encode()
                    order = (*(NO_ID if doc_id is None else (0, doc_id)), repr(values))
                    yield Record(content, order, values, 1)

        for classes, _ in grace(records()):
            for start in range(0, len(classes), 256):
                part = classes[start : start + 256]
                columns = list(zip(*(r.row for r in part)))
                if len(schema) > len(names):
                    columns.append([content_hash(r.content) % (1 << 62) for r in part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
                )

    arrow = to_arrow_schema(df.schema)
    with_shard = arrow.append(pa.field(shard, pa.int64()))
    sent = df.mapInArrow(
        lambda batches: best(batches, with_shard), T.StructType([*df.schema, T.StructField(shard, T.LongType())])
    )
    dealt = sent.repartition(_partitions(df), shard)
    return dealt.mapInArrow(lambda batches: best(batches, arrow), df.schema)
