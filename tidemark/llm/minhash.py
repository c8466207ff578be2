"""Near-duplicate detection by min-max hashing.

Under each permutation of the shingles both the least and the greatest value are kept, so
that a signature takes half of the hash evaluations.  Bands hold values of one kind only,
each under another permutation, which makes the values of a band independent.  Documents
that share a band are candidates; links are confirmed on full sets, and components found.

Documents with equal sets are one node.  In a bucket every node is compared with the least
one, which links groups of copies by as many pairs as there are members.  A bucket that
is one component then needs no more pairs, however large it is; the nodes of any other are
compared block by block, so that no link is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.text import (
    LOWER,
    batch_slices,
    empty_if_null,
    mix,
    shingles,
    span_hashes,
    text_bytes,
    words,
)
from tidemark.sinks.staging import stage

#: A pair at similarity 0.8 misses all bands with probability (1 - 0.8 ** 5) ** 50 < 3e-9.
PERMUTATIONS = 125
ROWS = 5
#: Links of one node that are confirmed in one part.
PART = 512
#: Shingles, and members, in a block of a bucket that is compared pair by pair.
BLOCK = 500_000
MEMBERS = 4_000
#: Members of a block that meet those of another at once.
STRIP = 1_024
#: Shared values whose part of the 0-1 matrix is held at once.
COLUMNS = 1_024

_RANDOM = np.random.default_rng(1010)
_SHIFT = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None] * np.uint64(2)
_FACTOR = _RANDOM.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct hashes of each text's k-word shingles, A-Z folded."""
    data, offsets = text_bytes(texts)
    data = LOWER[data]
    starts, ends, before = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    for i in range(len(before) - 1):
        yield np.unique(shingles(hashes[before[i] : before[i + 1]], k))


def signature(found: np.ndarray) -> np.ndarray:
    """Least values under all permutations and then the greatest."""
    least = np.full(PERMUTATIONS, np.iinfo(np.uint64).max, np.uint64)
    most = np.zeros(PERMUTATIONS, np.uint64)
    for start in range(0, len(found), 2048):
        values = (found[start : start + 2048] ^ _SHIFT) * _FACTOR
        np.minimum(least, values.min(axis=1), out=least)
        np.maximum(most, values.max(axis=1), out=most)
    return np.concatenate([least, most])


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of ROWS values, different for each band."""
    bands = values.reshape(-1, ROWS)
    keys = np.arange(len(bands), dtype=np.uint64)
    for j in range(ROWS):
        keys = mix(keys + bands[:, j])
    return keys.view(np.int64)


SIGNED = "doc_id bigint, text_hash bigint, n_shingles bigint, node bigint, keys array<bigint>"


def _signed(df: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """SIGNED of every document; only the first document of a task with a set has its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in batch_slices(batch, "text"):
                sizes, nodes, keys = [], [], []
                for found in shingle_sets(part.column("text"), k):
                    sizes.append(len(found))
                    if not len(found):
                        nodes.append(None)
                        keys.append(None)
                        continue
                    digest = hashlib.blake2b(found.tobytes(), digest_size=8).digest()
                    node = int.from_bytes(digest, "little", signed=True)
                    nodes.append(node)
                    keys.append(None if node in seen else band_keys(signature(found)))
                    seen.add(node)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:2],
                        pa.array(sizes, pa.int64()),
                        pa.array(nodes, pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "n_shingles", "node", "keys"],
                )

    return _identified(df, id_col, text_col).mapInArrow(run, SIGNED)


def _identified(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = empty_if_null(F.col(f"`{text_col}`"))
    return df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        text.alias("text"),
    )


def _packed(found: np.ndarray) -> bytes:
    return found.tobytes()


def _unpacked(held: bytes) -> np.ndarray:
    return np.frombuffer(held, np.uint64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of sorted distinct values."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * common >= percent * (len(both) - common)


def _sets(wanted: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """``node, held`` for the nodes of ``wanted`` (node, doc_id, text_hash): their packed sets.

    A task gives the set of a node once, however many rows repeat its id and text.  The join is
    by sorting at any size, as what is wanted grows with the documents.
    """
    texts = documents.join(
        wanted.hint("merge"),
        documents["doc_id"].eqNullSafe(wanted["doc_id"])
        & (documents["text_hash"] == wanted["text_hash"]),
    ).select("node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in batch_slices(batch, "text"):
                nodes = part.column("node").to_pylist()
                new = {}
                for node, found in zip(nodes, shingle_sets(part.column("text"), k)):
                    if node not in seen:
                        new[node] = _packed(found)
                        seen.add(node)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(new), pa.int64()), pa.array(list(new.values()), pa.binary())],
                    names=["node", "held"],
                )

    return texts.mapInArrow(run, "node bigint, held binary")


def _link_batch(links: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["a", "b"]
    )


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar.

    The set of ``b`` goes to a part of its partner ``a``, whose set comes first in each part,
    and is compared in passing.
    """
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    members = pairs.join(parts, "a").select(
        "a", F.col("b").alias("node"), F.expr("pmod(hash(b), parts)").alias("part")
    )
    firsts = parts.select(
        "a", F.col("a").alias("node"), F.explode(F.expr("sequence(0, parts - 1)")).alias("part")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, first = None, np.zeros(0, np.uint64)
        for batch in batches:
            links = []
            for a, node, held in zip(*(c.to_pylist() for c in batch.columns)):
                if a == node:
                    current, first = a, _unpacked(held)
                elif a == current and similar(first, _unpacked(held), percent):
                    links.append((a, node))
            yield _link_batch(links)

    return (
        members.unionByName(firsts)
        .join(sets.hint("merge"), "node")
        .repartition(_partitions(pairs), "a", "part")
        .sortWithinPartitions("a", "part", F.col("node") != F.col("a"))
        .select("a", "node", "held")
        .mapInArrow(compare, "a bigint, b bigint")
    )


def _strips(
    sets: list[np.ndarray], percent: int, rows: int, columns: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Which of the first ``rows`` sets are similar to which sets from place ``columns`` on, STRIP
    rows at a time: the first row's place and a matrix.

    The sizes of all intersections are products of the sets' 0-1 matrix with itself, over
    the values that two sets or more have.
    """
    sizes = np.array([len(s) for s in sets])
    row = np.repeat(np.arange(len(sets)), sizes)
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for top in range(0, rows, STRIP):
        end = min(top + STRIP, rows)
        common = np.zeros((end - top, len(sets) - columns), np.float32)
        for start in range(0, int(shared.sum()), COLUMNS):
            a, b = np.searchsorted(column, [start, start + COLUMNS])
            matrix = np.zeros((len(sets), min(COLUMNS, int(shared.sum()) - start)), np.float32)
            matrix[row[a:b], column[a:b] - start] = 1
            common += matrix[top:end] @ matrix[columns:].T
        union = sizes[top:end, None] + sizes[None, columns:] - common
        yield top, 100 * common >= percent * union


def forest_of_blocks(
    sets: list[np.ndarray], labels: np.ndarray, percent: int, first: int | None = None
) -> list[tuple[int, int]]:
    """Places of similar pairs that join whatever all similar pairs and equal labels join, fewer
    than there are sets: of one block, or between its ``first`` sets and the others."""
    root = np.unique(labels, return_inverse=True)[1]
    rows, columns = (len(sets), 0) if first is None else (first, first)
    found = []
    for top, linked in _strips(sets, percent, rows, columns):
        for x, own in enumerate(linked, top):
            y = np.flatnonzero(own) + columns
            y = y[root[y] != root[x]]
            if len(y):
                others, at = np.unique(root[y], return_index=True)
                found += [(x, z) for z in y[at].tolist()]
                root[np.isin(root, others)] = root[x]
    return found


def _settled(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between nodes that share a bucket and are in different components so far.

    A bucket is cut into blocks of about BLOCK shingles and MEMBERS nodes at most by a hash of the
    node; every two blocks meet in one group, which gives a spanning forest of its links.
    """
    labelled = (
        members.join(labels, "node", "left")
        .select("key", "node", F.coalesce("label", "node").alias("label"))
        .distinct()
    )
    sizes = sets.select("node", (F.octet_length("held") / 8).alias("size"))
    mixed = (
        labelled.join(sizes, "node")
        .groupBy("key")
        .agg(
            F.min("label").alias("a"),
            F.max("label").alias("z"),
            F.greatest(F.sum("size") / BLOCK, F.count("*") / MEMBERS).alias("n"),
        )
        .where("a < z")
        .select("key", F.ceil("n").cast("int").alias("blocks"))
    )
    live = stage(labelled.join(mixed, "key").withColumn("block", F.expr("pmod(hash(node), blocks)")))
    met = live.select(
        "key",
        "node",
        "label",
        "block",
        F.explode(
            F.expr(
                "transform(sequence(0, blocks - 1), x -> struct(least(x, block) AS i, greatest(x, block) AS j))"
            )
        ).alias("at"),
    ).select("key", "at.i", "at.j", (F.col("block") != F.col("at.i")).alias("second"), "node", "label")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def links():
            first = sum(not second for second, _, _, _ in held) if held and group[1] < group[2] else None
            if len({label for _, _, label, _ in held}) < 2 or first in (0, len(held)):
                return []
            found = forest_of_blocks(
                [_unpacked(s) for *_, s in held], np.array([x for _, _, x, _ in held]), percent, first
            )
            return [(held[x][1], held[y][1]) for x, y in found]

        for batch in batches:
            found = []
            for key, i, j, second, node, label, packed in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, i, j) != group:
                    found += links()
                    group, held = (key, i, j), []
                held.append((second, node, label, packed))
            yield _link_batch(found)
        yield _link_batch(links())

    return (
        met.join(sets.hint("merge"), "node")
        .select("key", "i", "j", "second", "node", "label", "held")
        .repartition(_partitions(members), "key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "second")
        .mapInArrow(compare, "a bigint, b bigint")
        .distinct()
    )


def drop_near_duplicates(
    df: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``df`` that :func:`near_duplicates` keeps, with all columns.

    One document of each group stays, that with the least id; rows that repeat an id and a text
    count as one document.
    """
    found = near_duplicates(df, k, percent, id_col, text_col)
    kept = stage(found.where("kept").selectExpr("doc_id AS __id", "text_hash AS __hash").distinct())
    text_hash = F.xxhash64(empty_if_null(df[f"`{text_col}`"]))
    same_id = df[f"`{id_col}`"].cast("bigint").eqNullSafe(kept["__id"])
    same = same_id & (text_hash == kept["__hash"])
    return df.join(kept, same, "left_semi")


def near_duplicates(
    df: DataFrame,
    k: int = 5,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, text_hash, n_shingles, component_id, kept`` for each row of ``df``.

    Documents are linked if 100 * intersection >= percent * union of their sets of k-word
    shingles (of the whole text if it is shorter); NULL, empty and blank texts have no
    shingles and no links.  ``component_id`` is the least id reachable, NULL if no row has one;
    ``kept`` tells the rows with that id.  Repeated rows are in one component.  An empty table
    gives no rows; other columns are not read.
    """
    signed = stage(_signed(df, k, id_col, text_col))
    documents = _identified(df, id_col, text_col)
    nodes = stage(
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("pick"))
        .select("node", "pick.doc_id", "pick.text_hash")
    )
    bands = signed.where("keys IS NOT NULL").select(F.explode("keys").alias("key"), "node")
    buckets = (
        bands.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    )
    members = stage(bands.join(buckets.select("key", "a"), "key"))
    pairs = stage(members.where("node <> a").select("a", F.col("node").alias("b")).distinct())
    wanted = stage(members.select("node").distinct().join(nodes, "node"))
    sets = stage(_sets(wanted, documents, k))
    links = stage(_confirmed(pairs, sets, percent))
    labels = components(links)
    more = stage(_settled(members, labels, sets, percent))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    least = nodes.join(labels, "node", "left").select(
        "node", "doc_id", F.coalesce("label", "node").alias("label")
    )
    found = least.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    of_node = stage(least.join(found, "label").select("node", "component_id"))
    return (
        signed.select("doc_id", "text_hash", "n_shingles", "node")
        .join(of_node, "node", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("doc_id"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
