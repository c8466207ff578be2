"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Rows with equal texts are a group, which stays together.  Groups sorted by size enter the bin with
the tightest remaining capacity that holds them; a balanced tree finds that bin.  Groups of one size
are alike, so the tree is walked once for all of them, and what is packed is the table of distinct
sizes: of T bytes there are at most sqrt(2 T) of them.  Only sizes that several bins share
need their groups ranked.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.text import empty_if_null
from tidemark.sinks.staging import stage

SHARDS = 8
#: A group with at least this share of all rows is joined by broadcast; there are as many at most.
HOT_GROUPS = 10_000
#: Hex digits of a group's digest that part the groups of one size, when they are ranked.
CELL_DIGITS = 3


@dataclass
class _Node:
    key: tuple[int, int]
    bins: int
    level: int = 1
    left: _Node | None = None
    right: _Node | None = None


def _skew(node: _Node) -> _Node:
    left = node.left
    if left is not None and left.level == node.level:
        node.left, left.right = left.right, node
        return left
    return node


def _split(node: _Node) -> _Node:
    right = node.right
    if right is not None and right.right is not None and right.right.level == node.level:
        node.right, right.left = right.left, node
        right.level += 1
        return right
    return node


@dataclass
class BalancedTree:
    """Runs of bins by ``(remaining, first bin)``: a binary tree balanced by levels, in which a
    left child is one level lower and a right child's right child is lower."""

    root: _Node | None = field(default=None)

    def insert(self, remaining: int, first: int, bins: int) -> None:
        self.root = self._insert(self.root, (remaining, first), bins)

    def _insert(self, node: _Node | None, key: tuple[int, int], bins: int) -> _Node:
        if node is None:
            return _Node(key, bins)
        if key < node.key:
            node.left = self._insert(node.left, key, bins)
        else:
            node.right = self._insert(node.right, key, bins)
        return _split(_skew(node))

    def take_tightest(self, size: int) -> tuple[int, int, int] | None:
        """Remove and return ``remaining, first bin, bins`` of the least remaining >= size."""
        node, best = self.root, None
        while node is not None:
            if node.key[0] >= size:
                best, node = node, node.left
            else:
                node = node.right
        if best is None:
            return None
        found = (*best.key, best.bins)
        self.root = self._remove(self.root, best.key)
        return found

    def _remove(self, node: _Node | None, key: tuple[int, int]) -> _Node | None:
        if node is None:
            return None
        if key < node.key:
            node.left = self._remove(node.left, key)
        elif key > node.key:
            node.right = self._remove(node.right, key)
        elif node.left is None:
            return node.right
        elif node.right is None:
            return node.left
        else:
            heir = node.right
            while heir.left is not None:
                heir = heir.left
            node.key, node.bins = heir.key, heir.bins
            node.right = self._remove(node.right, heir.key)
        return self._rebalance(node)

    @staticmethod
    def _rebalance(node: _Node) -> _Node:
        level = min(node.left.level if node.left else 0, node.right.level if node.right else 0) + 1
        if level < node.level:
            node.level = level
            if node.right is not None and node.right.level > level:
                node.right.level = level
        node = _skew(node)
        if node.right is not None:
            node.right = _skew(node.right)
            if node.right.right is not None:
                node.right.right = _skew(node.right.right)
        node = _split(node)
        if node.right is not None:
            node.right = _split(node.right)
        return node


#: Groups ``start .. stop - 1`` of a size lie in bins from ``bin`` on, ``per_bin`` in each.
Cut = tuple[int, int, int, int, int]  # size, start, stop, bin, per_bin


def best_fit_decreasing(
    sizes: list[int], counts: list[int], capacity: int, most_bins: int | None = None
) -> tuple[list[Cut], int] | None:
    """Cuts and number of bins for ``counts`` groups of each of the falling ``sizes``.

    A group larger than ``capacity`` has a bin of its own.  None if more than ``most_bins`` would
    be needed.
    """
    tree, used, cuts = BalancedTree(), 0, []
    for size, count in zip(sizes, counts):
        placed = 0
        while placed < count:
            left = count - placed
            found = tree.take_tightest(size)
            if found is None:  # open as many bins as the groups that are left can fill
                per_bin = max(capacity // size, 1)
                found = max(capacity, size), used, -(-left // per_bin)
                used += found[2]
                if most_bins is not None and used > most_bins:
                    return None
            remaining, first, bins = found
            per_bin = remaining // size
            full = min(bins, left // per_bin)
            if full:
                cuts.append((size, placed, placed + full * per_bin, first, per_bin))
                placed += full * per_bin
                if remaining > per_bin * size:
                    tree.insert(remaining - per_bin * size, first, full)
            rest = count - placed
            if full < bins and rest:  # fewer than fill a bin
                cuts.append((size, placed, count, first + full, rest))
                placed = count
                if remaining > rest * size:
                    tree.insert(remaining - rest * size, first + full, 1)
                full += 1
            if full < bins:
                tree.insert(remaining, first + full, bins - full)
    return cuts, used


def balanced_bins(sizes: list[int], counts: list[int], bins: int) -> list[Cut]:
    """Cuts into ``bins`` bins with sizes near equal.

    A group as large as an even share of what is left has a bin of its own.  The rest is packed
    by best fit with the least capacity, found by bisection, at which the bins suffice.
    """
    sizes, counts = list(sizes), list(counts)
    total = sum(s * n for s, n in zip(sizes, counts))
    cuts: list[Cut] = []
    taken = own = 0  # bins with one group, and groups of the first size that have one
    while taken < bins - 1 and sizes and sizes[0] * (bins - taken) >= total:
        cuts.append((sizes[0], own, own + 1, taken, 1))
        total -= sizes[0]
        taken, own, counts[0] = taken + 1, own + 1, counts[0] - 1
        if not counts[0]:
            sizes, counts, own = sizes[1:], counts[1:], 0
    if not sizes:
        return cuts
    low = max(-(-total // (bins - taken)), sizes[0])
    step, high = 1, low
    while (packed := best_fit_decreasing(sizes, counts, high, bins - taken)) is None:
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        middle = (low + high) // 2
        tried = best_fit_decreasing(sizes, counts, middle, bins - taken)
        if tried is None:
            low = middle + 1
        else:
            packed, high = tried, middle
    for size, start, stop, first, per_bin in packed[0]:
        before = own if size == sizes[0] else 0
        cuts.append((size, start + before, stop + before, first + taken, per_bin))
    return cuts


CUTS = "bytes bigint, start bigint, stop bigint, bin bigint, per_bin bigint, whole boolean"


def _packed(sizes: DataFrame, shards: int | None, capacity: int | None) -> DataFrame:
    """The cuts of ``bytes, n``; ``whole`` marks sizes whose groups all lie in one bin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by([("bytes", "descending")])
        bytes_, counts = table.column("bytes").to_pylist(), table.column("n").to_pylist()
        if capacity is not None:
            cuts, _ = best_fit_decreasing(bytes_, counts, capacity)
        else:
            cuts = balanced_bins(bytes_, counts, shards)
        groups = dict(zip(bytes_, counts))
        for at in range(0, len(cuts), 100_000):
            rows = [(*c, c[1] == 0 and c[2] == c[4] == groups[c[0]]) for c in cuts[at : at + 100_000]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in zip(*rows)], names=["bytes", "start", "stop", "bin", "per_bin", "whole"]
            )

    return sizes.repartition(1).mapInArrow(_not_empty(run), CUTS)


def _not_empty(run):
    def guarded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield from run(iter(held))

    return guarded


def _ranked(groups: DataFrame, cuts: DataFrame) -> DataFrame:
    """``groups`` with their rank among those of their size, 0 where the size lies in one bin.

    Groups of one size are counted in cells by the first digits of their digests, and ranked inside
    their cell, so that no window holds all of a size.
    """
    shared = cuts.where("NOT whole").select("bytes").distinct()
    alone = groups.join(shared, "bytes", "left_anti").withColumn("rank", F.lit(0).cast("bigint"))
    parted = groups.join(shared, "bytes", "left_semi")
    parted = parted.withColumn("cell", F.substring("digest", 1, CELL_DIGITS))
    earlier = Window.partitionBy("bytes").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = parted.groupBy("bytes", "cell").agg(F.count("*").alias("n"))
    cells = cells.select("bytes", "cell", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("bytes", "cell").orderBy("digest"))
    ranked = parted.withColumn("inside", inside).join(cells, ["bytes", "cell"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("inside") - 1)
    return alone.unionByName(ranked.select(*alone.columns))


SLOTTED = "doc_id bigint, size bigint, text_crc32 bigint, shard bigint, part bigint, nth bigint"


def _slots(placed: DataFrame) -> DataFrame:
    """Rows with a gapless ``slot`` in their shard: counted inside each task first, then moved on by
    what earlier tasks hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = TaskContext.get().partitionId(), {}
        for batch in batches:
            shard = batch.column("shard").to_numpy()
            nth = np.empty(len(shard), np.int64)
            order = np.argsort(shard, kind="stable")
            found, first, counts = np.unique(shard[order], return_index=True, return_counts=True)
            for s, at, n in zip(found.tolist(), first, counts):
                start = held.get(s, 0)
                nth[order[at : at + n]] = np.arange(start, start + n)
                held[s] = start + n
            columns = [*batch.columns, pa.array(np.full(len(shard), part, np.int64)), pa.array(nth)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "nth"])

    counted = stage(placed.mapInArrow(run, SLOTTED))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    held = counted.groupBy("shard", "part").agg(F.count("*").alias("n"))
    held = held.select("shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return counted.join(held, ["shard", "part"]).withColumn("slot", F.col("before") + F.col("nth"))


def shard_documents(
    df: DataFrame,
    shards: int = SHARDS,
    capacity: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of each row of ``df``.

    ``size`` is the text's UTF-8 bytes and one more.  Rows with equal texts lie in one shard.  Without
    ``capacity`` there are at most ``shards`` shards, their sizes as near equal as best fit makes them,
    but for groups larger than an even share.  With it, shards hold at most ``capacity`` bytes and
    best fit keeps their number low; a larger group is a shard of its own.

    A NULL text is an empty one.  Very long texts are groups like others.  Groups of equal size are dealt
    by their digests, and slots follow no order but have no gaps.  Repeated rows and NULL or
    repeated ids are rows of their own.  Other columns are not read; an empty table gives no rows.
    """
    text = empty_if_null(F.col(f"`{text_col}`"))
    rows = stage(
        df.select(
            F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
            (F.octet_length(text).cast("bigint") + 1).alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.sha2(text, 256).alias("digest"),
        )
    )
    groups = stage(
        rows.groupBy("digest", "size")
        .agg(F.count("*").alias("n"))
        .select("digest", "n", (F.col("n") * F.col("size")).alias("bytes"))
    )
    sizes = groups.groupBy("bytes").agg(F.count("*").alias("n"))
    cuts = stage(_packed(sizes, shards, capacity))
    shard = F.expr("bin + (rank - start) div per_bin").alias("shard")
    inside = F.expr("rank >= start AND rank < stop")
    placed = stage(_ranked(groups, cuts).join(cuts, "bytes").where(inside).select("digest", "n", shard))
    is_hot = F.col("n") * HOT_GROUPS >= rows.count()
    hot = F.broadcast(placed.where(is_hot).select("digest", "shard"))  # HOT_GROUPS rows at most
    cold = placed.where(~is_hot).select("digest", "shard")
    met = rows.join(hot, "digest").unionByName(rows.join(hot, "digest", "left_anti").join(cold, "digest"))
    return _slots(met.select("doc_id", "size", "text_crc32", "shard")).select(
        "doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), "slot"
    )
