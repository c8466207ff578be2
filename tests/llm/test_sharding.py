"""Best-fit-decreasing sharding against a plain packer, group by group."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tidemark.llm import sharding


def plain_best_fit(sizes, capacity):
    """Loads of the bins, every group by itself, by a scan of all bins."""
    bins = []
    for size in sorted(sizes, reverse=True):
        fitting = [i for i, load in enumerate(bins) if max(capacity, 0) - load >= size]
        if fitting:
            bins[max(fitting, key=lambda i: bins[i])] += size
        else:
            bins.append(size)
    return bins


def loads(cuts):
    held = Counter()
    for size, start, stop, first, per_bin in cuts:
        for rank in range(start, stop):
            held[first + (rank - start) // per_bin] += size
    return held


def classes(sizes):
    counted = sorted(Counter(sizes).items(), reverse=True)
    return [s for s, _ in counted], [n for _, n in counted]


@pytest.mark.parametrize("seed", range(60))
def test_cuts_are_those_of_single_groups(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 5, 8, 13, 40, rng.randint(1, 60)]) for _ in range(rng.randint(1, 300))]
    capacity = rng.randint(20, 200)
    cuts, used = sharding.best_fit_decreasing(*classes(sizes), capacity)
    held = loads(cuts)
    assert sorted(held.values()) == sorted(plain_best_fit(sizes, capacity)) and used == len(held)
    placed = defaultdict(list)
    for size, start, stop, _, _ in cuts:
        placed[size].extend(range(start, stop))
    assert {s: sorted(r) for s, r in placed.items()} == {s: list(range(n)) for s, n in Counter(sizes).items()}


@pytest.mark.parametrize("seed", range(30))
def test_tree_stays_ordered_and_flat(seed):
    rng, tree, held = random.Random(seed), sharding.BalancedTree(), []
    for i in range(600):
        if rng.random() < 0.6:
            key = rng.randint(1, 50)
            tree.insert(key, i, 1)
            held.append((key, i))
        else:
            size = rng.randint(1, 55)
            expected = min((k for k in held if k[0] >= size), default=None)
            found = tree.take_tightest(size)
            assert (found and found[:2]) == expected
            if expected:
                held.remove(expected)

    def depth(node):
        return 0 if node is None else 1 + max(depth(node.left), depth(node.right))

    assert depth(tree.root) <= 2 * len(held).bit_length() + 1


@pytest.mark.parametrize("seed", range(30))
def test_balanced_bins_are_near_equal(seed):
    rng = random.Random(seed)
    sizes = [int(rng.paretovariate(1.1) * 40) for _ in range(2000)] + [1] * 500
    held = loads(sharding.balanced_bins(*classes(sizes), 8))
    assert sum(held.values()) == sum(sizes) and len(held) == 8
    rest, total, bins = sorted(sizes, reverse=True), sum(sizes), 8
    while bins > 1 and rest[0] * bins >= total:
        total, bins, rest = total - rest[0], bins - 1, rest[1:]
    fair = sorted(held.values())[:bins]
    assert max(fair) <= 1.001 * total / bins + 1


def test_balanced_bins_with_few_groups():
    assert loads(sharding.balanced_bins([5], [1], 8)) == {0: 5}
    assert sorted(loads(sharding.balanced_bins([5], [3], 8)).values()) == [5, 5, 5]
    assert sharding.balanced_bins([], [], 8) == []
    assert sorted(loads(sharding.balanced_bins([9, 2], [1, 7], 3)).values()) == [6, 8, 9]
    assert sorted(loads(sharding.balanced_bins([7], [9], 1)).values()) == [63]


ROWS = [
    (1, "a" * 50),
    (2, "a" * 50),
    (3, None),
    (4, ""),
    (5, "é" * 10),
    (5, "é" * 10),
    (None, "b" * 7),
    (None, None),
    (6, "c" * 100_000),
    *[(i, f"text {i:04d}") for i in range(100, 400)],
]


def placed(df, **options):
    rows = sharding.shard_documents(df, **options).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return rows


def test_shards_of_documents(spark):
    schema = "doc_id long, text string, digest string, n long, bytes long, rank long, shard int, cell string, size int"
    clash = ("d", 1, 2, 3, 4, "c", 5)
    df = spark.createDataFrame([(*r, *clash) for r in ROWS], schema).repartition(5)
    rows = placed(df)
    assert Counter(r.doc_id for r in rows) == Counter(i for i, _ in ROWS)
    texts = {i: t or "" for i, t in ROWS if i is not None}
    for r in rows:
        if r.doc_id is not None:
            data = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    shard = {r.doc_id: r.shard for r in rows}
    assert shard[1] == shard[2] and shard[3] == shard[4] and 0 <= min(shard.values())
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r.size
    big = sizes.pop(shard[6])
    assert big == 100_001 and len(sizes) == 7 and max(sizes.values()) - min(sizes.values()) <= 102
    assert placed(df.where("false")) == []


def test_groups_of_one_size_that_bins_share_are_ranked_once(spark):
    df = spark.createDataFrame([(i, f"{i:09d}") for i in range(5000)], "doc_id long, text string")
    for options in ({"shards": 8}, {"shards": 3}, {"capacity": 777}, {"capacity": 5}):
        rows = placed(df, **options)
        assert len({r.doc_id for r in rows}) == len(rows) == 5000
        counts = Counter(r.shard for r in rows)
        if "shards" in options:
            assert len(counts) == options["shards"] and max(counts.values()) - min(counts.values()) <= 10
        else:
            full = max(options["capacity"] // 10, 1)
            assert len(counts) == -(-5000 // full) and max(counts.values()) == full


def test_capacity(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = placed(documents, capacity=60_000)
    texts = {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
    groups = Counter(texts[r.doc_id] for r in rows)
    sizes = [n * (len(t.encode()) + 1) for t, n in groups.items()]
    assert len({r.shard for r in rows}) == len(plain_best_fit(sizes, 60_000))
    held = Counter()
    for r in rows:
        held[r.shard] += r.size
    assert sorted(held.values()) == sorted(plain_best_fit(sizes, 60_000))
    assert len({(texts[r.doc_id], r.shard) for r in rows}) == len(groups)


def test_shards_of_the_table(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = placed(documents)
    held = Counter()
    for r in rows:
        held[r.shard] += r.size
    assert sorted(held) == list(range(8)) and max(held.values()) <= 1.01 * min(held.values())
