"""Hard negatives by the threshold algorithm.

Vectors are quantised to whole numbers.  Rows are dealt into blocks, and every block meets every block
of anchors once.  There each dimension is a list sorted by its values, read from the top where the
anchor's component is positive and from the bottom where it is negative.  Rows met by this sorted
access are scored exactly by random access.  No unseen row can score more than the threshold, the
anchor's product with the last values read, and an anchor is through once the threshold has
fallen strictly below the k-th score of each of its windows.

The first pass finds the best rows of an anchor's own label, its positives.  Each of them opens a window of
scores, between a lower and an upper share of its own, and the second pass finds the best rows of
other labels in every window.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sinks.staging import stage

SCALE = 256
#: Rows in a block, anchors in a block of anchors, and anchors that advance together.
BLOCK_ROWS = 8192
BLOCK_ANCHORS = 8192
TILE = 64
#: Entries of every list read in the first round; each round reads as many as all before.
FIRST_DEPTH = 32
#: Whole numbers up to here are exact in 64-bit floats.
EXACT = 1 << 53

QUANTISED = "vec_id bigint, label bigint, vector array<double>, anchor boolean"


def quantised(
    df: DataFrame, anchors: Column, id_col: str, vector_col: str, label_col: str, scale: int = SCALE
) -> DataFrame:
    """QUANTISED rows that take part: those with an id, a label and a vector of finite numbers."""
    component = F.col("vector")
    bad = F.exists(component, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(component, lambda x: F.floor(x * scale).cast("double"))
    return (
        df.select(
            F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
            F.col(f"`{label_col}`").cast("bigint").alias("label"),
            F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
            F.coalesce(anchors, F.lit(False)).alias("anchor"),
        )
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .where(~F.coalesce(bad, F.lit(False)))
        .withColumn("vector", whole)
    )


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    matrix = np.zeros((len(vectors), width))
    for row, vector in zip(matrix, vectors):
        row[: len(vector)] = vector
    return matrix


class SortedLists:
    """The rows of a block with each dimension as a list of row numbers by rising value."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.order = np.argsort(matrix, axis=0, kind="stable")
        self.values = np.take_along_axis(matrix, self.order, axis=0)

    def scores(self, anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Inner products, exact: by floats where these hold them, else by whole numbers."""
        found = self.matrix[rows]
        most = np.abs(anchors).max(initial=0) * np.abs(found).max(initial=0) * max(found.shape[1], 1)
        if most < EXACT:
            return anchors @ found.T
        whole = [np.array([[int(v) for v in r] for r in m], object) for m in (anchors, found.T)]
        return whole[0].reshape(len(anchors), -1) @ whole[1].reshape(-1, len(rows))


#: Told which scores are seen, and the threshold of each anchor, says which anchors are through.
Through = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]


def threshold_search(
    lists: SortedLists, anchors: np.ndarray, through: Through
) -> tuple[np.ndarray, np.ndarray, int]:
    """Scores of the rows that were met (anchors x rows), which ones were, and accesses made.

    ``through(at, scores, seen, threshold)`` judges the anchors ``at``; anchors that it does not stop
    go on until their lists end.
    """
    n, dimensions = lists.matrix.shape
    exact = np.abs(anchors).max(initial=0) * np.abs(lists.matrix).max(initial=0) * max(dimensions, 1) < EXACT
    scores = np.zeros((len(anchors), n), float if exact else object)
    seen = np.zeros((len(anchors), n), bool)
    at, depth, accesses = np.arange(len(anchors)), 0, 0
    while len(at) and depth < n:
        until = min(max(2 * depth, FIRST_DEPTH), n)
        new = np.zeros((len(at), n), bool)
        top, bottom = lists.order[n - until : n - depth], lists.order[depth:until]
        for i, anchor in enumerate(anchors[at]):
            new[i, top[:, anchor > 0].ravel()] = True
            new[i, bottom[:, anchor < 0].ravel()] = True
            accesses += (until - depth) * int(np.count_nonzero(anchor))
        zero = ~anchors[at].any(axis=1)
        new[zero] = True  # all scores are 0
        new &= ~seen[at]
        rows = np.flatnonzero(new.any(axis=0))
        met = lists.scores(anchors[at], rows)
        held = scores[np.ix_(at, rows)]
        scores[np.ix_(at, rows)] = np.where(new[:, rows], met, held)
        seen[at] |= new
        depth = until
        last_high, last_low = lists.values[n - depth], lists.values[depth - 1]
        last = np.where(anchors[at] > 0, last_high, last_low)
        if exact:
            threshold = (anchors[at] * last).sum(axis=1)
        else:
            threshold = np.array([sum(int(q) * int(v) for q, v in zip(*r)) for r in zip(anchors[at], last)], object)
        if depth < n:
            at = at[~through(at, scores, seen, threshold)]
    return scores, seen, accesses


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties by the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return np.lexsort((ids, -scores))[:k]


def _in_cells(rows: DataFrame, anchors: DataFrame, blocks: int, anchor_blocks: int, find, schema: str) -> DataFrame:
    """``find`` on every pair of a block of rows and a block of anchors."""
    by_row = rows.withColumn("block", F.expr(f"pmod(xxhash64(uid), {blocks})"))
    by_row = by_row.withColumn("with_anchors", F.explode(F.expr(f"sequence(0L, {anchor_blocks - 1}L)")))
    # both sides may read one staged table, so one of them gets columns of its own
    by_anchor = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    by_anchor = by_anchor.withColumn("own_block", F.expr(f"pmod(xxhash64(uid), {anchor_blocks})"))
    by_anchor = by_anchor.withColumn("with_rows", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    cells = by_row.groupBy("block", "with_anchors")
    return cells.cogroup(by_anchor.groupBy("with_rows", "own_block")).applyInPandas(find, schema)


def _find_positives(k: int):
    def find(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(anchors):
            width = max(rows["vector"].map(len).max(), anchors["vector"].map(len).max())
            lists, wanted = SortedLists(_matrix(rows["vector"], width)), _matrix(anchors["vector"], width)
            ids, uids, labels = (rows[c].to_numpy() for c in ("vec_id", "uid", "label"))
            own_uid, own_id, own_label = (anchors[c].to_numpy() for c in ("uid", "vec_id", "label"))
            for start in range(0, len(anchors), TILE):
                tile = slice(start, start + TILE)
                fits = (labels == own_label[tile, None]) & (uids != own_uid[tile, None])

                def through(at, scores, seen, threshold):
                    above = scores[at] > threshold[:, None]
                    return (above & seen[at] & fits[at]).sum(axis=1) >= k

                scores, seen, _ = threshold_search(lists, wanted[tile], through)
                for i, valid in enumerate(seen & fits):
                    place = np.flatnonzero(valid)
                    for j in place[_best(scores[i, place], ids[place], k)]:
                        found.append((own_uid[start + i], own_id[start + i], ids[j], uids[j], int(scores[i, j])))
        return pd.DataFrame(found, columns=["uid", "anchor_id", "positive_id", "positive_uid", "positive_score"])

    return find


def _find_negatives(k: int):
    def find(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(anchors):
            width = max(rows["vector"].map(len).max(), anchors["vector"].map(len).max())
            lists, wanted = SortedLists(_matrix(rows["vector"], width)), _matrix(anchors["vector"], width)
            ids, labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
            own_uid, own_label = anchors["uid"].to_numpy(), anchors["label"].to_numpy()
            windows = [[(int(w["low"]), int(w["high"])) for w in ws] for ws in anchors["windows"]]
            most = max(map(len, windows))
            nothing = (1, 0)  # no score lies in it
            padded = np.array([ws + [nothing] * (most - len(ws)) for ws in windows], object)
            low, high = padded[:, :, 0], padded[:, :, 1]
            for start in range(0, len(anchors), TILE):
                tile = slice(start, start + TILE)
                other = labels != own_label[tile, None]

                def through(at, scores, seen, threshold):
                    valid = seen[at] & other[at]
                    done = np.ones(len(at), bool)
                    for w in range(most):
                        lo, hi = (x[tile][at, w].astype(scores.dtype)[:, None] for x in (low, high))
                        inside = valid & (scores[at] <= hi) & (scores[at] >= lo) & (scores[at] > threshold[:, None])
                        below = (threshold[:, None] < lo).ravel().astype(bool) | (lo > hi).ravel().astype(bool)
                        done &= below | (inside.sum(axis=1) >= k)
                    return done

                scores, seen, _ = threshold_search(lists, wanted[tile], through)
                for i, valid in enumerate(seen & other):
                    for lo, hi in dict.fromkeys(windows[start + i]):
                        place = np.flatnonzero(valid & (scores[i] >= lo) & (scores[i] <= hi))
                        for j in place[_best(scores[i, place], ids[place], k)]:
                            found.append((own_uid[start + i], lo, hi, ids[j], int(scores[i, j])))
        return pd.DataFrame(found, columns=["uid", "low", "high", "negative_id", "negative_score"])

    return find


def hard_negatives(
    df: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Every row where ``anchors`` holds is an anchor.  Its positives are the ``positives`` best other rows of
    its label.  For each of them the ``negatives`` best rows of other labels follow whose score is between
    ``low_percent`` and ``high_percent`` of the positive's.  Scores are inner products of components
    ``floor(256 * x)``; ties go to the smaller id.

    Rows whose id, label or vector is NULL, or whose vector holds NULL, NaN or an infinity, take no part.
    Of vectors of different length the shorter one counts as padded by zeros; a score beyond 64 bits
    is an error.  Repeated rows and ids are rows of their own: each is an anchor and each a candidate, but
    none its own.  Other columns are not read; an empty table, or one without anchors,
    gives no rows.
    """
    rows = quantised(df, anchors, id_col, vector_col, label_col)
    rows = stage(rows.withColumn("uid", F.monotonically_increasing_id()))
    sizes = rows.agg(F.count("*").alias("rows"), F.count_if("anchor").alias("anchors")).first()
    blocks, anchor_blocks = -(-sizes.rows // BLOCK_ROWS) or 1, -(-sizes.anchors // BLOCK_ANCHORS) or 1
    candidates = rows.select("uid", "vec_id", "label", "vector")
    asked = rows.where("anchor").select("uid", "vec_id", "label", "vector")
    near = _in_cells(
        candidates,
        asked,
        blocks,
        anchor_blocks,
        _find_positives(positives),
        "uid bigint, anchor_id bigint, positive_id bigint, positive_uid bigint, positive_score bigint",
    )
    order = Window.partitionBy("uid").orderBy(F.desc("positive_score"), "positive_id", "positive_uid")
    chosen = stage(near.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= positives))
    # low_percent * positive <= 100 * negative <= high_percent * positive, in whole numbers; a
    # positive below 0 has no such scores
    window = chosen.where("positive_score >= 0").selectExpr(
        "*",
        f"({low_percent} * positive_score + 99) div 100 AS low",
        f"({high_percent} * positive_score) div 100 AS high",
    )
    window = window.where("low <= high")
    listed = window.groupBy("uid").agg(F.collect_list(F.struct("low", "high")).alias("windows"))
    found = _in_cells(
        candidates,
        asked.join(listed, "uid"),
        blocks,
        anchor_blocks,
        _find_negatives(negatives),
        "uid bigint, low bigint, high bigint, negative_id bigint, negative_score bigint",
    )
    order = Window.partitionBy("uid", "low", "high").orderBy(F.desc("negative_score"), "negative_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return window.join(best, ["uid", "low", "high"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
