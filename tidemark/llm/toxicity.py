"""Toxicity: cumulative-link ordinal regression.

A document's severity is one of the grades 0, 1, ..., K.  One set of weights over sparse text
features is shared by all grades, and ordered thresholds part them:
P(grade >= k) = logistic(w x - t_k).  The output is the expected grade.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import free_name
from tidemark.llm.features import hashed_words
from tidemark.llm.samples import labelled_sample
from tidemark.llm.text import batch_slices, empty_if_null

#: Labelled documents that the regression is fitted on, at most.
SAMPLE_ROWS = 8192
BUCKETS = 1 << 20
#: Bytes of the stems that count beside whole words, for languages that inflect.
STEMS = (5, 6, 7, 8)
#: Grades above 0; graded from binary labels by how many telling words a text has.
GRADES = 3
#: Training texts that must hold a word for it to have a weight.
MIN_TEXTS = 5
#: Chi-squared statistic (grade 0 against the rest) and share of its texts with higher grades
#: that a word needs to have a weight.
TELLING, PURITY = 30.0, 0.7
STEPS = 1000
SPARSITY = 3e-5
#: Probability of a grade above 0 from which a document counts as toxic.
THRESHOLD = 0.25


@dataclass
class Regression:
    weights: np.ndarray
    thresholds: np.ndarray

    def dumps(self) -> bytes:
        out = io.BytesIO()
        at = np.flatnonzero(self.weights)
        np.savez(out, at=at, weights=self.weights[at], thresholds=self.thresholds)
        return out.getvalue()

    @staticmethod
    def loads(data: bytes) -> Regression:
        held = np.load(io.BytesIO(data))
        weights = np.zeros(BUCKETS)
        weights[held["at"]] = held["weights"]
        return Regression(weights, held["thresholds"])

    def at_least(self, sums: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. K, one row for a text."""
        return 1 / (1 + np.exp(-np.clip(sums[:, None] - self.thresholds, -30, 30)))


def grades_from_labels(rows: list[np.ndarray], toxic: np.ndarray) -> np.ndarray:
    """Grade 0 for label 0; labels of 1 are parted into GRADES equal parts by how many distinct
    words of the text tell toxic texts (by log odds over the training texts)."""
    n = np.zeros((2, BUCKETS))
    for places, y in zip(rows, toxic):
        n[int(y), places] += 1
    size = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
    odds = np.log((n[1] + 0.5) / (size[1] + 1)) - np.log((n[0] + 0.5) / (size[0] + 1))
    telling = (odds > 2) & (n[1] >= MIN_TEXTS)
    found = np.array([telling[p].sum() for p in rows])
    cuts = np.quantile(found[toxic == 1], np.arange(1, GRADES) / GRADES)
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, found, "right"), 0)


def fit(rows: list[np.ndarray], grades: np.ndarray, top: int) -> Regression:
    """Proximal gradient steps (with momentum) on the mean log loss of all thresholds and an
    absolute penalty.  Words that tell nothing have no weight and none is below 0: evidence
    adds up, and long clean passages cannot outweigh it.

    With no rows, or one grade only, the weights are 0 and the thresholds give the smoothed
    shares of the grades.
    """
    n = len(rows)
    shares = np.array([((grades >= k).sum() + 1) / (n + 2) for k in range(1, top + 1)])
    thresholds = np.log((1 - shares) / shares)
    weights = np.zeros(BUCKETS)
    if len(np.unique(grades)) < 2:
        return Regression(weights, np.maximum.accumulate(thresholds))
    texts = np.bincount(np.concatenate(rows), minlength=BUCKETS)
    share = (grades > 0).mean()
    hits = np.bincount(
        np.concatenate([p for p, g in zip(rows, grades) if g > 0]), minlength=BUCKETS
    )
    spread = texts * share * (1 - share) * (1 - texts / (n + 1))
    chi_squared = (hits - texts * share) ** 2 / np.maximum(spread, 1e-9)
    telling = (chi_squared > TELLING) & (hits > PURITY * texts)
    used = np.flatnonzero((texts >= MIN_TEXTS) & telling)
    dense_of = np.full(BUCKETS, -1)
    dense_of[used] = np.arange(len(used))
    columns = [dense_of[p] for p in rows]
    columns = [c[c >= 0] for c in columns]
    row_of = np.repeat(np.arange(n), [len(c) for c in columns])
    flat = np.concatenate(columns).astype(np.int64)
    # a column's own step: inputs are 0 or 1, so its curvature is its share of texts
    step = n / (4 * texts[used] + 20.0) / top
    w, above = np.zeros(len(used)), grades[:, None] >= np.arange(1, top + 1)
    ahead, momentum = w.copy(), 1.0
    for _ in range(STEPS):
        sums = np.bincount(row_of, ahead[flat], minlength=n)
        p = 1 / (1 + np.exp(-np.clip(sums[:, None] - thresholds, -30, 30)))
        error = p - above
        slope = np.bincount(flat, error.sum(axis=1)[row_of], minlength=len(used)) / n
        new = ahead - 0.5 * step * slope
        new = np.maximum(new - 0.5 * step * SPARSITY, 0)
        ahead = new + 0.8 * (new - w)
        w = new
        thresholds = np.sort(thresholds + 1.0 * error.mean(axis=0))
    weights[used] = w
    return Regression(weights, thresholds)


def _distinct(texts: pa.Array) -> list[np.ndarray]:
    """The distinct buckets of each text, a slice of the texts at a time."""
    rows: list[np.ndarray] = []
    for part in batch_slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
        found = hashed_words(part.column(0), BUCKETS, STEMS)
        rows.extend(places.astype(np.int32) for places, _ in found)
    return rows


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes:
    """A regression fitted in one task on at most ``rows`` labelled documents; its weights."""
    sample = labelled_sample(documents, labels, "toxic", rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("text", pa.string()), ("label", pa.float64())]))
        table = table.group_by("text").aggregate([("label", "mean")]).sort_by("text")
        found = _distinct(table.column("text").combine_chunks())
        toxic = (table.column("label_mean").to_numpy() >= 0.5).astype(np.int64)
        grades = grades_from_labels(found, toxic) if toxic.any() else toxic
        fitted = fit(found, grades, GRADES)
        yield pa.RecordBatch.from_arrays([pa.array([fitted.dumps()])], names=["regression"])

    fitted = sample.select("text", "label").repartition(1).mapInArrow(run, "regression binary")
    row = fitted.first()
    if row is None:  # no labelled documents
        return fit([], np.zeros(0, np.int64), GRADES).dumps()
    return bytes(row["regression"])


def _graded(
    df: DataFrame, regression: bytes, text_col: str
) -> tuple[DataFrame, Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[list, np.ndarray]]]]:
    """``df`` with one more column, and what gives its own columns with P(grade >= k), in a task."""
    held = df.sparkSession.sparkContext.broadcast(regression)
    n = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
        model = Regression.loads(held.value)
        for batch in batches:
            for part in batch_slices(batch, n):
                sums = np.array([model.weights[p].sum() for p in _distinct(part.column(n))])
                yield part.columns[:n], model.at_least(sums)

    text = empty_if_null(F.col(f"`{text_col}`")).alias(free_name(df, "whole_text"))
    return df.select("*", text), run


OUTPUTS = ("severity", "toxic_probability", "grade", "predicted")


def score(df: DataFrame, regression: bytes, text_col: str = "text") -> DataFrame:
    """``df`` with severity (the expected grade), toxic_probability (of a grade above 0), grade
    (the likeliest) and predicted (1 if the
    probability is THRESHOLD or more).

    NULL and empty texts have no words and so the thresholds' own grades.  Columns already called
    so are replaced.  Repeated rows are scored each; an empty table stays empty.
    """
    df = df.drop(*OUTPUTS)
    rows, graded = _graded(df, regression, text_col)
    names = [*df.columns, *OUTPUTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, above in graded(batches):
            n = len(above)
            if n:
                each = -np.diff(np.column_stack([np.ones(n), above, np.zeros(n)]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *columns,
                        pa.array(above.sum(axis=1)),
                        pa.array(above[:, 0]),
                        pa.array(each.argmax(axis=1).astype(np.int32)),
                        pa.array((above[:, 0] >= THRESHOLD).astype(np.int32)),
                    ],
                    names=names,
                )

    kinds = [T.DoubleType(), T.DoubleType(), T.IntegerType(), T.IntegerType()]
    schema = T.StructType([*df.schema, *(T.StructField(c, k) for c, k in zip(OUTPUTS, kinds))])
    return rows.mapInArrow(run, schema)


def drop_toxic(
    df: DataFrame, regression: bytes, threshold: float = THRESHOLD, text_col: str = "text"
) -> DataFrame:
    """The rows of ``df`` whose probability of a grade above 0 is below ``threshold``, with its
    own columns."""
    rows, graded = _graded(df, regression, text_col)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, above in graded(batches):
            kept = pa.RecordBatch.from_arrays(columns, names=names)
            yield kept.filter(pa.array(above[:, 0] < threshold))

    return rows.mapInArrow(run, df.schema)
