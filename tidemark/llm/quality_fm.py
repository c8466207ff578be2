"""Quality classifier: a factorisation machine.

The inputs are hashed words, structure statistics of the text and its length by the
metadata.  All pairs of inputs interact through low-rank factors, and the sum over pairs
is taken in linear time: half of (the square of the sum less the sum of the squares).
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
from tidemark.llm.features import STRUCTURE, hashed_words, structure
from tidemark.llm.samples import labelled_sample
from tidemark.llm.text import batch_slices, empty_if_null

#: Labelled documents that the machine is fitted on, at most.
SAMPLE_ROWS = 8192
BUCKETS = 1 << 16
RANK = 8
THRESHOLD = 0.3
EPOCHS = 8
BATCH = 64
WORD_DECAY = 2e-3


@dataclass
class Machine:
    """Weights of ``BUCKETS`` words and then the dense inputs; means and scales of those."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, linear=self.linear, factors=self.factors, mean=self.mean, scale=self.scale)
        return out.getvalue()

    @staticmethod
    def loads(data: bytes) -> Machine:
        held = np.load(io.BytesIO(data))
        return Machine(float(held["bias"]), *(held[k] for k in ("linear", "factors", "mean", "scale")))

    def inputs(self, place: np.ndarray, count: np.ndarray, dense: np.ndarray):
        """Places and values of one text's inputs: words scaled to length 1, then the rest."""
        size = np.sqrt(np.sum(count.astype(float) ** 2)) or 1.0
        values = np.clip((dense - self.mean) / self.scale, -4, 4)
        return (
            np.concatenate([place, BUCKETS + np.arange(len(dense))]),
            np.concatenate([count / size, values]),
        )

    def raw(self, place: np.ndarray, value: np.ndarray) -> tuple[float, np.ndarray]:
        """The score before the logistic function, and the factors' sums."""
        v = self.factors[place] * value[:, None]
        sums = v.sum(axis=0)
        pairs = 0.5 * float(sums @ sums - np.einsum("ij,ij->", v, v))
        return self.bias + float(self.linear[place] @ value) + pairs, sums


def _dense(texts: pa.Array, distinct: np.ndarray, stated: np.ndarray) -> np.ndarray:
    return np.column_stack([structure(texts, distinct), np.log1p(np.maximum(stated, 0))])


def fit(texts: pa.Array, stated: np.ndarray, labels: np.ndarray, seed: int = 6) -> Machine:
    """A machine fitted by stochastic gradients (AdaGrad) on the distinct texts.

    With no labelled rows, or labels of one kind, it scores the smoothed share of ones.
    """
    found, dense_parts = [], [np.zeros((0, len(STRUCTURE) + 1))]
    for part in batch_slices(pa.RecordBatch.from_arrays([texts], names=["text"]), 0):
        own = list(hashed_words(part.column(0), BUCKETS))
        at = slice(len(found), len(found) + len(own))
        dense_parts.append(_dense(part.column(0), np.array([len(p) for p, _ in own]), stated[at]))
        found += own
    dense = np.concatenate(dense_parts)
    mean = dense.mean(axis=0) if len(dense) else np.zeros(len(STRUCTURE) + 1)
    scale = dense.std(axis=0) if len(dense) else np.ones(len(STRUCTURE) + 1)
    size = BUCKETS + len(mean)
    rng = np.random.default_rng(seed)
    share = (labels.sum() + 1) / (len(labels) + 2)
    machine = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(size),
        rng.normal(0, 0.05, (size, RANK)),
        mean,
        np.maximum(scale, 1e-3),
    )
    if len(np.unique(labels)) < 2:
        machine.factors[:] = 0
        return machine
    rows = [machine.inputs(p, c, d) for (p, c), d in zip(found, dense)]
    squares, squares_v = np.full(size, 1e-3), np.full((size, RANK), 1e-3)
    decay = np.full(size, WORD_DECAY)
    decay[BUCKETS:] = 1e-4
    for epoch in range(EPOCHS):
        rate = 0.1 / (1 + epoch)
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            batch = order[start : start + BATCH]
            places, slopes, slopes_v = [], [], []
            for i in batch:
                place, value = rows[i]
                raw, sums = machine.raw(place, value)
                error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[i]
                machine.bias -= 0.1 * rate * error / len(batch)
                v = machine.factors[place]
                places.append(place)
                slopes.append(error * value)
                slopes_v.append(error * value[:, None] * (sums - v * value[:, None]))
            at, back = np.unique(np.concatenate(places), return_inverse=True)
            g = np.bincount(back, np.concatenate(slopes)) / len(batch)
            v_slopes = np.concatenate(slopes_v)
            g_v = np.column_stack([np.bincount(back, v_slopes[:, k]) for k in range(RANK)]) / len(batch)
            g += decay[at] * machine.linear[at]
            g_v += decay[at][:, None] * machine.factors[at]
            squares[at] += g**2
            squares_v[at] += g_v**2
            machine.linear[at] -= rate * g / np.sqrt(squares[at])
            machine.factors[at] -= rate * g_v / np.sqrt(squares_v[at])
    return machine


def train(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> bytes:
    """A machine fitted in one task on at most ``rows`` labelled documents; its weights."""
    sample = labelled_sample(documents, labels, "quality", rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("text", pa.string()), ("label", pa.float64())]))
        table = table.group_by("text").aggregate([("label", "mean")]).sort_by("text")
        texts = table.column("text").combine_chunks()
        stated = np.array([len(t) for t in texts.to_pylist()])
        machine = fit(texts, stated, table.column("label_mean").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array([machine.dumps()])], names=["machine"])

    fitted = sample.select("text", "label").repartition(1).mapInArrow(run, "machine binary")
    row = fitted.first()
    if row is None:  # no labelled documents
        return fit(pa.array([], pa.string()), np.zeros(0), np.zeros(0)).dumps()
    return bytes(row["machine"])


def _scored(
    df: DataFrame, machine: bytes, text_col: str, stated_col: str | None
) -> tuple[DataFrame, Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[list, np.ndarray]]]]:
    """``df`` with two more columns, and what gives its own columns with scores, in a task."""
    held = df.sparkSession.sparkContext.broadcast(machine)
    text = empty_if_null(F.col(f"`{text_col}`"))
    stated = F.length(text)
    if stated_col:
        stated = F.coalesce(F.col(f"`{stated_col}`").cast("int"), stated)
    n = len(df.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray]]:
        model = Machine.loads(held.value)
        for batch in batches:
            for part in batch_slices(batch, n + 1):
                texts = part.column(n + 1)
                found = list(hashed_words(texts, BUCKETS))
                distinct = np.array([len(p) for p, _ in found])
                dense = _dense(texts, distinct, part.column(n).to_numpy())
                raw = [model.raw(*model.inputs(p, c, d))[0] for (p, c), d in zip(found, dense)]
                yield part.columns[:n], 1 / (1 + np.exp(-np.clip(np.array(raw), -30, 30)))

    added = stated.alias(free_name(df, "stated")), text.alias(free_name(df, "whole_text"))
    return df.select("*", *added), run


def score(
    df: DataFrame,
    machine: bytes,
    text_col: str = "text",
    score_col: str = "score",
    stated_col: str | None = None,
) -> DataFrame:
    """``df`` with the quality of each text, 0 to 1, in ``score_col``, which replaces a column of
    that name.

    ``stated_col`` is a column with the text's length in characters; where it is NULL, and by
    default, the length is counted.  A NULL text is empty, and an empty text is scored by its
    structure.  Repeated rows are scored each; an empty table stays empty.
    """
    df = df.drop(score_col)
    rows, scored = _scored(df, machine, text_col, stated_col)
    names = [*df.columns, score_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, scores in scored(batches):
            yield pa.RecordBatch.from_arrays([*columns, pa.array(scores)], names=names)

    return rows.mapInArrow(run, T.StructType([*df.schema, T.StructField(score_col, T.DoubleType())]))


def drop_low_quality(
    df: DataFrame,
    machine: bytes,
    threshold: float = THRESHOLD,
    text_col: str = "text",
    stated_col: str | None = None,
) -> DataFrame:
    """The rows of ``df`` that score ``threshold`` or more, with its own columns."""
    rows, scored = _scored(df, machine, text_col, stated_col)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, scores in scored(batches):
            kept = pa.RecordBatch.from_arrays(columns, names=names)
            yield kept.filter(pa.array(scores >= threshold))

    return rows.mapInArrow(run, df.schema)
