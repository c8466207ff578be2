"""Bounded samples of labelled documents, for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import empty_if_null

FOLDS = 5


def held_out(id_col: str = "doc_id", folds: int = FOLDS) -> F.Column:
    """Whether a document is kept from training: crc32 of its id as text is a multiple of
    ``folds``.  A NULL id is never trained on."""
    fold = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % folds
    return F.coalesce(fold == 0, F.lit(True))


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label_col: str,
    rows: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``text, label`` of at most ``rows`` labelled documents that are not held out.

    The ids least by hash are taken.  Labels that contradict each other are averaged; NULL
    labels and ids are left out; of several documents with one id the least text counts.
    """
    key = F.col(f"`{id_col}`").cast("bigint")
    chosen = (
        labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("double").alias("label"))
        .where(F.col("label").isNotNull() & F.col("id").isNotNull() & ~held_out("id"))
        .groupBy("id")
        .agg(F.avg("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(rows)
    )
    texts = documents.select(key.alias("id"), empty_if_null(F.col(f"`{text_col}`")).alias("text"))
    # ``rows`` ids at most
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
