"""A corpus pipeline: quality, toxicity, exact and near duplicates, packing.

``STAGES`` lists its stages; each takes ``(spark, docs, sf_dir)``, works on all documents that
the one before kept and returns a frame, which :func:`run` writes as Parquet and reads
again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, minhash, packing, quality_fm, toxicity
from tidemark.sinks.staging import stage


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine, fitted on the labels, does not reject."""
    machine = quality_fm.train(docs, _table(spark, sf_dir, "labels"))
    return quality_fm.drop_low_quality(docs, machine, stated_col="n_chars")


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal regression, fitted on the labels, does not hold toxic."""
    regression = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, regression)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal texts, that with the least id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences along the Hilbert curve."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality),
    ("toxicity", toxic),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("packing", pack),
]

#: SQL can express neither the classifiers nor the tokenizer; tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, one after another, over the whole table ``documents``."""
    docs = _table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
