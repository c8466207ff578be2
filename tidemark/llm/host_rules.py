"""Quality rules by host: documents fail rules, hosts are judged by their shrunk failure rates.

Every document is measured and judged by fixed rules.  Failures are summed by host, a beta
prior is fitted to the hosts' rates by the method of moments, each host's rate is shrunk
towards it, and the hosts' verdicts are joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.types import free_name, quoted
from tidemark.llm.text import (
    SPACE,
    batch_slices,
    empty_if_null,
    shingles,
    span_hashes,
    spans,
    text_bytes,
    words,
)
from tidemark.sinks.staging import stage

#: Shrunk failure rate beyond which a host is rejected.
MAX_RATE = 0.5
#: Hosts whose rates do not differ at all count as if the prior had seen so many documents.
LARGEST_PRIOR = 1e6
#: Parts that the documents of a host, of which one may have a third of all, are joined in.
SALTS = 64
#: Rows of the largest host that one part of it should hold, beyond SALTS parts.
SALT_ROWS = 200_000
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True bytes in each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[offsets])


def repeated_words(word_hashes: np.ndarray) -> int:
    """Words that lie in a window found twice or more in the text."""
    n = len(word_hashes)
    if n <= WINDOW:
        return 0
    windows = shingles(word_hashes, WINDOW)
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    if len(count) == len(windows):
        return 0
    starts = np.flatnonzero(count[place] > 1)
    covered = np.zeros(n + 1, np.int32)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + WINDOW, -1)
    return int(np.count_nonzero(np.cumsum(covered[:n])))


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """STATISTICS of each text."""
    data, offsets = text_bytes(texts)
    starts, ends, before = words(data, offsets)
    hashes = span_hashes(data, starts, ends)
    in_word = ~SPACE[data]
    line_starts, line_ends, _ = spans(data != 0x0A, offsets)
    filled = np.zeros(len(data) + 1, np.int64)
    np.cumsum(in_word, out=filled[1:])
    worded = filled[line_ends] > filled[line_starts]
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_hashes = span_hashes(data, line_starts, line_ends)
    lines_before = np.searchsorted(line_starts, offsets)
    rows = range(len(offsets) - 1)
    return {
        "n_words": np.diff(before),
        "word_chars": _sums(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _sums(SYMBOL[data], offsets),
        "n_dup_lines": np.array(
            [
                (b - a) - len(np.unique(line_hashes[a:b])) if b - a > 1 else 0
                for a, b in ((lines_before[i], lines_before[i + 1]) for i in rows)
            ],
            np.int64,
        ),
        "n_repeat_words": np.array(
            [repeated_words(hashes[before[i] : before[i + 1]]) for i in rows], np.int64
        ),
    }


def rule_statistics(df: DataFrame, keep: Sequence[str], text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of ``df`` with STATISTICS of its texts; a NULL text has no words.

    Only those columns are read, so others may have any name; a kept column named as a
    statistic is an error.
    """
    if clash := set(keep) & set(STATISTICS):
        raise ValueError(f"columns {sorted(clash)} are named as statistics")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch_slices(batch, len(keep)):
                found = measure(part.columns[-1])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *(pa.array(found[c]) for c in STATISTICS)],
                    names=[*keep, *STATISTICS],
                )

    # Spark passes columns to ``mapInArrow`` by names without dots
    read = df.select(
        *(quoted(c).alias(f"c{i}") for i, c in enumerate(keep)), empty_if_null(quoted(text_col)).alias("text")
    )
    schema = T.StructType(
        [
            *(T.StructField(c, f.dataType) for c, f in zip(keep, read.schema)),
            *(T.StructField(c, T.LongType()) for c in STATISTICS),
        ]
    )
    return read.mapInArrow(run, schema)


def base_failed() -> F.Column:
    """Whether the rules reject a document, from its STATISTICS."""
    return F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    )


def host_rates(judged: DataFrame, host_col: str, failed_col: str) -> DataFrame:
    """``host, n, failures, rate``: the failure rate of each host, shrunk to the beta prior.

    With mean m and variance v of the hosts' own rates the prior has the strength
    m (1 - m) / v - 1, of which m fails.  Rows without a host are left out.
    """
    hosts = (
        judged.where(quoted(host_col).isNotNull())
        .groupBy(quoted(host_col).alias("host"))
        .agg(F.count("*").alias("n"), F.count_if(quoted(failed_col)).alias("failures"))
    )
    prior = hosts.agg(
        F.avg(F.expr("failures / n")).alias("m"), F.var_pop(F.expr("failures / n")).alias("v")
    ).selectExpr(
        "m",
        f"""CASE WHEN v > 1e-12 THEN least({LARGEST_PRIOR}D, greatest(0D, m * (1 - m) / v - 1))
            ELSE {LARGEST_PRIOR}D END AS strength""",
    )
    # the prior is one row
    return hosts.crossJoin(F.broadcast(prior)).selectExpr(
        "host", "n", "failures", "(failures + m * strength) / (n + strength) AS rate"
    )


def judge_hosts(
    measured: DataFrame, host_col: str = "source", max_rate: float = MAX_RATE
) -> DataFrame:
    """``measured`` (of :func:`rule_statistics`) with ``base_failed`` and ``kept``, which replace
    columns of these names; all others stay.

    A document is kept if it passes the rules and its host is not rejected; without a host
    (NULL) its rules alone decide.  An empty table stays empty.
    """
    judged = stage(measured.drop("base_failed", "kept").withColumn("base_failed", base_failed()))
    rates = stage(host_rates(judged, host_col, "base_failed"))
    largest = rates.agg(F.max("n").alias("n")).first()["n"] or 0
    salts = max(SALTS, -(-largest // SALT_ROWS))
    host, part, salt = (free_name(judged, name) for name in ("rejected host", "part", "salt"))
    verdicts = rates.where(F.col("rate") > max_rate).select(
        F.col("host").alias(host),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias(part),
    )
    row = F.xxhash64(*map(quoted, judged.columns), F.spark_partition_id())
    salted = judged.withColumn(salt, F.pmod(row, F.lit(salts)).cast("int"))
    same = (quoted(host_col) == quoted(host)) & (quoted(salt) == quoted(part))
    return (
        salted.join(verdicts, same, "left")
        .withColumn("kept", ~F.col("base_failed") & quoted(host).isNull())
        .drop(host, part, salt)
    )
