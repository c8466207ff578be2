"""Every operator on NULLs, empty and very long texts, repeated rows, clashing names, no rows."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import (
    byte_bpe,
    chat,
    exact_dedup,
    host_rules,
    minhash,
    packing,
    ppm,
    quality_fm,
    toxicity,
    url_filter,
)

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, content string, row long, "
    "score double, ids string, shard string, __text string, severity string, node long, key long, "
    "__id long, __hash long, host string, kept boolean, label int"
)
CLASH = ("c", 7, 0.5, "i", "s", "t", "v", 8, 9, 10, 11, "h", True, 3)
LONG_TEXT = "Lorem ipsum dolor " * 20_000
ROWS = [
    (1, "one two three four five six seven eight nine ten eleven", "en", "a", 54),
    (2, "One two three four five six seven eight nine ten eleven", "en", "a", None),
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 4),
    (6, "same", "en", "b", 4),
    (6, "same", "en", "b", 4),
    (None, "same", None, None, 4),
    (None, None, None, None, None),
    (7, LONG_TEXT, "en", "a", len(LONG_TEXT)),
    (8, "stray ﬀ İ ß 🙂 \x00 <|endoftext|> é́", "de", None, 1),
]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(*r, *CLASH) for r in ROWS], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(1, 9)] + [(None, 1, 0), (1, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def by_id(df):
    found = {}
    for row in df.collect():
        found.setdefault(row["doc_id"], []).append(row)
    return found


def test_exact_dedup(documents):
    found = by_id(exact_dedup.exact_duplicates(documents))
    assert sum(map(len, found.values())) == len(ROWS)
    assert {r.keep_id for i in (3, 4) for r in found[i]} == {3}
    assert [r.group_size for r in found[6]] == [3, 3] and sum(r.kept for r in found[6]) == 1
    assert sorted(r.keep_id for r in found[None]) == [3, 6] and not any(r.kept for r in found[None])
    assert found[5][0].keep_id == 5 and found[7][0].group_size == 1
    kept = exact_dedup.drop_exact_duplicates(documents)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 5, 6, 7, 8]
    assert exact_dedup.exact_duplicates(documents.where("false")).count() == 0
    assert exact_dedup.drop_exact_duplicates(documents.where("false")).count() == 0


def test_byte_bpe(documents):
    encoded = byte_bpe.encode(documents, RANKS, public_tokenizers.PATTERN)
    assert sorted(encoded.columns) == sorted({*documents.columns} - {"text"})
    decoded = byte_bpe.decode(encoded, RANKS)
    texts = sorted((r.decoded.decode() for r in decoded.collect()))
    assert texts == sorted(r[1] or "" for r in ROWS)
    assert byte_bpe.decode(byte_bpe.encode(documents.where("false"), RANKS, "x"), RANKS).count() == 0


def test_packing(documents):
    pieces = packing.pack(documents, WORDS).collect()
    assert {p.doc_id for p in pieces} == {r[0] for r in ROWS}
    # every row has an end token, and rows with an id of their own come back whole
    assert sum(p.length for p in pieces if p.doc_id in (3, 4, 5)) == 3
    long = sorted((p for p in pieces if p.doc_id == 7), key=lambda p: p.start)
    ids = [i for p in long for i in np.frombuffer(p.ids, "<u4").tolist()]
    assert ids == [*Tokenizer.from_file(WORDS).encode(LONG_TEXT, add_special_tokens=False).ids, 2]
    assert sum(p.start == 0 for p in pieces) == len(ROWS)
    assert packing.pack(documents.where("false"), WORDS).count() == 0


def test_minhash(documents):
    found = by_id(minhash.near_duplicates(documents, k=2))
    assert sum(map(len, found.values())) == len(ROWS)
    assert {r.component_id for i in (1, 2) for r in found[i]} == {1}
    assert all(r.n_shingles == 0 and r.component_id == i for i in (3, 4, 5) for r in found[i])
    assert sorted((r.n_shingles, r.component_id) for r in found[None]) == [(0, None), (1, 6)]
    kept = minhash.drop_near_duplicates(documents, k=2)
    assert kept.columns == documents.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 3, 4, 5, 6, 6, 7, 8]
    assert minhash.near_duplicates(documents.where("false")).count() == 0
    assert minhash.drop_near_duplicates(documents.where("false")).count() == 0


def test_classifiers(documents, labels):
    for part, score, drop, label in (
        (quality_fm, quality_fm.score, quality_fm.drop_low_quality, "score"),
        (toxicity, toxicity.score, toxicity.drop_toxic, "toxic_probability"),
    ):
        for some in (labels, labels.where("false"), labels.where("doc_id = 1")):
            model = part.train(documents, some)
            scored = score(documents, model).collect()
            assert len(scored) == len(ROWS) and all(0 <= r[label] <= 1 for r in scored)
            assert drop(documents, model).columns == documents.columns
        assert score(documents.where("false"), part.train(documents.where("false"), labels)).count() == 0
        assert drop(documents.where("false"), model).count() == 0
    stated = quality_fm.score(documents, quality_fm.train(documents, labels), stated_col="n_chars")
    assert stated.where("score IS NULL").count() == 0


def test_host_rules(documents):
    measured = host_rules.rule_statistics(documents, ["doc_id", "source", "host"])
    judged = by_id(host_rules.judge_hosts(measured))
    assert sum(map(len, judged.values())) == len(ROWS)
    assert judged[3][0].n_words == 0 and judged[3][0].base_failed and not judged[3][0].kept
    assert judged[7][0].n_words == 60_000 and judged[7][0].n_repeat_words == 60_000
    by_host = host_rules.judge_hosts(host_rules.rule_statistics(documents, ["doc_id", "host"]), "host")
    assert by_host.count() == len(ROWS)
    empty = host_rules.rule_statistics(documents.where("false"), ["doc_id", "source"])
    assert host_rules.judge_hosts(empty).count() == 0


def test_ppm(documents):
    found = ppm.score(documents).collect()
    assert len(found) == len(ROWS) and all(r.score < 0 and r.base_score < 0 for r in found)
    assert all(r.n_tokens == 1 for r in found if r.doc_id in (3, 4, 5))
    assert all(r.held_out for r in found if r.doc_id is None)
    untrained = ppm.score(documents, training=F.lit(None).cast("boolean")).collect()
    assert {r.train_tokens for r in untrained} == {0} and {r.n_known for r in untrained} == {0}
    assert ppm.score(documents.where("false")).count() == 0


def test_url_filter(spark):
    urls = [None, "", "nothing", "http://", "http://A.Org", "http://a.org/x", "http://a.org/x", "x://b/" + "s/" * 50]
    pages = spark.createDataFrame(
        [(i if i else None, u, "h", "t") for i, u in enumerate(urls)],
        "page_id long, url string, host string, template string",
    )
    found = url_filter.judge_urls(pages, [("block", "org/"), ("allow", "a.org/x")]).collect()
    assert len(found) == len(urls) and all(r.verdict in ("allow", "block") for r in found)
    assert {r.rule for r in found if r.host == "a.org"} == {None, "a.org/x"}
    assert all(r.host == "" == r.path for r in found if r.page_id in (None, 1, 2, 3))
    assert url_filter.judge_urls(pages.where("false"), []).count() == 0


def test_chat(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, None), (None, 1, "assistant", "x" * 300_000),
            (2, 0, "assistant", ""), (3, 1, "a\nb\\<|", "<|im_end|>\\<\\|")]
    turns = spark.createDataFrame(
        [(*r, 5, "f") for r in rows],
        "conv_id long, turn long, role string, text string, ids int, formatted string",
    )
    found = {r.conv_id: r for r in chat.format_conversations(turns, BYTES).collect()}
    assert {k: r.n_turns for k, r in found.items()} == {1: 3, 2: 1, 3: 1, None: 1}
    assert chat.parse(found[1].formatted) == [("", ""), ("user", "hi"), ("user", "hi")]
    assert found[None].learned == "x" * 300_000 and found[2].learned == ""
    assert chat.parse(found[3].formatted) == [("a\nb\\<|", "<|im_end|>\\<\\|")]
    assert chat.format_conversations(turns.where("false"), BYTES).count() == 0
    alone = chat.format_conversations(turns.withColumn("conv_id", F.lit(None).cast("long")), BYTES).collect()
    assert [(r.conv_id, r.n_turns) for r in alone] == [(None, 1)] * len(rows)


def test_pipeline_stages(spark, documents, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        for some in (docs, docs.where("false")):
            result = stage(spark, some, str(tmp_path))
            result.count()
        if name != "packing":
            result = stage(spark, docs, str(tmp_path))
            assert result.columns == documents.columns, name


def test_columns_named_like_helpers_of_host_rules(documents):
    names = ["__host", "__text", "__salt", "__part", "salt", "part", "rejected host", "text of the rules", "a.b"]
    named = documents.select("doc_id", "text", "source", *[F.lit(f"own {n}").alias(n) for n in names])
    kept = ["doc_id", "source", *names]
    judged = host_rules.judge_hosts(host_rules.rule_statistics(named, kept))
    assert judged.columns == [*kept, *host_rules.STATISTICS, "base_failed", "kept"]
    plain = host_rules.judge_hosts(host_rules.rule_statistics(documents, ["doc_id", "source"]))
    facts = [*host_rules.STATISTICS, "base_failed", "kept"]
    for r in judged.collect():
        assert all(r[n] == f"own {n}" for n in names)
    key = lambda rows: sorted(str([r[c] for c in ("doc_id", *facts)]) for r in rows)
    assert key(judged.collect()) == key(plain.collect())
    again = host_rules.judge_hosts(judged.withColumn("kept", F.lit(None).cast("boolean")))
    assert key(again.collect()) == key(plain.collect())


def test_exact_dedup_resolves_names_in_any_case(documents):
    renamed = documents.select(F.col("doc_id").alias("Doc_ID"), F.col("text").alias("TEXT"), "lang")
    assert exact_dedup.drop_exact_duplicates(renamed).count() == 7
