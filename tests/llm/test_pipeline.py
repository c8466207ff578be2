"""The corpus pipeline against brute force over the documents that its classifiers keep."""

from __future__ import annotations

import re

import corpus_pipeline
from tidemark.sinks.staging import stage

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline(spark, sf_dir):
    functions = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    total = docs.count()
    for name in ("quality", "toxicity"):
        docs = stage(functions[name](spark, docs, sf_dir))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert 0.6 * total < len(texts) < total

    first = {}
    for i in sorted(texts):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    exact = sorted(first.values())
    assert len(exact) < len(texts)

    sets = {i: shingles(texts[i]) for i in exact}
    label = {i: i for i in exact}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    holders = {}
    for i in exact:
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for i, j in {(a, b) for held in holders.values() for b in held for a in held if a < b}:
        common = len(sets[i] & sets[j])
        if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((root(i), root(j)))
            label[b] = a
    near = {i for i in exact if root(i) == i}

    packed = corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "doc_tokens").collect()
    assert {r.doc_id for r in packed} == near
    for i in near:
        own = sorted((r.start, r.length, r.doc_tokens) for r in packed if r.doc_id == i)
        at = 0
        for start, length, _ in own:
            assert start == at
            at += length
        assert at == own[0][2]
