"""Cross-tokenizer alignment against the libraries on whole texts and a plain merge of two lists."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tidemark.llm import alignment

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")

HOSTILE = [
    None,
    "",
    " ",
    "   ",
    "a",
    " a",
    "one two  three   four",
    "tab\there\n\n  new line \n\tand  more \n",
    "literal ▁ mark",
    "▁",
    "<|endoftext|> and <s> or </s> <unk> <0x41>",
    "naïve café — « citation » … ‘quotes’ end…  next",
    "mixed 中文 字符 and кириллица भारत 🙂🙂 é́ ﬁ İ",
    "it's we'll they'd 's 't",
    "nbsp here 　wide em \u0085 next᠎ x​ y",
    "nul\x00 byte \x1f \x7f",
    "no-spaces-" * 300,
    "字" * 900,
    "trailing space ",
    "a" * 700 + " " * 700 + "b",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain(text, libraries):
    """A's and B's ids, links and groups of one text, by one loop over whole encodings."""
    a, b = libraries
    if not text:
        return [], [], [], []
    data = (" " + text).encode()
    a_ids, b_ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    a_sizes = [len(a.id_to_token(i)) for i in a_ids]
    pieces = [b.id_to_piece(i) for i in b_ids]
    spelt = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b_ids, pieces)]
    if b"".join(spelt) != data or sum(a_sizes) != len(data):
        return [], [], [], []
    links, groups, i, j = [], [], 0, 0
    a_end, b_end, a_start, b_start = a_sizes[0], len(spelt[0]), 0, 0
    while True:
        links.append((i, j))
        if a_end == b_end:
            groups.append((a_ids[a_start : i + 1], b_ids[b_start : j + 1]))
            a_start, b_start = i + 1, j + 1
        step_a, step_b = a_end <= b_end, b_end <= a_end
        if step_a:
            i += 1
        if step_b:
            j += 1
        if i == len(a_ids):
            return a_ids, b_ids, links, groups
        a_end += a_sizes[i] if step_a else 0
        b_end += len(spelt[j]) if step_b else 0


def statistics(texts, libraries):
    found = [plain(t, libraries) for t in texts]
    count = Counter((a[i], b[j]) for a, b, links, _ in found for i, j in links)
    top = Counter()
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    rows = []
    for a, b, links, groups in found:
        pairs = [(a[i], b[j]) for i, j in links]
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append(
            (
                len(a),
                len(b),
                len(groups),
                len(links),
                sum(count[p] == top[p[1]] for p in pairs),
                sum(count[p] for p in pairs),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    return rows


def random_texts(n):
    rng = random.Random(11)
    bits = ["the ", "of", " ", "  ", "\n", "\t", "…", "é", "中", "'s", "ing ", "42", ".", ", ", "—", " ", "🙂", "x"]
    return ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(n)]


def check(spark, texts, libraries, monkeypatch=None):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r[0]: tuple(r)[1:] for r in alignment.link_statistics(df, A, B).collect()}
    assert [found[i] for i in range(len(texts))] == statistics(texts, libraries)


def test_statistics_are_those_of_the_plain_merge(spark, libraries):
    check(spark, HOSTILE + random_texts(400), libraries)


def test_statistics_of_a_table(spark, sf_dir, libraries):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = [r.text for r in documents.select("text").collect()]
    check(spark, texts, libraries)


def test_small_lanes_pieces_and_blocks(libraries, monkeypatch):
    """A text longer than a piece, a lane, a batch and a block comes out the same."""
    monkeypatch.setattr(alignment, "PIECE_CHARS", 50)
    coder = alignment.Coder(A, B)
    for text in [t for t in HOSTILE if t] + random_texts(60):
        a, b, links, groups = plain(text, libraries)
        pieces = list(coder.pieces(text))
        assert " ".join(pieces) == text
        ids = [coder.encode_many([p])[0] for p in pieces]
        if not a:
            assert None in ids
            continue
        x = alignment.Alignment(coder, [(b"".join(p for p, _ in ids), b"".join(p for _, p in ids))])
        assert x.a.tolist() == a and x.b.tolist() == b
        assert list(zip(x.link_a.tolist(), x.link_b.tolist())) == links
        a_ends, b_ends = np.cumsum(coder.a_sizes[x.a]), np.cumsum(coder.b_sizes[x.b])
        for lane in (1, 2, 7):
            parted = alignment.lockstep(a_ends, b_ends, np.array([0]), lane)
            assert all((p == q).all() for p, q in zip(parted, (x.link_a, x.link_b, x.cut_a, x.cut_b)))
        in_parts = alignment.Alignment(coder, ids)
        tables = alignment.GroupTables(50_300)
        assert "".join(in_parts.group_texts(tables)) == "".join(x.group_texts(tables))


def test_documents_in_many_batches(spark, libraries, monkeypatch):
    texts = [t for t in HOSTILE if t and "▁" not in t]
    coder = alignment.Coder(A, B)
    tables = alignment.GroupTables(50_300)
    block = alignment._Block()
    for text in texts:
        document = alignment._Document(1)
        block.documents.append(document)
        for word in coder._words(text):
            block.align(coder, tables, [(document, coder.encode_many([word])[0])])
    expected = statistics(texts, libraries)
    assert [(*d.sums.tolist(), d.groups_sha256()) for d in block.documents] == [(*r[:4], r[6]) for r in expected]


def test_align_returns_ids_links_and_groups(spark, libraries):
    texts = HOSTILE[:16]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in alignment.align(df, A, B).collect():
        a, b, links, groups = plain(texts[row.doc_id], libraries)
        assert (row.a_ids, row.b_ids) == (a, b)
        assert list(zip(row.link_a, row.link_b)) == links
        assert row.group_a == np.cumsum([len(x) for x, _ in groups]).tolist()
        assert row.group_b == np.cumsum([len(y) for _, y in groups]).tolist()


def test_edges(spark, libraries):
    schema = "doc_id long, text string, block long, place long, pair long, total long, best boolean, n_a long"
    rows = [(1, "same text", 1, 2, 3, 4, True, 5), (1, "same text", 1, 2, 3, 4, True, 5), (None, None, *[None] * 6), (None, "same text", *[None] * 6)]
    df = spark.createDataFrame(rows, schema)
    found = alignment.link_statistics(df, A, B)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = sorted((r.doc_id or 0, r.n_links, r.n_best, r.count_sum) for r in found.collect())
    assert got == [(0, 0, 0, 0), (0, 2, 2, 6), (1, 2, 2, 6), (1, 2, 2, 6)]
    assert alignment.link_statistics(df.where("false"), A, B).collect() == []
    assert alignment.link_statistics(df.where("text IS NULL"), A, B).count() == 1
    assert alignment.align(df.where("false"), A, B).collect() == []
    long = "several words of text " * 120_000  # over two pieces
    (row,) = alignment.link_statistics(spark.createDataFrame([(9, long)], "doc_id long, text string"), A, B).collect()
    assert tuple(row)[1:] == statistics([long], libraries)[0]
