"""Alignment of two tokenizers' tokens by lockstep merging.

Tokenizer A is byte-level BPE (a file of the tokenizers library), B a sentencepiece model with a
dummy prefix.  Both spell the same bytes, a space and then the text, so their tokens are two
divisions of one range.  One NumPy state vector holds the A and B pointers of all documents of a
batch; every step links the tokens under the pointers, cuts where both end, advances whichever
ends first, and drops documents that are through.

How often an id pair is linked in the whole corpus is a table: a block of documents sends each of its
distinct pairs once, the counts are summed and joined back, and the block reads its links by them.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import batch_slices, empty_if_null
from tidemark.sinks.staging import stage

#: A tokens after which a document goes on as a further lane of the state vector.
LANE = 256
#: Tokens of A that are aligned at once, and characters of a text that are encoded at once.
BATCH_TOKENS = 1 << 17
PIECE_CHARS = 1 << 20
#: Characters of new words that go through the libraries at once.
JOINED_CHARS = 1 << 16
#: Bytes of text in a block of documents.
BLOCK_BYTES = 8 << 20
#: Pairs of a block in one row of its table.
ROW_PAIRS = 50_000
#: Words whose ids a process remembers, and the characters of the longest.
CACHE_ENTRIES = 120_000
LONGEST_CACHED = 64

_coders: dict[tuple[str, str], Coder] = {}


def lockstep(
    a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, lane: int = LANE
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links and cuts of documents that lie end to end.

    ``a_ends`` and ``b_ends`` are the byte offsets where tokens end, counted on from one document
    to the next, and ``a_first`` the number of A tokens before each document.  Returns the
    A and B tokens of every link and of every cut, both in order.
    """
    counts = np.diff(np.append(a_first, len(a_ends)))
    lanes = -(-counts // lane)
    number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    a = np.repeat(a_first, lanes) + number * lane
    stop = np.minimum(a + lane, np.repeat(a_first + counts, lanes))
    b = np.searchsorted(b_ends, np.where(a > 0, a_ends[a - 1], 0), "right")
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    cuts: list[tuple[np.ndarray, np.ndarray]] = []
    while len(a):
        steps.append((a, b))
        a_end, b_end = a_ends[a], b_ends[b]
        both = a_end == b_end
        cuts.append((a[both], b[both]))
        a, b = a + (a_end <= b_end), b + (b_end <= a_end)
        open_ = a < stop
        if not open_.all():
            a, b, stop = a[open_], b[open_], stop[open_]
    return (*_in_order(steps), *_in_order(cuts))


def _in_order(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of pointers in the order of the text, in which their sum only grows."""
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = (np.concatenate(side) for side in zip(*found))
    order = np.full(int((a + b).max(initial=-1)) + 1, -1)
    order[a + b] = np.arange(len(a))
    order = order[order >= 0]
    return a[order], b[order]


def _ends_safely(word: str) -> bool:
    """Whether a space after this text starts a new token in both tokenizers."""
    return bool(word) and unicodedata.category(word[-1])[0] in "LMNPS"


class Coder:
    """Ids of texts by both libraries, word by word.

    A text is cut before a space that follows a letter, mark, digit, punctuation or symbol.  A's
    pattern never joins what lies before such a space with it, and no piece of B goes on
    with a space after another character, so the ids of a text are those of its words, each taken
    with the space before it, and a word met before is looked up.  Files that are
    made otherwise are given whole texts.
    """

    def __init__(self, a_path: str, b_path: str):
        import os

        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        names = self.a.get_vocab()
        self.a_sizes = np.zeros(max(names.values()) + 1, np.int64)
        for token, i in names.items():
            self.a_sizes[i] = len(token)  # a character stands for a byte
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        with open(a_path, encoding="utf-8") as file:
            made = json.load(file)
        splits = made.get("pre_tokenizer") or {}
        self.by_word = (
            not made.get("normalizer")
            and splits.get("type") == "ByteLevel"
            and splits.get("use_regex", True)
            and not any("▁" in p.lstrip("▁") for p in pieces)
            and "".join(self.b.encode(" a  b ", out_type=str)) == "▁▁a▁▁b▁"
        )
        #: Ids of a space and the word; None where the bytes of B are not those of the text.
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def _b_spells(self, ids: list[int], data: bytes) -> bool:
        return b"".join(map(self.b_bytes.__getitem__, ids)) == data

    def _encode_one(self, word: str) -> tuple[bytes, bytes] | None:
        a, b = self.a.encode(" " + word, add_special_tokens=False).ids, self.b.encode(word, num_threads=1)
        data = (" " + word).encode()
        if not self._b_spells(b, data) or int(self.a_sizes[a].sum()) != len(data):
            return None
        return np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes()

    def _encode_words(self, words: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        """Ids of words that end safely: many go through the libraries as one text, whose ids are
        parted by the bytes of the words."""
        found = {w: None for w in words if "▁" in w}
        words = [w for w in words if w not in found]
        chars = np.cumsum([len(w) + 1 for w in words])
        start = 0
        while start < len(words):
            before = chars[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(chars, before + JOINED_CHARS)))
            self._encode_joined(words[start:stop], found)
            start = stop
        return found

    def _encode_joined(self, words: list[str], found: dict[str, tuple[bytes, bytes] | None]) -> None:
        joined = " ".join(words)
        data = (" " + joined).encode()
        ends = np.cumsum([len(w.encode()) + 1 for w in words])
        a = np.array(self.a.encode_batch_fast([" " + joined], add_special_tokens=False)[0].ids, "<i4")
        ids = self.b.encode(joined, num_threads=1)
        b = np.array(ids, "<i4")
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        if a_ends[-1] != len(data) or not self._b_spells(ids, data):
            found.update((w, self._encode_one(w)) for w in words)
            return
        a_cut, b_cut = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        assert (a_ends[a_cut] == ends).all() and (b_ends[b_cut] == ends).all()
        a, b = a.tobytes(), b.tobytes()
        at_a = at_b = 0
        for w, stop_a, stop_b in zip(words, ((a_cut + 1) * 4).tolist(), ((b_cut + 1) * 4).tolist()):
            found[w] = a[at_a:stop_a], b[at_b:stop_b]
            at_a, at_b = stop_a, stop_b

    def _words(self, text: str) -> list[str]:
        """The words of a text; all but the last one end safely."""
        if not self.by_word:
            return [text]
        words, open_ = [], []
        parts = text.split(" ")
        for part in parts:
            open_.append(part)
            if _ends_safely(part):
                words.append(" ".join(open_))
                open_ = []
        rest = " ".join(open_)
        if rest or not words:
            words.append(rest)
        elif open_:  # B gives nothing for a space alone, which it takes for its own prefix
            words[-1] += " "
        return words

    def encode_many(self, texts: list[str]) -> list[tuple[bytes, bytes] | None]:
        """Ids by A and B of a space and each text, as 32-bit integers end to end; None for a
        text whose bytes B does not spell."""
        known = self.known
        rows = [text.split(" ") if self.by_word else [text] for text in texts]
        new_parts = set().union(*rows).difference(known)
        unsafe = {w for w in new_parts if not (self.by_word and _ends_safely(w))}
        missing, last = new_parts - unsafe, set()
        for i, row in enumerate(rows):
            if not unsafe.isdisjoint(row):  # parts go together until one ends safely
                rows[i] = row = self._words(texts[i])
                if not (self.by_word and _ends_safely(row[-1])):
                    last.add(row[-1])
                missing.update(w for w in row if w not in known and w not in last)
        new = self._encode_words(list(missing))
        lone = {w: self._encode_one(w) for w in last}
        if len(known) + len(new) <= CACHE_ENTRIES:
            known.update((w, ids) for w, ids in new.items() if len(w) <= LONGEST_CACHED)
        encoded = []
        for row in rows:
            pairs = [known[w] if w in known else new[w] if w in new else lone[w] for w in row]
            if None in pairs:
                encoded.append(None)
            else:
                a, b = zip(*pairs)
                encoded.append((b"".join(a), b"".join(b)))
        return encoded

    def pieces(self, text: str) -> Iterator[str]:
        """A text in pieces of about PIECE_CHARS characters, the space between two left out."""
        start = 0
        while self.by_word and len(text) - start > PIECE_CHARS:
            at = start + PIECE_CHARS
            while True:
                at = text.find(" ", at)
                if at < 0 or _ends_safely(text[at - 1]):
                    break
                at += 1
            if at < 0 or at + 1 == len(text):
                break
            yield text[start:at]
            start = at + 1
        yield text[start:]


def coder(a_path: str, b_path: str) -> Coder:
    if (a_path, b_path) not in _coders:
        _coders[a_path, b_path] = Coder(a_path, b_path)
    return _coders[a_path, b_path]


class Alignment:
    """Tokens, links and cuts of some pieces of documents, end to end."""

    def __init__(self, coder: Coder, encoded: list[tuple[bytes, bytes]]):
        self.a = np.frombuffer(b"".join(a for a, _ in encoded), "<i4")
        self.b = np.frombuffer(b"".join(b for _, b in encoded), "<i4")
        self.a_first = np.cumsum([0, *(len(a) // 4 for a, _ in encoded)])
        self.b_first = np.cumsum([0, *(len(b) // 4 for _, b in encoded)])
        a_ends, b_ends = np.cumsum(coder.a_sizes[self.a]), np.cumsum(coder.b_sizes[self.b])
        found = lockstep(a_ends, b_ends, self.a_first[:-1])
        self.link_a, self.link_b, self.cut_a, self.cut_b = found
        self.link_first = np.searchsorted(self.link_a, self.a_first)
        self.cut_first = np.searchsorted(self.cut_a, self.a_first)

    def pairs(self) -> np.ndarray:
        """The id pair of every link, A's above B's."""
        return self.a[self.link_a].astype(np.int64) << 32 | self.b[self.link_b]

    def group_texts(self, tables: GroupTables) -> list[str]:
        """``a1,a2|b1;...`` of every piece, a semicolon after each group."""
        a_stops, b_stops = self.cut_a + 1, self.cut_b + 1
        a_starts, b_starts = np.insert(a_stops[:-1], 0, 0), np.insert(b_stops[:-1], 0, 0)
        out = np.empty(len(self.a) + len(self.b), object)
        at_a = np.arange(len(self.a)) + np.repeat(b_starts, a_stops - a_starts)
        at_b = np.arange(len(self.b)) + np.repeat(a_stops, b_stops - b_starts)
        out[at_a] = tables.comma[self.a]
        out[at_b] = tables.comma[self.b]
        out[at_a[self.cut_a]] = tables.bar[self.a[self.cut_a]]
        out[at_b[self.cut_b]] = tables.semicolon[self.b[self.cut_b]]
        written = out.tolist()
        borders = (self.a_first + self.b_first).tolist()
        return ["".join(written[i:j]) for i, j in zip(borders, borders[1:])]


class GroupTables:
    """Decimal ids with the mark that follows them."""

    def __init__(self, size: int):
        self.comma, self.bar, self.semicolon = (
            np.array([f"{i}{mark}" for i in range(size)], object) for mark in ",|;"
        )


class _Document:
    """A document on its way through the batches."""

    def __init__(self, doc_id: int | None):
        self.doc_id = doc_id
        self.sums = np.zeros(4, np.int64)  # tokens of A and B, groups, links
        self.digest = hashlib.sha256()
        self.pending = ""

    def add(self, sums: np.ndarray, groups: str) -> None:
        self.sums += sums
        self.digest.update((self.pending + groups[:-1]).encode())
        self.pending = ";"

    def groups_sha256(self) -> str:
        return self.digest.hexdigest() if self.pending else ""


class _Block:
    """Documents with their links, until :meth:`rows` writes them."""

    def __init__(self):
        self.documents: list[_Document] = []
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.bytes = 0

    def align(self, coder: Coder, tables: GroupTables, waiting: list[tuple[_Document, tuple[bytes, bytes]]]) -> None:
        if not waiting:
            return
        aligned = Alignment(coder, [ids for _, ids in waiting])
        firsts = (aligned.a_first, aligned.b_first, aligned.cut_first, aligned.link_first)
        sums = np.stack([np.diff(f) for f in firsts], 1)
        for (document, _), of_piece, groups in zip(waiting, sums, aligned.group_texts(tables)):
            document.add(of_piece, groups)
        pairs, place, n = np.unique(aligned.pairs(), return_inverse=True, return_counts=True)
        self.found.append((pairs, place.astype(np.int32), n))

    def rows(self, block: int) -> Iterator[pa.RecordBatch]:
        """A row with the documents, a row with the links of each batch as places among the block's
        pairs, and rows with the pairs in order."""
        empty = np.zeros(0, np.int64)
        pairs, back = np.unique(np.concatenate([empty, *(p for p, _, _ in self.found)]), return_inverse=True)
        counts = np.bincount(back, np.concatenate([empty, *(n for _, _, n in self.found)]), len(pairs))
        sums = np.array([d.sums for d in self.documents], np.int64).reshape(-1, 4)
        ids, digests = [d.doc_id for d in self.documents], [d.groups_sha256() for d in self.documents]
        yield _block_row(block=block, seq=-1, doc_ids=ids, digests=digests, sums=sums.tobytes())
        at = 0
        for seq, (own, place, _) in enumerate(self.found):
            places = back[at : at + len(own)].astype("<u4")[place]
            at += len(own)
            yield _block_row(block=block, seq=seq, places=places.view(np.uint8).reshape(-1, 4).T.tobytes())
        for first in range(0, len(pairs), ROW_PAIRS):
            some = slice(first, first + ROW_PAIRS)
            yield _block_row(block=block, first=first, pairs=pairs[some], counts=counts[some].astype(np.int64))


_BLOCK = {
    "block": pa.int64(),
    "seq": pa.int32(),
    "doc_ids": pa.list_(pa.int64()),
    "digests": pa.list_(pa.string()),
    "sums": pa.binary(),
    "places": pa.binary(),
    "first": pa.int32(),
    "pairs": pa.list_(pa.int64()),
    "counts": pa.list_(pa.int64()),
}
BLOCKS = (
    "block bigint, seq int, doc_ids array<bigint>, digests array<string>, sums binary, "
    "places binary, first int, pairs array<bigint>, counts array<bigint>"
)


def _block_row(**values) -> pa.RecordBatch:
    columns = [pa.array([values.get(name)], kind) for name, kind in _BLOCK.items()]
    return pa.RecordBatch.from_arrays(columns, names=list(_BLOCK))


def _encoded(
    coder: Coder, batches: Iterator[pa.RecordBatch]
) -> Iterator[tuple[int | None, int, Iterator[tuple[bytes, bytes]]]]:
    """``doc_id``, bytes of text, and the ids of its pieces (none, if the text has no tokens)."""
    for batch in batches:
        for part in batch_slices(batch, "text"):
            doc_ids, texts = (c.to_pylist() for c in part.columns)
            short = [t for t in texts if t and len(t) <= PIECE_CHARS]
            ready = iter(coder.encode_many(short))
            for doc_id, text in zip(doc_ids, texts):
                if not text:
                    yield doc_id, 0, iter(())
                elif len(text) <= PIECE_CHARS:
                    ids = next(ready)
                    yield doc_id, len(text), iter(() if ids is None else (ids,))
                else:  # first whether every piece is spelt, then the pieces one by one
                    whole = all(coder.encode_many([p])[0] is not None for p in coder.pieces(text))
                    ids = (coder.encode_many([p])[0] for p in coder.pieces(text)) if whole else iter(())
                    yield doc_id, len(text), ids


def _blocks(documents: DataFrame, a_path: str, b_path: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        both = coder(a_path, b_path)
        tables = GroupTables(max(len(both.a_sizes), len(both.b_sizes)))
        block, waiting, tokens = _Block(), [], 0
        for doc_id, size, pieces in _encoded(both, batches):
            document = _Document(doc_id)
            block.documents.append(document)
            block.bytes += size
            for ids in pieces:
                waiting.append((document, ids))
                tokens += len(ids[0]) // 4
                if tokens > BATCH_TOKENS:
                    block.align(both, tables, waiting)
                    waiting, tokens = [], 0
            if block.bytes > BLOCK_BYTES:
                block.align(both, tables, waiting)
                yield from block.rows(number)
                block, waiting, tokens, number = _Block(), [], 0, number + 1
        if block.documents:
            block.align(both, tables, waiting)
            yield from block.rows(number)

    return documents.mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``block, place, pair, n`` of the distinct pairs of every block, and over all blocks
    ``pair, total, best``: the pair's links, and whether no pair with its B id has more."""
    listed = blocks.where("pairs IS NOT NULL")
    seen = listed.select("block", "first", F.posexplode(F.arrays_zip("pairs", "counts")).alias("at", "of"))
    seen = seen.selectExpr("block", "first + at AS place", "of.pairs AS pair", "of.counts AS n")
    totals = seen.groupBy("pair").agg(F.sum("n").alias("total"))
    totals = totals.withColumn("b", F.expr("pair & 4294967295L"))
    top = totals.groupBy("b").agg(F.max("total").alias("top"))
    facts = totals.join(top, "b").select("pair", "total", (F.col("total") == F.col("top")).alias("best"))
    return seen, facts


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        empty_if_null(F.col(f"`{text_col}`")).alias("text"),
    )


STATISTICS = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, "
    "count_sum bigint, groups_sha256 string"
)


def link_statistics(
    df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """STATISTICS of each row of ``df``: tokens, groups and links, and how its links stand in the
    whole corpus: ``n_best`` of them are the most frequent ones of their B id (ties included), and
    ``count_sum`` is the sum of their corpus counts.

    NULL and empty texts, and texts that B spells otherwise (those with U+2581), have no tokens:
    zeros and an empty ``groups_sha256``.  A very long text is encoded and aligned in pieces of
    PIECE_CHARS, cut where both tokenizers cut, and read whole.  Repeated rows and ids are rows of
    their own, each of them counted; other columns are not read; an empty table gives no rows.
    """
    blocks = stage(_blocks(_documents(df, id_col, text_col), a_path, b_path))
    seen, facts = pair_counts(blocks)
    answers = seen.join(facts, "pair").selectExpr("block AS of_block", "place", "total", "best")

    def finish(key, block: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("seq")
        row = block.iloc[0]
        order = found["place"].to_numpy().argsort()
        totals = found["total"].to_numpy(np.int64)[order]
        best = found["best"].to_numpy(bool)[order]
        planes = [np.frombuffer(p, np.uint8).reshape(4, -1).T for p in block["places"].iloc[1:]]
        places = np.concatenate([np.zeros(0, "<u4"), *(np.ascontiguousarray(p).view("<u4").ravel() for p in planes)])
        sums = np.frombuffer(row["sums"], np.int64).reshape(-1, 4)
        doc = np.repeat(np.arange(len(sums)), sums[:, 3])
        own_best = np.bincount(doc[best[places]], minlength=len(sums))
        before = np.concatenate([[0], np.cumsum(totals[places])])
        ends = np.cumsum(sums[:, 3])
        return pd.DataFrame(
            {
                "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"),
                **dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums.T)),
                "n_best": own_best,
                "count_sum": before[ends] - before[ends - sums[:, 3]],
                "groups_sha256": list(row["digests"]),
            }
        )

    own = blocks.where("seq IS NOT NULL").select("block", "seq", "doc_ids", "digests", "sums", "places")
    return own.groupBy("block").cogroup(answers.groupBy("of_block")).applyInPandas(finish, STATISTICS)


ALIGNED = (
    "doc_id bigint, a_ids array<int>, b_ids array<int>, link_a array<int>, link_b array<int>, "
    "group_a array<int>, group_b array<int>"
)


def align(
    df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """ALIGNED of each row: its ids by both tokenizers, the token numbers that every link joins, and
    for each group the number of A and B tokens up to its end.

    Rows are treated as in :func:`link_statistics`; a document without tokens has empty lists.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coder(a_path, b_path)
        types = [pa.int64(), *[pa.list_(pa.int32())] * 6]
        names = ["doc_id", "a_ids", "b_ids", "link_a", "link_b", "group_a", "group_b"]
        for doc_id, _, pieces in _encoded(both, batches):
            ids = list(pieces)
            whole = [(b"".join(a for a, _ in ids), b"".join(b for _, b in ids))]
            x = Alignment(both, whole)
            row = (doc_id, x.a, x.b, x.link_a, x.link_b, x.cut_a + 1, x.cut_b + 1)
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names=names)

    return _documents(df, id_col, text_col).mapInArrow(run, ALIGNED)
