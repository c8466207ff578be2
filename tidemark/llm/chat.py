"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole by a template, encoded once with offsets, and the sorted
spans of its turns are intersected with the sorted spans of its tokens by binary search:
a token is under the loss mask where it covers text of the assistant.

The template marks a turn by ``<|im_start|>role``, a line feed, the text, ``<|im_end|>`` and a
line feed.  Inside roles and texts ``<``, any number of backslashes and ``|`` get one more
backslash, so that no text holds a control string and every text can be read back.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"

LEARNED_ROLE = "assistant"
#: Characters after which a conversation is encoded on, at the next turn; the ids are the same.
BLOCK_CHARS = 1 << 18

_TO_ESCAPE = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*?)<\|im_end\|>\n", re.S)
_tokenizers: dict = {}


def escape(text: str) -> str:
    return _TO_ESCAPE.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line: a backslash is doubled, a line feed written as ``\\n``."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the spans of its texts, in characters."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape_role(role)}\n", escape(text)
        parts += [head, body, f"{END}\n"]
        spans.append((at + len(head), at + len(head) + len(body)))
        at = spans[-1][1] + len(END) + 1
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]


def load_tokenizer(path: str):
    """The tokenizer of a file with the control strings as special tokens."""
    if path not in _tokenizers:
        from tokenizers import AddedToken, Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        tokenizer = Tokenizer.from_file(path)
        tokenizer.add_special_tokens([AddedToken(t, normalized=False) for t in (START, END)])
        _tokenizers[path] = tokenizer
    return _tokenizers[path]


def loss_mask(
    offsets: np.ndarray, spans: list[tuple[int, int]]
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens cover learned text, and the stretches of text that they cover.

    ``offsets`` has a row with start and end for each token, in order, and ``spans`` are sorted
    and apart.  Tokens that share a character (its bytes being parted) give it once.
    """
    mask, covered = np.zeros(len(offsets), bool), []
    for start, end in spans:
        first = np.searchsorted(offsets[:, 1], start, "right")
        last = np.searchsorted(offsets[:, 0], end, "left")
        if first >= last or start == end:
            continue
        mask[first:last] = True
        inside = np.clip(offsets[first:last], start, end)
        low = int(inside[0, 0])
        high = low
        for a, b in inside.tolist():
            if a > high:
                covered.append((low, high))
                low = a
            high = max(high, b)
        covered.append((low, high))
    return mask, covered


FORMATTED = (
    "conv_id bigint, n_turns bigint, formatted string, ids array<int>, mask array<boolean>, "
    "learned string"
)


class Formatter:
    """One conversation at a time; its blocks of turns are encoded as they fill."""

    def __init__(self, tokenizer, learned_role: str):
        self.tokenizer, self.role = tokenizer, learned_role
        self.turns: list[tuple[str, str]] = []
        self.size, self.n = 0, 0
        self.texts: list[str] = []
        self.ids: list[np.ndarray] = []
        self.masks: list[np.ndarray] = []
        self.learned: list[str] = []

    def add(self, role: str, text: str) -> None:
        self.turns.append((role, text))
        self.n += 1
        self.size += len(text)
        if self.size > BLOCK_CHARS:
            self._encode()

    def _encode(self) -> None:
        formatted, spans = render(self.turns)
        wanted = [s for s, (role, _) in zip(spans, self.turns) if role == self.role]
        encoding = self.tokenizer.encode(formatted, add_special_tokens=False)
        offsets = np.array(encoding.offsets, np.int64).reshape(-1, 2)
        mask, covered = loss_mask(offsets, wanted)
        self.texts.append(formatted)
        self.ids.append(np.array(encoding.ids, np.int32))
        self.masks.append(mask)
        starts = np.searchsorted([a for a, _ in covered], [a for a, _ in wanted]).tolist()
        for first, last in zip(starts, [*starts[1:], len(covered)]):  # an escape lies within a turn
            self.learned.append(unescape("".join(formatted[a:b] for a, b in covered[first:last])))
        self.turns, self.size = [], 0

    def finish(self, conv_id: int | None) -> tuple:
        if self.turns:
            self._encode()
        return (
            conv_id,
            self.n,
            "".join(self.texts),
            np.concatenate(self.ids),
            np.concatenate(self.masks),
            "".join(self.learned),
        )


def format_conversations(
    turns: DataFrame,
    tokenizer_path: str,
    learned_role: str = LEARNED_ROLE,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """FORMATTED: the text of each conversation, its ids, its loss mask and the learned text.

    Turns are in the order of ``turn_col`` (NULL first), ties by role and text; NULL roles and texts
    are empty; a row with a NULL conversation is a conversation of its own, formatted where it
    lies.  Repeated rows are turns of their own.  Very long conversations are encoded whole, a
    block of turns at a time.  Other columns are not read; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(tokenizer_path)
        current, rows, size = None, [], 0
        open_: Formatter | None = None
        for batch in batches:
            for conv_id, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ is None or conv_id is None or conv_id != current:
                    if open_ is not None:
                        rows.append(open_.finish(current))
                        size += len(rows[-1][2])
                    current, open_ = conv_id, Formatter(tokenizer, learned_role)
                    if size > 1 << 20:
                        yield _rows(rows)
                        rows, size = [], 0
                open_.add(role, text)
        if open_ is not None:
            rows.append(open_.finish(current))
            yield _rows(rows)

    read = turns.select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    )
    n = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    together = (
        read.where("conv_id IS NOT NULL")
        .repartition(n, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    alone = read.where("conv_id IS NULL")  # a third of all rows may be; they need no shuffle
    columns = "conv_id", "role", "text"
    return together.select(*columns).mapInArrow(run, FORMATTED).unionByName(
        alone.select(*columns).mapInArrow(run, FORMATTED)
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.string()]
    names = ["conv_id", "n_turns", "formatted", "ids", "mask", "learned"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` with ``turns_sha256``: of role, line feed, text, line feed of every turn, as
    parsed from the formatted text."""

    @F.pandas_udf("string")
    def digest(texts):
        return texts.map(
            lambda t: hashlib.sha256(
                "".join(f"{role}\n{text}\n" for role, text in parse(t)).encode()
            ).hexdigest()
        )

    return formatted.withColumn("turns_sha256", digest("formatted"))
