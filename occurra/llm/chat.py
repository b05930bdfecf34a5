"""Chat formatting at token level.

A turn is ``<|im_start|>role\\n text <|im_end|>\\n``.  The marks are reserved
ids beyond the vocabulary, spliced between segments that are encoded each for
itself, so no text can make a mark.  For the rendered string, control strings
inside texts are escaped: ``<|`` gets a backslash after ``<`` (and ``<\\|`` one
more), which is undone by removing one.  The loss mask is the prefix sum of +1
where an assistant's text begins and -1 where it ends.

Turns are encoded where they are read.  Only then are they dealt out by
conversation and sorted, and a conversation is assembled as a stream, turn by
turn, so one of any length needs no more memory than its longest turn.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.llm.common import pick, prepare
from occurra.llm.tokens import ByteBPE, byte_bpe, default_path

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

_OPEN = re.compile(r"<(\\*)\|")
_SHUT = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """``text`` without any control string."""
    return _OPEN.sub(r"<\1\\|", text)


def unescape(text: str) -> str:
    """Undoes :func:`escape`."""
    return _SHUT.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role on one line."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def encode_turn(bpe: ByteBPE, role: str, text: str) -> tuple[bytes, bytes]:
    """Ids and loss mask (a byte per id) of one turn."""
    start, end = bpe.size, bpe.size + 1
    head, body = bpe.ids(escape_role(role) + "\n", False), bpe.ids(escape(text), False)
    parts = [np.array([start], np.uint32), head, body, np.array([end], np.uint32), bpe.ids("\n", False)]
    ends = np.cumsum([len(p) for p in parts])
    step = np.zeros(ends[-1] + 1, np.int8)
    if role == LOSS_ROLE:
        step[ends[1]] += 1
        step[ends[2]] -= 1
    return np.concatenate(parts).astype("<u4").tobytes(), np.cumsum(step[:-1], dtype=np.int8).tobytes()


TURNS = "conv_id long, turn long, ids binary, mask binary"
FORMATTED = "conv_id long, position long, token_start long, ids binary, mask binary"


def format_chat(turns: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Formatted turns: (conv_id, position, token_start, ids, mask).

    ``ids`` are little-endian unsigned 32-bit; ``mask`` has a byte per id, 1 for
    loss.  ``token_start`` is the number of the conversation's ids before the
    turn, so a conversation is its turns' ids in order of ``position``.

    Defined cases: a null text or role is empty; a null conv_id is a
    conversation of its own; turns are ordered by ``turn`` (null first), equal
    ones by their ids; equal rows all stay; an empty table gives no rows; texts
    of any length are kept whole; extra columns are left out.
    """
    spark = turns.sparkSession
    prepare(spark)
    path = tokenizer or default_path("byte_bpe_50k.json")
    rows = pick(turns, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        for batch in batches:
            got = [encode_turn(bpe, r or "", t or "") for r, t in zip(*(batch.column(i).to_pylist() for i in (2, 3)))]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array([g[0] for g in got], pa.binary()),
                 pa.array([g[1] for g in got], pa.binary())], names=["conv_id", "turn", "ids", "mask"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, position, tokens = object(), 0, 0
        for batch in batches:
            positions, starts = [], []
            for conv, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if conv != now:
                    now, position, tokens = conv, 0, 0
                positions.append(position)
                starts.append(tokens)
                position += 1
                tokens += len(ids) // 4
            yield pa.record_batch(
                [batch.column(0), pa.array(positions, pa.int64()), pa.array(starts, pa.int64()),
                 batch.column(2), batch.column(3)],
                names=["conv_id", "position", "token_start", "ids", "mask"])

    dealt = rows.mapInArrow(encode, TURNS).repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "turn", "ids", "mask").mapInArrow(place, FORMATTED)


class Reader:
    """Reads one conversation back from its formatted turns."""

    def __init__(self, bpe: ByteBPE) -> None:
        self.bpe, self.n, self.chars, self.loss_chars = bpe, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def turn(self, ids: bytes, mask: bytes) -> None:
        start, end = self.bpe.size, self.bpe.size + 1
        arr, on = np.frombuffer(ids, "<u4"), np.frombuffer(mask, np.int8)
        if arr[0] != start or arr[-2] != end:
            raise ValueError("not a formatted turn")
        body = self.bpe.decode(arr[1:-2].tolist()).decode()
        tail = self.bpe.decode(arr[-1:].tolist()).decode()
        role, text = body.split("\n", 1)
        self.n += 1
        self.chars += len(START) + len(body) + len(END) + len(tail)
        self.turns.update((unescape_role(role) + "\n" + unescape(text) + "\n").encode())
        if on.any():
            said = unescape(self.bpe.decode(arr[on == 1].tolist()).decode())
            self.loss_chars += len(said)
            self.loss.update(said.encode())

    def row(self) -> tuple:
        return self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")


def read_back(formatted: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """A row per conversation with what its formatted turns say.

    ``formatted`` comes straight from :func:`format_chat`: a conversation's
    turns lie together and in order.
    """
    path = tokenizer or default_path("byte_bpe_50k.json")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, reader, now = byte_bpe(path), None, None

        def batch_of(rows):
            cols = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            names = [f.split(" ")[0] for f in DIGESTS.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        for batch in batches:
            done = []
            for conv, position, ids, mask in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3, 4))):
                if position == 0:
                    if reader:
                        done.append((now, *reader.row()))
                    reader, now = Reader(bpe), conv
                reader.turn(ids, mask)
            yield batch_of(done)
        if reader:
            yield batch_of([(now, *reader.row())])

    return formatted.mapInArrow(read, DIGESTS)
