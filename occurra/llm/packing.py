"""Vector bin packing of token pieces under simultaneous limits.

A piece is the vector (tokens, 1 segment, loss-bearing tokens).  The open
sequence takes the piece whose vector has the largest dot product with what is
left of its limits (each dimension over its limit), among those that fit; when
none fits whole, the best one is cut to fill the rest.  A sequence that can't be
filled (few pieces left, or its segments used up) is cut back to a power of two,
which needs no padding, and what was cut off goes back to the pool.

Every task packs its own rows in a pool of bounded size, so there is no shuffle
and no group that grows with the data; sequence ids hold the task's partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.llm.common import pick, prepare
from occurra.llm.tokens import byte_bpe, default_path

END_ID = 1
SCHEMA = (
    "doc_id long, start long, length long, ids binary, loss long, doc_tokens long, sequence_id long, offset long"
)


class Packer:
    """One task's pool of pieces; ``add`` items, ``rows`` come out."""

    def __init__(self, first: int, tokens: int, segments: int, loss: int, pool: int) -> None:
        self.limits = np.array([tokens, segments, loss], np.float64)
        self.tokens, self.pool = tokens, pool
        self.next_id, self.docs, self.left = first, {}, {}
        self.key = 0
        self.vec = np.zeros((3 * pool + 64, 3))
        self.info: list = [None] * len(self.vec)  # (document key, start)
        self.n = 0
        self.out: list[tuple] = []

    def loss(self, key: int, start: int, length: int) -> int:
        return max(0, start + length - max(start, self.docs[key][2]))

    def put(self, key: int, start: int, length: int) -> None:
        if self.n == len(self.vec):
            self.vec = np.vstack([self.vec, np.zeros_like(self.vec)])
            self.info += [None] * len(self.info)
        self.vec[self.n] = (length, 1, self.loss(key, start, length))
        self.info[self.n] = (key, start)
        self.n += 1

    def take(self, i: int) -> tuple[int, int, int]:
        key, start = self.info[i]
        length = int(self.vec[i, 0])
        self.n -= 1
        self.vec[i], self.info[i] = self.vec[self.n], self.info[self.n]
        return key, start, length

    def add(self, doc_id, ids: np.ndarray, prompt: int = 0) -> None:
        """The item's ids; the first ``prompt`` of them bear no loss."""
        if not len(ids):
            return
        self.docs[self.key] = (doc_id, ids, prompt)
        self.left[self.key] = len(ids)
        start, whole = 0, self.tokens
        if self.limits[1] >= 1 and self.limits[2] >= whole:
            while len(ids) - start >= whole:  # fills a sequence alone
                self.emit([(self.key, start, whole)])
                start += whole
        if start < len(ids):
            self.put(self.key, start, len(ids) - start)
        self.key += 1
        while self.n >= 2 * self.pool:
            self.fill()

    def emit(self, pieces: list[tuple[int, int, int]]) -> None:
        offset = 0
        for key, start, length in pieces:
            doc_id, ids, _ = self.docs[key]
            self.out.append((doc_id, start, length, ids[start : start + length].tobytes(),
                             self.loss(key, start, length), len(ids), self.next_id, offset))
            offset += length
            self.left[key] -= length
            if not self.left[key]:
                del self.docs[key], self.left[key]
        self.next_id += 1

    def fill(self) -> None:
        """Pack one sequence from the pool."""
        rest, pieces, used = self.limits.copy(), [], 0
        while self.n and rest[0] >= 1 and rest[1] >= 1:
            vec = self.vec[: self.n]
            score = (vec / self.limits) @ (rest / self.limits)
            fits = (vec <= rest).all(axis=1)
            if fits.any():
                i = int(np.argmax(np.where(fits, score, -1.0)))
                key, start, length = self.take(i)
            else:
                i = int(np.argmax(score))
                key, start, length = self.take(i)
                part = self.cut(key, start, length, int(rest[0]), int(rest[2]))
                if part < length:
                    self.put(key, start + part, length - part)
                if not part:
                    break  # no loss-bearing token fits any more
                length = part
            pieces.append((key, start, length))
            rest -= (length, 1, self.loss(key, start, length))
            used += length
        keep = self.tokens if used == self.tokens else 1 << (used.bit_length() - 1)
        while used > keep:
            key, start, length = pieces.pop()
            back = min(length, used - keep)
            self.put(key, start + length - back, back)
            if length > back:
                pieces.append((key, start, length - back))
            used -= back
        self.emit(pieces)

    def cut(self, key: int, start: int, length: int, tokens: int, loss: int) -> int:
        """How much of a piece fits into so many tokens and loss-bearing tokens."""
        free = max(0, self.docs[key][2] - start)  # leading tokens without loss
        return min(length, tokens, free + loss)

    def finish(self) -> None:
        while self.n:
            self.fill()

    def rows(self) -> pa.RecordBatch:
        cols = list(zip(*self.out)) or [()] * 8
        self.out = []
        kinds = [pa.int64()] * 3 + [pa.binary()] + [pa.int64()] * 4
        names = [f.split(" ")[0] for f in SCHEMA.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def pack(
    items: DataFrame,
    tokenizer: str | None = None,
    tokens: int = 2048,
    segments: int = 128,
    loss: int | None = None,
    pool: int = 512,
    end_id: int | None = END_ID,
    key: str = "doc_id",
    text: str = "text",
    prompt: str | None = None,
) -> DataFrame:
    """Pieces of the items' ids, packed into sequences of at most ``tokens``.

    ``items`` has an id, a text and, for instruction data, a ``prompt`` text
    that comes before it and bears no loss.  ``segments`` and ``loss`` (default:
    as ``tokens``) limit a sequence too; all limits are at least 1.

    Defined cases: a null text is empty and still has its end id; a null id
    stays null; equal rows are packed each for itself; very long texts are cut
    over many sequences; an empty table gives no rows; extra columns are left
    out.  Without an end id, an empty text has no piece.
    """
    if min(tokens, segments, pool) < 1 or (loss is not None and loss < 1):
        raise ValueError("limits must be at least 1")
    prepare(items.sparkSession)
    path = tokenizer or default_path("byte_bpe_50k.json")
    most_loss = tokens if loss is None else loss
    wanted = {"doc_id": key, "text": text} | ({"prompt": prompt} if prompt else {})
    rows = pick(items, **wanted).withColumn("doc_id", F.col("doc_id").cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(path)
        packer = Packer(TaskContext.get().partitionId() << 40, tokens, segments, most_loss, pool)
        end = np.array([] if end_id is None else [end_id], np.uint32)
        for batch in batches:
            heads = batch.column(2).to_pylist() if prompt else [""] * batch.num_rows
            for doc_id, body, head in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), heads):
                lead = bpe.ids(head) if head else end[:0]
                packer.add(doc_id, np.concatenate([lead, bpe.ids(body or ""), end]), len(lead))
                if len(packer.out) >= 1000:
                    yield packer.rows()
            yield packer.rows()
        packer.finish()
        yield packer.rows()

    return rows.mapInArrow(run, SCHEMA)
