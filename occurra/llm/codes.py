"""Compression of vectors to codes of one byte per part, by exact integer arithmetic.

Components become whole numbers and vectors are cut into equal parts.  The
parts of one place are sorted along a Hilbert curve within chunks of ``CHUNK``
numbers and cut into flat blocks of ``BLOCK``, each with the least box around
its parts and their sum.  In every round the distances from an entry to the
nearest and the farthest point of a block's box say which entries can be the
nearest of any part in it.  If one entry is left, the block counts with its sum
and its parts aren't looked at; else its parts are compared with the few that
are left, in whole numbers.

Chunks lie where their vectors do: a round shuffles sums by entry only, and
the codebooks are all that is sent to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.llm.common import cut, pick, prepare
from occurra.llm.hilbert import hilbert_index

SCALE = 256
PARTS, ENTRIES, ROUNDS = 16, 64, 2
CHUNK = 1 << 20  # numbers of the vectors that are sorted together
BLOCK = 32  # parts of a block
CELLS = 1 << 21  # numbers compared at once
LIMIT = 1 << 27  # whole numbers stay below, so that squared distances fit 64 bits
LABELS = 100_000  # sums by label that are broadcast at most

ROWS = "vec_id long, label long, whole binary"


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose vector has neither nulls nor non-finite components, as whole numbers."""
    for batch in batches:
        vectors = batch.column(2)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        here = np.flatnonzero(~np.isnan(sizes.astype(np.float64)))
        sizes = sizes[here].astype(np.int64)
        flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)  # null: not a number
        owner = np.repeat(np.arange(len(here)), sizes)
        fine = np.bincount(owner, ~np.isfinite(flat), len(here)) == 0
        flat, sizes, here = flat[fine[owner]], sizes[fine], here[fine]
        if (np.abs(flat) >= LIMIT).any():
            raise ValueError(f"components of {LIMIT // SCALE} and more have no exact code")
        raw, ends = flat.astype("<i4").tobytes(), np.cumsum(sizes) * 4
        raws = [raw[e - 4 * n : e] for e, n in zip(ends.tolist(), sizes.tolist())]
        rows = batch.take(pa.array(here))
        yield pa.record_batch([rows.column(0), rows.column(1), pa.array(raws, pa.binary())], names=["vec_id", "label", "whole"])


CHUNKS = "ids binary, known binary, labels binary, marked binary, part int, place binary, whole binary"


def curve_order(x: np.ndarray) -> np.ndarray:
    """The order of rows along a Hilbert curve; of many dimensions, the leading ones."""
    if not x.shape[1]:
        return np.arange(len(x))
    x = x[:, :31].astype(np.int64)
    bits = max(1, min(8, 62 // x.shape[1]))
    low, high = x.min(axis=0), x.max(axis=0)
    cells = (x - low) * ((1 << bits) - 1) // np.maximum(high - low, 1)
    return np.argsort(hilbert_index(cells, bits), kind="stable")


def _chunks(dims: int, parts: int, chunk: int):
    """A row per chunk and part: the parts in curve order with their rows' places; ids with the first part."""

    def out(ids: list, labels: list, raws: list[bytes]) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(raws), "<i4").reshape(len(raws), dims)
        pack = lambda v: (np.array([k or 0 for k in v], "<i8").tobytes(), np.array([k is not None for k in v]).tobytes())
        head, rows = (*pack(ids), *pack(labels)), []
        width = dims // parts
        for p in range(parts):
            sub = x[:, p * width : (p + 1) * width]
            order = curve_order(sub)
            rows.append((*(head if p == 0 else (None,) * 4), p, order.astype("<i4").tobytes(), sub[order].tobytes()))
        kinds = [pa.binary()] * 4 + [pa.int32()] + [pa.binary()] * 2
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                               names=[f.split(" ")[0] for f in CHUNKS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, raws = [], [], []
        for batch in batches:
            ids += batch.column(0).to_pylist()
            labels += batch.column(1).to_pylist()
            raws += batch.column(2).to_pylist()
            while len(raws) >= chunk:
                yield out(ids[:chunk], labels[:chunk], raws[:chunk])
                ids, labels, raws = ids[chunk:], labels[chunk:], raws[chunk:]
        if raws:
            yield out(ids, labels, raws)

    return run


@dataclass(frozen=True)
class Blocks:
    """The parts of one place in a chunk, in curve order: (blocks, BLOCK, width), the last row repeated to fill."""

    parts: np.ndarray
    sizes: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray) -> Blocks:
        n, blocks = len(x), -(-len(x) // BLOCK)
        full = np.concatenate([x, np.repeat(x[-1:], blocks * BLOCK - n, axis=0)]).astype(np.int64)
        full = full.reshape(blocks, BLOCK, x.shape[1])
        sizes = np.full(blocks, BLOCK)
        sizes[-1] = n - BLOCK * (blocks - 1)
        sums = full.sum(axis=1)
        sums[-1] -= (BLOCK - sizes[-1]) * full[-1, -1]
        return cls(full, sizes, full.min(axis=1), full.max(axis=1), sums)


def shortlists(blocks: Blocks, book: np.ndarray) -> np.ndarray:
    """Which entries can be the nearest (or tie) of any part of each block.

    An entry is out if a box's nearest point is farther from it than the
    farthest point from another one, or if every point of the box is nearer to
    the entry that has the least farthest point; both are exact.
    """
    out = np.empty((len(blocks.sizes), len(book)), bool)
    step = max(1, CELLS // max(1, book.size))
    for k in range(0, len(out), step):
        low, high = blocks.low[k : k + step, None, :], blocks.high[k : k + step, None, :]
        to_low, to_high = (low - book) ** 2, (high - book) ** 2
        far = np.maximum(to_low, to_high).sum(axis=2)
        near = (np.maximum(np.maximum(low - book, book - high), 0) ** 2).sum(axis=2)
        best = far.argmin(axis=1)[:, None, None]
        # the difference of two squared distances is least, axis by axis, at one end of the box
        gain = np.minimum(
            to_low - np.take_along_axis(to_low, best, axis=1), to_high - np.take_along_axis(to_high, best, axis=1)
        ).sum(axis=2)
        out[k : k + step] = (near <= far.min(axis=1, keepdims=True)) & (gain <= 0)
    return out


def compare(blocks: Blocks, book: np.ndarray, lists: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry (ties: the lower index) and squared distance of every part of the blocks ``at``."""
    entry = np.zeros((len(at), BLOCK), np.int64)
    error = np.zeros((len(at), BLOCK), np.int64)
    lengths = lists[at].sum(axis=1)
    for n in np.unique(lengths).tolist():
        same = np.flatnonzero(lengths == n)
        step = max(1, CELLS // (BLOCK * n))
        for k in range(0, len(same), step):
            mine = same[k : k + step]
            listed = np.nonzero(lists[at[mine]])[1].reshape(len(mine), n)  # in ascending order
            x, c = blocks.parts[at[mine]], book[listed]
            far = np.zeros((len(mine), BLOCK, n), np.int64)
            for d in range(x.shape[2]):
                far += (x[:, :, None, d] - c[:, None, :, d]) ** 2
            best = far.argmin(axis=2)
            entry[mine] = np.take_along_axis(listed, best, axis=1)
            error[mine] = np.take_along_axis(far, best[:, :, None], axis=2)[:, :, 0]
    return entry, error


def _sums(books: np.ndarray):
    """(part, entry, place, total) of a partition; place -1 has the number of parts."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            for p, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not width:
                    continue
                blocks = Blocks.of(np.frombuffer(raw, "<i4").reshape(-1, width))
                lists = shortlists(blocks, books[p])
                clear = lists.sum(axis=1) == 1
                only = lists[clear].argmax(axis=1)
                np.add.at(total[p], only, np.concatenate([blocks.sizes[clear, None], blocks.sums[clear]], axis=1))
                at = np.flatnonzero(~clear)
                entry, _ = compare(blocks, books[p], lists, at)
                real = np.arange(BLOCK) < blocks.sizes[at, None]
                x = blocks.parts[at][real]
                np.add.at(total[p], entry[real], np.concatenate([np.ones((len(x), 1), np.int64), x], axis=1))
        p, e, w = np.nonzero(total)
        yield pa.record_batch([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(w - 1, pa.int32()),
                               pa.array(total[p, e, w], pa.int64())], names=["part", "entry", "place", "total"])

    return run


def train(chunks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The codebooks after ``rounds`` rounds; each collects a sum per part, entry and place."""
    for _ in range(rounds):
        sums = chunks.select("part", "whole").mapInArrow(_sums(books), "part int, entry int, place int, total long")
        total = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
        for r in sums.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect():
            total[r["part"], r["entry"], r["place"] + 1] = r["total"]
        used = total[:, :, :1] > 0
        books = np.where(used, total[:, :, 1:] // np.maximum(total[:, :, :1], 1), books)
    return books


CODED = "vec_id long, label long, code string, error long"


def _encode(books: np.ndarray):
    """Rows of a chunk, once all its parts have come."""
    parts, _, width = books.shape

    def unpack(raw: bytes, known: bytes) -> pa.Array:
        return pa.array(np.frombuffer(raw, "<i8"), mask=~np.frombuffer(known, bool))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, known, labels, marked, p, place, raw in zip(*(batch.column(k).to_pylist() for k in range(7))):
                if p == 0:
                    vec_id, label = unpack(ids, known), unpack(labels, marked)
                    code, error = np.zeros((len(vec_id), parts), np.uint8), np.zeros(len(vec_id), np.int64)
                order = np.frombuffer(place, "<i4")
                if width:
                    blocks = Blocks.of(np.frombuffer(raw, "<i4").reshape(-1, width))
                    lists = shortlists(blocks, books[p])
                    entry, far = compare(blocks, books[p], lists, np.arange(len(lists)))
                    code[order, p] = entry.ravel()[: len(order)]
                    error[order] += far.ravel()[: len(order)]
                if p == parts - 1:
                    text = code.tobytes().hex()
                    step = 2 * parts
                    yield pa.record_batch(
                        [vec_id, label, pa.array([text[k : k + step] for k in range(0, len(text), step)], pa.string()),
                         pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def first_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray | None:
    """The parts of the ``entries`` smallest ids (nulls last; ties: the smaller bytes), as (part, entry, place)."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(entries).collect()
    if not first:
        return None
    dims = len(first[0]["whole"]) // 4
    if dims % parts:
        raise ValueError(f"{dims} dimensions can't be cut into {parts} equal parts")
    same = [np.frombuffer(r["whole"], "<i4") for r in first if len(r["whole"]) == 4 * dims]
    return np.stack(same).astype(np.int64).reshape(len(same), parts, dims // parts).transpose(1, 0, 2).copy()


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, chunk: int = CHUNK,
) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for every vector of finite components.

    Components x become floor(256 x).  Every part's codebook starts as that part
    of the vectors with the smallest ids and is trained for ``rounds`` rounds:
    parts go to the nearest entry, entries become the floor of their parts'
    mean, unused entries stay.  ``code`` has two hex digits a part, ``error`` is
    the sum of the squared distances, ``label_error`` the label's sum of these.

    Defined cases: rows whose vector is null or holds null or non-finite
    components are left out; null ids sort last and null labels are one label;
    rows with the same id are rows each, in the order of their numbers' bytes;
    fewer vectors than entries make smaller codebooks; vectors with another
    number of dimensions than the smallest id's keep their row with a null code
    and error; an empty table gives no rows; dimensions that ``parts`` doesn't
    divide, components of 2^19 and more and more than 256 entries raise an
    error; extra columns are left out.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    spark = vectors.sparkSession
    prepare(spark)
    rows = pick(vectors, vec_id=key, embedding=vector, label=label).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    )
    whole = cut(rows.mapInArrow(_whole, ROWS))
    books = first_books(whole, parts, entries)
    if books is None:
        return spark.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    size = 4 * books.shape[0] * books.shape[2]
    same = whole.where(F.octet_length("whole") == size)
    # a chunk's rows stay together and in order: nothing is dealt out again
    chunks = cut(same.mapInArrow(_chunks(size // 4, parts, max(BLOCK, chunk * 4 // max(4, size))), CHUNKS))
    books = train(chunks, books, rounds)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    other = whole.where(F.octet_length("whole") != size).select(
        "vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    coded = cut(chunks.mapInArrow(_encode(books), CODED).unionByName(other))
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    few = by_label.limit(LABELS + 1).count() <= LABELS
    sums = by_label.withColumnRenamed("label", "same")
    joined = coded.join(F.broadcast(sums) if few else sums, F.col("label").eqNullSafe(F.col("same")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
