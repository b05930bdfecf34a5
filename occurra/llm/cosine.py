"""Embedding near-duplicates by PCA-ordered tiled comparison.

Vectors are scaled to length one and rotated to the principal axes of all of
them, so leading dimensions carry most of every dot product.  Within a label,
vectors are sorted along the first axis and cut into tiles.  Two unit vectors
with cosine t differ by at most sqrt(2 - 2t) along any direction, so only tiles
whose ranges come that near on every kept axis meet.  Two tiles are compared a
block of dimensions at a time: the dot product so far plus the product of the
two suffix norms bounds the cosine from above, and pairs whose bound is below
the threshold are left behind.  Pairs that remain to the end are decided by the
cosine of the vectors as given, in double precision.

Bitwise equal vectors of a label are compared once.  Tiles are dealt out as
pairs of groups of ``GROUP`` tiles, so a tile travels once per group, not once
per partner, and a pair of tiles gives counts and a spanning forest of its
links, never the links themselves.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.llm.common import Forest, connected_components, cut, pick, prepare
from occurra.llm.ordering import numbered, ordered

TILE = 1024
GROUP = 16 * TILE  # vectors of neighbouring tiles that travel together
BLOCK = 16  # dimensions added between two looks at the bound
AXES = 8  # leading axes whose ranges are kept for every tile
SLACK = 1e-9  # above the rounding error of sums in another order

ROWS = "vec_id long, label long, raw binary"


def packed_vector(v: list) -> bytes | None:
    """A vector that can link as bytes: the width of its numbers, then these; negative zero as zero.

    Single precision if nothing is lost, else double.
    """
    if not v or any(x is None for x in v):
        return None
    x = np.array(v, np.float64) + 0.0
    if not np.isfinite(x).all() or not x.any():
        return None
    with np.errstate(over="ignore"):
        short = x.astype("<f4")
    return b"\x04" + short.tobytes() if (short == x).all() else b"\x08" + x.astype("<f8").tobytes()


def dims(raw: bytes) -> int:
    return (len(raw) - 1) // raw[0]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with its vector as bytes, null if it can't link."""
    for batch in batches:
        columns = (batch.column(i).to_pylist() for i in range(3))
        raws = [packed_vector(v) if i is not None and lab is not None else None for i, lab, v in zip(*columns)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(raws, pa.binary())],
                              names=["vec_id", "label", "raw"])


def unit(raw: bytes) -> np.ndarray:
    """The vector at length one; scaled first, so that squares can't overflow or vanish."""
    x = np.frombuffer(raw, f"<f{raw[0]}", offset=1).astype(np.float64)
    x = x / np.abs(x).max()
    return x / np.sqrt(x @ x)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's sum of outer products of unit vectors, by number of dimensions."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            x = unit(raw)
            if len(x) not in sums:
                sums[len(x)] = np.zeros((len(x), len(x)))
            sums[len(x)] += np.outer(x, x)
    yield pa.record_batch([pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                          names=["d", "m"])


def _add_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for d, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(m)
            sums[d] = sums[d] + part if d in sums else part
    yield pa.record_batch([pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())],
                          names=["d", "m"])


def axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes of all unit vectors, most important first, by number of dimensions."""
    part = vectors.select("raw").mapInArrow(_moments, "d long, m binary")
    rows = part.repartition(16).mapInArrow(_add_moments, "d long, m binary").collect()
    sums: dict[int, np.ndarray] = {}
    for r in rows:
        m = np.frombuffer(r["m"]).reshape(r["d"], r["d"])
        sums[r["d"]] = sums.get(r["d"], 0) + m
    return {d: np.linalg.eigh(m)[1][:, ::-1].copy() for d, m in sums.items()}


class Tile:
    """Unit vectors of a tile in the rotated space."""

    def __init__(self, raws: list[bytes], turn: np.ndarray) -> None:
        self.unit = np.stack([unit(r) for r in raws])
        self.turned = self.unit @ turn
        squares = np.cumsum(self.turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        self.suffix = np.sqrt(np.concatenate([squares, np.zeros((len(raws), 1))], axis=1))


def similar(a: Tile, b: Tile, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two tiles with cosine at the threshold or above."""
    dims = a.turned.shape[1]
    first = a.turned[:, :BLOCK] @ b.turned[:, :BLOCK].T
    at = min(BLOCK, dims)
    i, j = np.nonzero(first + np.outer(a.suffix[:, at], b.suffix[:, at]) >= threshold - SLACK)
    dot = first[i, j]
    while at < dims and len(i):
        end = min(at + BLOCK, dims)
        dot = dot + np.einsum("nd,nd->n", a.turned[i, at:end], b.turned[j, at:end])
        at = end
        stay = dot + a.suffix[i, at] * b.suffix[j, at] >= threshold - SLACK
        i, j, dot = i[stay], j[stay], dot[stay]
    exact = np.einsum("nd,nd->n", a.unit[i], b.unit[j]) >= threshold
    return i[exact], j[exact]


TILES = "label long, d long, team long, run long, cls binary, copies binary, raws binary, lo array<double>, hi array<double>"


def cut_bytes(raws: bytes, d: int) -> list[bytes]:
    """Packed vectors of ``d`` dimensions, one after another."""
    out, at = [], 0
    while at < len(raws):
        end = at + 1 + raws[at] * d
        out.append(raws[at:end])
        at = end
    return out


def _tiles(turns: dict[int, np.ndarray]):
    """Runs of sorted rows as tiles with the ranges of their leading axes."""

    def out(label: int, d: int, rows: list[tuple]) -> pa.RecordBatch:
        raws, cls, copies, rn = zip(*rows)
        lead = np.stack([unit(r) for r in raws]) @ turns[d][:, :AXES]
        pack = lambda v: np.array(v, "<i8").tobytes()
        cells = (label, d, rn[0] // GROUP, rn[0], pack(cls), pack(copies), b"".join(raws),
                 lead.min(axis=0).tolist(), lead.max(axis=0).tolist())
        kinds = [pa.int64()] * 4 + [pa.binary()] * 3 + [pa.list_(pa.float64())] * 2
        return pa.record_batch([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split(" ")[0] for f in TILES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            for label, d, *row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                key = (label, d, row[3] // GROUP)
                if rows and (key != now or len(rows) == TILE):
                    yield out(*now[:2], rows)
                    rows = []
                now = key
                rows.append(tuple(row))
        if rows:
            yield out(*now[:2], rows)

    return run


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors link when their labels are equal and not null, they have equally
    many dimensions, and their cosine in double precision is at least
    ``threshold`` (above 0).  Classes of equal vectors are 64-bit hashes; two
    different ones are taken as equal with a chance of 2^-64 a pair.

    Defined cases: null or empty vectors, zero vectors, and those with null or
    non-finite components, a null label or a null id link with nothing.  Rows, not
    ids, are what links: rows with one id and other vectors or labels have links
    and components of their own, and equal rows count as each other's links and
    have one component.  An empty table gives no rows; extra columns are left
    out.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = pick(vectors, vec_id=key, embedding=vector, label=label).select(
        F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>")
    )
    packed = rows.mapInArrow(_packed, ROWS).withColumn("cls", F.when(F.col("raw").isNotNull(), F.xxhash64("label", "raw")))
    packed = cut(packed)
    valid = packed.where("raw is not null")
    # equal vectors of a label are one class, whatever ids they have; it carries their number
    classes = cut(valid.groupBy("cls").agg(
        F.first("label").alias("label"), F.first("raw").alias("raw"), F.min("vec_id").alias("least"), F.count("*").alias("copies")
    ))
    turns = axes(classes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raws = batch.column(1).to_pylist()
            lead = [unit(r) @ turns[dims(r)][:, 0] for r in raws]
            yield pa.record_batch([batch.column(0), pa.array([dims(r) for r in raws], pa.int64()), *batch.columns[1:],
                                   pa.array(lead, pa.float64())], names=["label", "d", "raw", "cls", "copies", "x"])

    placed = classes.select("label", "raw", "cls", "copies").mapInArrow(
        place, "label long, d long, raw binary, cls long, copies long, x double")
    # tiles: runs of the order (label, dimensions, first axis); a tile has one label and lies in one group
    sorted_rows, _, _ = numbered(ordered(placed, ["label", "d", "x", "cls"]))
    tiles = cut(sorted_rows.select("label", "d", "raw", "cls", "copies", "rn").mapInArrow(_tiles(turns), TILES))
    ends = [F.min(F.get("lo", F.lit(i))).alias(f"lo{i}") for i in range(AXES)]
    ends += [F.max(F.get("hi", F.lit(i))).alias(f"hi{i}") for i in range(AXES)]
    boxes = tiles.groupBy("label", "d", "team").agg(*ends)
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK)
    a, b = boxes.alias("a"), boxes.alias("b")
    apart = F.lit(False)
    for i in range(AXES):
        gap = F.greatest(F.col(f"a.lo{i}") - F.col(f"b.hi{i}"), F.col(f"b.lo{i}") - F.col(f"a.hi{i}"))
        apart = apart | F.coalesce(gap > reach, F.lit(False))
    same = (F.col("a.label") == F.col("b.label")) & (F.col("a.d") == F.col("b.d")) & (F.col("a.team") <= F.col("b.team"))
    pairs = cut(a.join(b, same & ~apart).select("a.label", "a.d", "a.team", F.col("b.team").alias("other")))
    mine = pairs.join(tiles, ["label", "d", "team"]).withColumn("side", F.lit(0))
    theirs = pairs.where("team <> other").join(
        tiles.withColumnRenamed("team", "other"), ["label", "d", "other"]).withColumn("side", F.lit(1))
    keys = ["label", "d", "team", "other"]
    met = mine.unionByName(theirs).select(*keys, "side", "run", "cls", "copies", "raws", "lo", "hi")
    met = met.repartition(*keys).sortWithinPartitions(*keys, "side", "run")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, links, forest = None, [], {}, Forest()

        def meet(one: tuple, two: tuple) -> None:
            (cls_a, n_a, ta, low_a, high_a), (cls_b, n_b, tb, low_b, high_b) = one, two
            if (np.maximum(low_a - high_b, low_b - high_a) > reach).any():
                return
            for i, j in zip(*(x.tolist() for x in similar(ta, tb, threshold))):
                if one is two and i >= j:
                    continue
                p, q = cls_a[i], cls_b[j]
                links[p] = links.get(p, 0) + n_b[j]
                links[q] = links.get(q, 0) + n_a[i]
                forest.join(p, q)

        def out() -> pa.RecordBatch:
            stars, ids = dict(forest.stars()), list(links)
            return pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array([links[i] for i in ids], pa.int64()),
                 pa.array([stars.get(i, i) for i in ids], pa.int64())], names=["cls", "links", "root"])

        for batch in batches:
            for row in range(batch.num_rows):
                *key, side, _, cls, copies, raws, low, high = (c[row].as_py() for c in batch.columns)
                if key != now:
                    yield out()
                    now, held, links, forest = key, [], {}, Forest()
                vectors = cut_bytes(raws, key[1])
                tile = (np.frombuffer(cls, "<i8").tolist(), np.frombuffer(copies, "<i8").tolist(),
                        Tile(vectors, turns[key[1]]), np.array(low), np.array(high))
                # a group meets itself as its tiles come; another group's tiles meet it one by one
                if side == 0:
                    held.append(tile)
                if side == 1 or key[2] == key[3]:
                    for other in held:
                        meet(other, tile)
        yield out()

    found = cut(met.mapInArrow(compare, "cls long, links long, root long"))
    counts = found.groupBy("cls").agg(F.sum("links").alias("links"))
    linked = connected_components(found.select("cls", "root")).toDF("cls", "component")
    joined = classes.select("cls", "copies", "least").join(counts, "cls", "left").join(linked, "cls", "left")
    joined = cut(joined.select(
        "cls", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("component", "cls").alias("component"), "least",
    ))
    # a component's number is the smallest id of its vectors
    named = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    per_class = joined.join(named, "component").select("cls", "n_links", "component_id")
    members = valid.select("vec_id", "cls").join(per_class, "cls").select("vec_id", "n_links", "component_id")
    alone = packed.where("raw is null").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return members.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
