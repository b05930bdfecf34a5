"""Exact Jaccard similarity join of word-shingle sets by pivots.

Sets under the Jaccard distance are a metric space, and so are they under the
size of the symmetric difference.  The join narrows regions down in three steps,
none of which can lose a pair within the radius:

1. Every single shingle is a pivot.  In a fixed global order of shingles (those
   in crowded cells of a corpus-wide count sketch last), two sets within the
   radius share one of the first ``n - ceil(t*n) + 1`` shingles of each, so a
   set is replicated to the regions of just these.
2. Within such a region every set has its distances to the empty set in K
   disjoint subspaces of the shingle universe, a pivot table.  By the triangle
   inequality the sum of their differences can't exceed the symmetric
   difference, so only sets within that window stay neighbours.  What hangs
   together becomes one region with its whole sets; every set lies in one.
3. A region is joined exactly: sets in a pivot's ball are linked to it, each set
   goes to the Voronoi cell of its nearest pivot and, as a boundary copy, to all
   cells whose pivot is at most two radii farther; cells are joined recursively,
   and small ones pair by pair within the windows of all pivot distances.

Equal sets are one class and are joined once.  All lists that grow with the
data stay in Spark; the sketches that reach the driver have a fixed size.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from occurra.llm.common import (
    Forest, connected_components, cut, mix64, place_of, positional, prepare, texts,
)
from occurra.llm.wordhash import PIECE, hash_words, long_words

WORDS = 5
#: Similarity of linked documents, in hundredths.
PERCENT = 80

CELL_BITS = 20  # cells of the count sketches
BLOCK_BITS = 14  # cells in one row of a sketch
REMEMBERED = 500_000  # classes a task remembers to have written
LONG = 1 << 20  # rows of a region that a task waits for
RUN = 4096  # sets of one step-1 region in a task
ROUNDS = 4  # pivots that thin out larger ones before they are tiled
REGION = 4 << 20  # shingles of one step-2 region in a task
BROADCAST = 10_000  # large groups that are broadcast at most
PIVOTS = 8
SMALL = 48
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)

def _shingles(words: np.ndarray) -> np.ndarray:
    """The sorted distinct shingles of a document's word hashes."""
    k = min(WORDS, len(words))
    if not k:
        return words
    n = len(words) - k + 1
    h = words[:n].copy()
    for i in range(1, k):
        h = (h ^ (h >> np.uint64(29))) * _STEP + words[i : i + n]
    return np.unique(mix64(h + np.uint64(k)))


def shingle_sets(raws: list[str | None]) -> Iterator[np.ndarray]:
    """Each text's shingle set, sorted."""
    lowered = [(t or "").encode("utf-8", "surrogatepass").lower() for t in raws]
    i = 0
    while i < len(lowered):
        j, size = i, 0
        while j < len(lowered) and (j == i or size + len(lowered[j]) < PIECE):
            size += len(lowered[j]) + 1
            j += 1
        if size > PIECE:
            yield _shingles(long_words(lowered[i]))
        else:
            words, starts = hash_words(b"\n".join(lowered[i:j]))
            ends = np.cumsum([len(x) + 1 for x in lowered[i:j]])
            bounds = np.searchsorted(starts, np.concatenate([[0], ends]))
            for a, b in zip(bounds[:-1], bounds[1:]):
                yield _shingles(words[a:b])
        i = j


def class_of(s: np.ndarray) -> int | None:
    """The id of a set's class (equal sets), None for the empty set."""
    if not len(s):
        return None
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix(s: np.ndarray, crowded: np.ndarray) -> np.ndarray:
    """The first shingles in the global order that a linked set must share one of."""
    last = crowded[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
    keep = len(s) - -(-PERCENT * len(s) // 100) + 1
    return np.concatenate([s[~last], s[last]])[:keep]


def profile(s: np.ndarray) -> np.ndarray:
    """How many shingles lie in each of K subspaces; K a power of two of an eighth of n at least.

    Empty, and then no window at all, if a subspace holds more than 255.
    """
    k = 1 << max(5, min(14, int(np.ceil(np.log2(max(1, len(s) / 8))))))
    counts = np.bincount((s & np.uint64(k - 1)).astype(np.int64), minlength=k)
    return counts.astype(np.uint8) if counts.max() < 256 else np.zeros(0, np.uint8)


# -- count sketches -------------------------------------------------------------------------


def _blocks(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    size = 1 << BLOCK_BITS
    for b in range(len(cells) // size):
        part = cells[b * size : (b + 1) * size]
        if part.any():
            yield b, zlib.compress(part.astype("<i8").tobytes(), 1)


def _add_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            part = np.frombuffer(zlib.decompress(raw), "<i8")
            sums[b] = sums[b] + part if b in sums else part
    yield pa.record_batch(
        [pa.array(list(sums), pa.int32()), pa.array([zlib.compress(v.tobytes(), 1) for v in sums.values()], pa.binary())],
        names=["block", "cells"],
    )


def sum_blocks(blocks: DataFrame) -> np.ndarray:
    """The sum of sketches given as (block, cells); its size is fixed, whatever the data."""
    kind, fan = "block int, cells binary", 1 << CELL_BITS - BLOCK_BITS
    part = blocks.repartition(fan).mapInArrow(_add_blocks, kind)
    rows = part.repartition(fan, "block").mapInArrow(_add_blocks, kind).collect()
    out = np.zeros(1 << CELL_BITS, np.int64)
    for r in rows:
        out[r["block"] << BLOCK_BITS : r["block"] + 1 << BLOCK_BITS] += np.frombuffer(zlib.decompress(r["cells"]), "<i8")
    return out


def crowded_cells(counts: np.ndarray) -> np.ndarray:
    """Cells far above the median; any choice gives an exact join, this one small regions."""
    middle = float(np.median(counts))
    return counts > middle + 8 * np.sqrt(middle + 1)


# -- step 1: signatures, regions of shingles ------------------------------------------------

SIGNED = "doc_id long, said long, n long, cls long, profile binary, block int, cells binary"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(1 << CELL_BITS, np.int64)

    def out(ids, said, n, cls, prof, block, raw):
        kinds = [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.binary()]
        names = [f.split(" ")[0] for f in SIGNED.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip((ids, said, n, cls, prof, block, raw), kinds)], names=names)

    for batch in batches:
        sets = list(shingle_sets(batch.column(1).to_pylist()))
        if sets:
            everything = np.concatenate(sets)
            cells += np.bincount((everything >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
        none = [None] * len(sets)
        yield out(batch.column(0).to_pylist(), batch.column(2).to_pylist(), [len(s) for s in sets], [class_of(s) for s in sets],
                  [profile(s).tobytes() for s in sets], none, none)
    held = list(_blocks(cells))
    none = [None] * len(held)
    yield out(none, none, none, none, none, [b for b, _ in held], [c for _, c in held])


def _post(crowded: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = np.unpackbits(np.frombuffer(crowded, np.uint8)).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            keys, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for s in shingle_sets(batch.column(0).to_pylist()):
                cls = class_of(s)
                if cls is None or cls in seen:
                    continue
                seen.add(cls)
                keys.append(prefix(s, last))
                owners.append(np.full(len(keys[-1]), cls))
            if len(seen) > REMEMBERED:
                seen = set()
            h, c = np.concatenate(keys).view(np.int64), np.concatenate(owners)
            for i in range(0, len(h), 1 << 16):
                yield pa.record_batch([pa.array(h[i : i + (1 << 16)]), pa.array(c[i : i + (1 << 16)])], names=["h", "cls"])

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (h, cls): (run, cls) for every ``h`` with two classes at least.

    ``run`` is a hash of the set of classes, so regions of the same sets, as
    near copies and shared passages make them by the dozen, become one.  A run
    too long to wait for its end keeps a hash of its ``h``.
    """
    held_h, held_c = np.zeros(0, np.int64), np.zeros(0, np.int64)  # the last run, or its last row
    long = False  # the last run's rows before are written already

    def out(run, c):
        return pa.record_batch([pa.array(run.view(np.int64)), pa.array(c)], names=["run", "cls"])

    def alone(h):
        return mix64(mix64(h.view(np.uint64)) + _STEP)

    for batch in batches:
        h = np.concatenate([held_h, batch.column(0).to_numpy()])
        c = np.concatenate([held_c, batch.column(1).to_numpy()])
        if not len(h):
            continue
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        h, c = h[new], c[new]
        starts = np.concatenate([[0], np.flatnonzero(h[1:] != h[:-1]) + 1])
        last = starts[-1]
        if last:  # all runs but the last are complete
            sizes = np.diff(starts)
            sums = np.add.reduceat(mix64(c[:last].view(np.uint64)), starts[:-1])
            runs = mix64(sums + sizes.astype(np.uint64) * _STEP)
            keep = sizes > 1
            if long:
                runs[0], keep[0] = alone(h[:1])[0], True
            rows = np.repeat(keep, sizes)
            yield out(np.repeat(runs, sizes)[rows], c[:last][rows])
            long = False
        held_h, held_c = h[last:], c[last:]
        if len(held_h) > LONG:
            yield out(alone(held_h[:-1]), held_c[:-1])
            held_h, held_c, long = held_h[-1:], held_c[-1:], True
    if long:
        yield out(alone(held_h), held_c)
    elif len(held_h) > 1:
        total = np.add.reduce(mix64(held_c.view(np.uint64)), dtype=np.uint64)
        run = mix64(np.array([total]) + np.uint64(len(held_c)) * _STEP)
        yield out(np.repeat(run, len(held_c)), held_c)


# -- step 2: windows of the pivot table -----------------------------------------------------


def _gaps(rows: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Sums of the differences of profiles, those of more subspaces folded; 0 without a profile."""
    k = min(rows.shape[1], len(mine))
    if not k:
        return np.zeros(len(rows), np.int64)
    mine, out = mine.reshape(-1, k).sum(axis=0, dtype=np.int32), []
    step = max(1, (4 << 20) // rows.shape[1])  # bounds what is unpacked at once
    for a in range(0, len(rows), step):
        folded = rows[a : a + step].reshape(-1, rows.shape[1] // k, k).sum(axis=1, dtype=np.int32)
        out.append(np.abs(folded - mine).sum(axis=1))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _window(
    forest: Forest, cls: list[int], comp: list[int], n: np.ndarray, profiles: list[bytes]
) -> Iterator[tuple[int, int]]:
    """Links that hold a region's neighbours together, unless the forest has them.

    Sets of one ``comp`` are linked already and needn't meet.
    """
    roots: dict[int, int] = {}
    order = np.argsort(n, kind="stable")
    n, cls, comp = n[order], [cls[i] for i in order], np.array(comp)[order]
    tree = np.array([roots.setdefault(forest.root(c), len(roots)) for c in cls])
    if len(roots) == 1 or (comp == comp[0]).all():
        return
    vecs = [np.frombuffer(profiles[i], np.uint8) for i in order]
    upper = np.searchsorted(n, n * 100 // PERCENT, side="right")
    widths = np.array([len(v) for v in vecs])
    tables = {k: (np.flatnonzero(widths == k), np.stack([v for v in vecs if len(v) == k])) for k in set(widths.tolist())}
    for i in range(len(cls)):
        for at, rows in tables.values():
            lo, hi = np.searchsorted(at, [i + 1, upper[i]])
            rest = np.flatnonzero((tree[at[lo:hi]] != tree[i]) & (comp[at[lo:hi]] != comp[i])) + lo
            if not len(rest):
                continue
            near = _gaps(rows[rest], vecs[i])
            rest = at[rest]
            # within the radius the symmetric difference is at most (1-t)/(1+t) of both sizes
            for j in rest[near * (100 + PERCENT) <= (n[rest] + n[i]) * (100 - PERCENT)].tolist():
                if tree[j] != tree[i]:
                    forest.join(cls[i], cls[j])
                    tree[tree == tree[j]] = tree[i]
                    yield cls[i], cls[j]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (run, a, b): links between the neighbours of every region."""
    forest, now, rows = Forest(), None, []

    def flush():
        if len(rows) < 2:
            return []
        cls, comp, n, profiles = zip(*rows)
        return list(_window(forest, list(cls), list(comp), np.array(n), list(profiles)))

    for batch in batches:
        links = []
        for run, a, b, *row in zip(*(batch.column(i).to_pylist() for i in range(7))):
            if (run, a, b) != now:
                links += flush()
                now, rows = (run, a, b), []
            rows.append(row)
        if len(forest.up) > REMEMBERED:
            forest = Forest()
        yield pa.record_batch([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])
    links = flush()
    yield pa.record_batch([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])


def _tiled(rows: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """Rows with (a, b): groups that ``sizes`` splits into ``tiles`` are dealt out as all pairs of tiles.

    ``sizes`` has the large groups only; it is broadcast if it is small.
    """
    sizes = cut(sizes)
    few = sizes.limit(BROADCAST + 1).count() <= BROADCAST
    rows = rows.join(F.broadcast(sizes) if few else sizes, key, "left")
    tiles = F.coalesce("tiles", F.lit(1)).cast("int")
    own = F.pmod(F.xxhash64("cls"), tiles).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    return rows.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))


# -- step 3: pivots, Voronoi cells, windows -------------------------------------------------


class Region:
    """Whole sets of one region; ``links`` holds its components together."""

    def __init__(self, cls: list[int], sets: list[np.ndarray]) -> None:
        self.cls, self.sets = cls, sets
        self.n = np.array([len(s) for s in sets])
        self.forest, self.links = Forest(), []

    def common(self, i: int, rest: np.ndarray) -> np.ndarray:
        """Sizes of the intersections of set ``i`` with others."""
        flat = np.concatenate([self.sets[j] for j in rest])
        mine = self.sets[i]
        hit = mine[np.minimum(np.searchsorted(mine, flat), len(mine) - 1)] == flat
        ends = np.cumsum(self.n[rest])
        sums = np.concatenate([[0], np.cumsum(hit)])
        return sums[ends] - sums[ends - self.n[rest]]

    def compare(self, i: int, rest: np.ndarray) -> np.ndarray:
        """Distances from set ``i``; sets within the radius are linked."""
        both = self.common(i, rest)
        union = self.n[i] + self.n[rest] - both
        for j in rest[100 * both >= PERCENT * union]:
            if self.forest.root(int(j)) != self.forest.root(i):
                self.forest.join(i, int(j))
                self.links.append((self.cls[i], self.cls[int(j)]))
        return 1 - both / union

    def roots(self, at: np.ndarray) -> np.ndarray:
        return np.array([self.forest.root(int(i)) for i in at])

    def join(self, at: np.ndarray) -> None:
        radius = (100 - PERCENT) / 100 + 1e-9
        work = [at]
        while work:
            at = work.pop()
            if len(at) < 2:
                continue
            pivots = at[np.linspace(0, len(at) - 1, min(PIVOTS, len(at))).astype(int)]
            pivots = np.unique(pivots)
            far = np.stack([self.compare(int(p), at) for p in pivots], axis=1)
            if len(set(self.roots(at).tolist())) == 1:
                continue
            nearest = far.min(axis=1)
            cells = [at[far[:, j] <= nearest + 2 * radius] for j in range(len(pivots))] if len(at) > SMALL else []
            owned = far.argmin(axis=1)
            if cells and max(map(len, cells)) <= 0.7 * len(at):
                work += [c for j, c in enumerate(cells) if (owned == j).any()]
            else:
                self.windows(at, far, radius)

    def windows(self, at: np.ndarray, far: np.ndarray, radius: float) -> None:
        """Pairs whose distances to every pivot are within the radius of each other."""
        order = np.argsort(far[:, 0], kind="stable")
        at, far = at[order], far[order]
        upper = np.searchsorted(far[:, 0], far[:, 0] + radius, side="right")
        for i in range(len(at)):
            rest = np.arange(i + 1, upper[i])
            rest = rest[(np.abs(far[rest] - far[i]) <= radius).all(axis=1)]
            low, high = np.minimum(self.n[at[i]], self.n[at[rest]]), np.maximum(self.n[at[i]], self.n[at[rest]])
            rest = rest[100 * low >= PERCENT * high]
            if len(rest):
                rest = rest[self.roots(at[rest]) != self.forest.root(int(at[i]))]
            if len(rest):
                self.compare(int(at[i]), at[rest])


def _join_regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (region, a, b, cls, shingles) sorted by the first three: exact links."""
    now, cls, sets = None, [], []

    def flush():
        if len(cls) < 2:
            return []
        region = Region(cls, sets)
        region.join(np.arange(len(cls)))
        return region.links

    for batch in batches:
        links = []
        for r, a, b, c, raw in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (r, a, b) != now:
                links += flush()
                now, cls, sets = (r, a, b), [], []
            if not cls or cls[-1] != c:
                cls.append(c)
                sets.append(np.frombuffer(raw, "<u8"))
        yield pa.record_batch([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])
    links = flush()
    yield pa.record_batch([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], names=["u", "v"])


def _key(doc_id):
    return F.coalesce(doc_id, F.lit(-(2**63)))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cells = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        key = mix64(batch.column(0).to_numpy().view(np.uint64))
        cells[(key >> np.uint64(64 - CELL_BITS)).astype(np.int64)] = 1
    held = list(_blocks(cells))
    yield pa.record_batch(
        [pa.array([b for b, _ in held], pa.int32()), pa.array([c for _, c in held], pa.binary())],
        names=["block", "cells"],
    )


def _fetch(marks: bytes):
    """Whole sets of the documents whose key's cell is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        on = np.unpackbits(np.frombuffer(marks, np.uint8)).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            key = mix64(batch.column(0).to_numpy().view(np.uint64))
            hit = on[(key >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
            cls, raw = [], []
            for s in shingle_sets(batch.column(1).filter(pa.array(hit)).to_pylist()):
                c = class_of(s)
                if c is not None and c not in seen:
                    seen.add(c)
                    cls.append(c)
                    raw.append(s.tobytes())
            if len(seen) > REMEMBERED:
                seen = set()
            yield pa.record_batch([pa.array(cls, pa.int64()), pa.array(raw, pa.binary())], names=["cls", "shingles"])

    return run


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cls, pivot, far, linked) of rows (cls, pivot, and both sets)."""
    for batch in batches:
        far, linked = [], []
        for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
            both = len(np.intersect1d(a, b, assume_unique=True))
            union = len(a) + len(b) - both
            far.append(1 - both / union)
            linked.append(100 * both >= PERCENT * union)
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(far, pa.float64()), pa.array(linked, pa.bool_())],
                              names=["cls", "pivot", "far", "linked"])


class Corpus:
    """The documents with their signatures; gives the whole sets of chosen classes."""

    def __init__(self, rows: DataFrame, documents: DataFrame) -> None:
        self.keyed = rows.select(_key(F.col("doc_id")).alias("key"), "text")
        self.keys = documents.where("cls is not null").groupBy("cls").agg(F.min(_key(F.col("doc_id"))).alias("key"))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """(cls, shingles) of the classes in ``wanted`` (cls); a class may come more than once.

        Texts are read again; which to look at is told by a bitmap of fixed size
        over the classes' first documents, so no text is shuffled.
        """
        blocks = wanted.join(self.keys, "cls").select("key").mapInArrow(_mark, "block int, cells binary")
        marks = np.packbits(sum_blocks(blocks) > 0).tobytes()
        found = self.keyed.mapInArrow(_fetch(marks), "cls long, shingles binary")
        return found.join(wanted, "cls", "left_semi")


def collapse(shared: DataFrame, corpus: Corpus) -> tuple[DataFrame, list[DataFrame]]:
    """Regions of step 1 with more than ``RUN`` sets, thinned out round by round.

    A round takes one set of each such region as its pivot and links the pivot's
    ball to it.  With m the smallest distance to the pivot beyond the ball, sets
    of the ball nearer than m less the radius can't be linked to any set outside
    (triangle inequality) and leave the region, as does the pivot.  A region
    that is one ball is done after one round, whatever its size; what is left
    after ``ROUNDS`` rounds is compared tile by tile.  Returns (run, cls) and the
    links (u, v) found.
    """
    radius, links, kept_sets = (100 - PERCENT) / 100, [], None
    for _ in range(ROUNDS):
        sizes = shared.groupBy("run").agg(F.count("*").alias("count"), F.min("cls").alias("pivot"))
        long = cut(sizes.where(F.col("count") > RUN).select("run", "pivot"))
        if long.isEmpty():
            break
        rows = cut(shared.join(long, "run").where("cls <> pivot"))
        if kept_sets is None:
            both = rows.select("cls").unionByName(long.select(F.col("pivot").alias("cls"))).distinct()
            kept_sets = cut(corpus.sets(cut(both)).groupBy("cls").agg(F.first("shingles").alias("shingles")))
        pivots = kept_sets.select(F.col("cls").alias("pivot"), F.col("shingles").alias("other"))
        pairs = rows.select("cls", "pivot").distinct().join(kept_sets, "cls").join(pivots, "pivot")
        near = cut(pairs.select("cls", "pivot", "shingles", "other").mapInArrow(
            _distances, "cls long, pivot long, far double, linked boolean"))
        links.append(near.where("linked").select(F.col("cls").alias("u"), F.col("pivot").alias("v")))
        seen = rows.join(near, ["cls", "pivot"])
        beyond = seen.where("not linked").groupBy("run").agg(F.min("far").alias("beyond"))
        left = seen.join(beyond, "run", "left").where(
            ~F.col("linked") | (F.col("far") >= F.col("beyond") - F.lit(radius + 1e-9))
        )
        short = shared.join(long.select("run"), "run", "left_anti")
        shared = cut(short.unionByName(left.select("run", "cls")))
    return shared, links


def grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, said, n, root) for every row of ``docs`` (doc_id, text).

    ``said`` is a hash of the text, ``n`` the size of its set, and ``root`` the
    same for rows that links connect; null without words.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = texts(docs)
    signed = cut(rows.withColumn("said", F.xxhash64("text")).mapInArrow(_sign, SIGNED))
    marks = crowded_cells(sum_blocks(signed.where("block is not null").select("block", "cells")))
    documents = signed.where("block is null").select("doc_id", "said", "n", "cls")

    posts = rows.select("text").mapInArrow(_post(np.packbits(marks).tobytes()), "h long, cls long")
    runs = posts.repartition("h").sortWithinPartitions("h", "cls").mapInArrow(_shared, "run long, cls long")
    corpus = Corpus(rows, documents)
    shared, links = collapse(cut(runs.distinct()), corpus)
    classes = signed.where("cls is not null").groupBy("cls").agg(
        F.first("n").alias("n"), F.first("profile").alias("profile")
    )
    if links:
        balls = connected_components(functools.reduce(DataFrame.unionByName, links)).toDF("cls", "comp")
        shared = shared.join(balls, "cls", "left").select("run", "cls", F.coalesce("comp", "cls").alias("comp"))
    else:
        shared = shared.select("run", "cls", F.col("cls").alias("comp"))

    long_runs = shared.groupBy("run").count().where(F.col("count") > RUN).select(
        "run", F.ceil(F.col("count") / RUN).cast("int").alias("tiles")
    )
    runs = _tiled(shared, long_runs, "run").select("run", "a", "b", "cls", "comp").join(classes, "cls")
    runs = runs.select("run", "a", "b", "cls", "comp", "n", "profile").repartition("run", "a", "b")
    near = runs.sortWithinPartitions("run", "a", "b").mapInArrow(_neighbours, "u long, v long")
    regions = cut(connected_components(near).toDF("cls", "region"))

    sets = corpus.sets(regions.select("cls")).join(regions, "cls")
    total = regions.join(classes.select("cls", "n"), "cls").groupBy("region").agg(F.sum("n").alias("n"))
    large = total.where(F.col("n") > REGION).select("region", F.ceil(F.col("n") / REGION).cast("int").alias("tiles"))
    dealt = _tiled(sets, large, "region").select("region", "a", "b", "cls", "shingles")
    dealt = dealt.repartition("region", "a", "b").sortWithinPartitions("region", "a", "b", "cls")
    links.append(dealt.mapInArrow(_join_regions, "u long, v long"))
    linked = connected_components(functools.reduce(DataFrame.unionByName, links)).toDF("cls", "root")

    return documents.join(linked, "cls", "left").select("doc_id", "said", "n", F.coalesce("root", "cls").alias("root"))


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text).

    A set is the distinct five-word shingles of the text with A-Z lower-cased,
    words being runs of non-white ASCII; with fewer words it is their whole
    sequence.  Documents link at a Jaccard similarity of 0.8 or more; the
    component is the smallest doc_id reachable.

    Shingles are 64-bit hashes and classes 64-bit hashes of sets; two different
    ones are taken as equal with a chance of 2^-64 a pair.

    Defined cases: null, empty and wordless texts have 0 shingles and link with
    nothing; a null doc_id is never a component's id unless nothing else is in
    it; equal rows each give a row; texts of any length are taken whole; an
    empty table gives no rows; extra columns are left out.
    """
    found = grouped(docs)
    worded = found.where("root is not null")
    # kept apart, so that Spark can split the join where a component has very many documents
    first = cut(worded.groupBy("root").agg(F.min("doc_id").alias("component_id")))
    alone = found.where("root is null").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    out = worded.join(first, "root").select("doc_id", "n", "component_id").unionByName(alone)
    return out.withColumnRenamed("n", "n_shingles")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they are.

    It is the row with the smallest id (null last), then the smallest hash of its
    text, whichever of equal ids and texts.  Components connect rows, not ids:
    of rows with one id and other texts each stands for its own component.  Rows
    without words link with nothing, so all of them stay.
    """
    found = grouped(docs).where("root is not null")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("kept"), F.col("said").alias("kept_said"))
    first = found.groupBy("root").agg(F.min(place).alias("first")).select("first.kept", "first.kept_said")
    rows, text = positional(docs), F.col(f"c{place_of(docs, 'text')}").cast("string")
    names = rows.columns
    rows = rows.withColumn("key", F.col(f"c{place_of(docs, 'doc_id')}").cast("long")).withColumn("said", F.xxhash64(text))
    spoken = F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    same = F.col("key").eqNullSafe(F.col("kept")) & (F.col("said") == F.col("kept_said"))
    again = Window.partitionBy("key", "said").orderBy("key")
    kept = rows.where(spoken).join(first, same, "left_semi")
    kept = kept.withColumn("again", F.row_number().over(again)).where("again = 1")
    return kept.select(*names).unionByName(rows.where(~spoken).select(*names)).toDF(*docs.columns)
