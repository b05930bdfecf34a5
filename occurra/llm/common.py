"""Helpers the operators of this subpackage share.

Lineage is cut with a reliable ``checkpoint()`` in the folder that the cluster
names in ``spark.checkpoint.dir``; only where that is unset (tests, a laptop)
is a scratch folder chosen.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows in an Arrow batch; keeps a batch of long documents within a few MB.
BATCH_ROWS = 500
BATCH_BYTES = "8m"


def shared_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that every executor sees."""
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir", None)
    if folder:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(folder)
        return folder
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="llm-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the files."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once an application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    file = Path(tempfile.mkdtemp(prefix="llm-code-")) / "llm_code.zip"
    with zipfile.ZipFile(file, "w") as z:
        for p in sorted((root / "occurra").rglob("*.py")):
            z.write(p, p.relative_to(root))
    context.addPyFile(str(file))
    _shipped.add(context.applicationId)


def prepare(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Ship the code; bound the rows of a batch handed to Python (never raises a smaller setting)."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def place_of(df: DataFrame, name: str) -> int:
    """Where the column called ``name`` is; one that differs only in case if there is no other."""
    for same in (lambda c: c == name, lambda c: c.lower() == name.lower()):
        for i, c in enumerate(df.columns):
            if same(c):
                return i
    raise ValueError(f"no column {name!r} among {df.columns}")


def positional(df: DataFrame) -> DataFrame:
    """``df`` with its columns called c0, c1 and so on, so that no name clashes with another."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def pick(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the named columns, under the given names; whatever other columns there are."""
    return positional(df).select(*[F.col(f"c{place_of(df, src)}").alias(out) for out, src in wanted.items()])


def texts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text) of a documents table; the text as it is, also null."""
    return pick(df, doc_id=key, text=text).select(
        F.col("doc_id").cast("long"), F.col("text").cast("string")
    )


def utf8(arr: pa.Array) -> list[bytes]:
    """UTF-8 of each value; null as empty."""
    return [b"" if v is None else v for v in arr.cast(pa.binary()).to_pylist()]


class Forest:
    """Union-find over hashable ids with the smallest id as root."""

    def __init__(self) -> None:
        self.up: dict = {}

    def root(self, x):
        up = self.up
        r = x
        while up.get(r, r) != r:
            r = up[r]
        while up.get(x, x) != r:
            up[x], x = r, up[x]
        return r

    def join(self, a, b) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            lo, hi = (a, b) if a < b else (b, a)
            self.up[hi] = lo
            self.up.setdefault(lo, lo)

    def stars(self) -> list[tuple]:
        return [(x, self.root(x)) for x in list(self.up) if self.root(x) != x]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition replaced by a star forest with the same components."""
    forest, held = Forest(), 0

    def out():
        pairs = forest.stars()
        return pa.record_batch(
            [pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())],
            names=["u", "v"],
        )

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.up) > 500_000:  # bounded memory: a forest in parts has the same components
            yield out()
            forest = Forest()
    yield out()


def _is_star_forest(e: DataFrame) -> bool:
    """Whether every ``u`` has one ``v`` and no ``v`` is a ``u``; counts only reach the driver."""
    ends = e.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into")).unionByName(
        e.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into"))
    )
    per_id = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    bad = (F.col("out") > 1) | ((F.col("out") > 0) & (F.col("into") > 0))
    return per_id.where(bad).limit(1).count() == 0


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component) for every id in ``edges`` (two long columns, no nulls).

    The component is its smallest id.  Each task first contracts its edges to
    star forests; then large-star and small-star rounds run until the edges are
    stars around the smallest ids.  Every round is checkpointed, and all grouping
    is by partial aggregation and joins that AQE can split, so a hub doesn't need
    one task.
    """
    a, b = edges.columns
    e = edges.select(F.col(a).cast("long").alias("u"), F.col(b).cast("long").alias("v")).where("u <> v")
    e = cut(e.mapInArrow(_contract, "u long, v long").distinct())
    for _ in range(max_rounds):
        if _is_star_forest(e):  # from _contract and from every round, v is below u
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
        )
        e = cut(
            small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
        )
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    stars = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = stars.select(F.col("component").alias("id"), "component").distinct()
    return stars.unionByName(roots)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x
