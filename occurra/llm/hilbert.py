"""Shards cut from a Hilbert-curve order of document metadata.

Each metadata dimension is quantised at approximate quantiles of its values
(order-preserving, so shards keep narrow value ranges and their min/max prune
files), the cells are numbered along a Hilbert curve, rows are sorted by cell
number, and runs of nearly equal bytes become shards.  Only a row's id, size,
checksum and cell are shuffled, and the distinct values of string dimensions
with their counts, never its text.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurra.llm.common import pick
from occurra.llm.ordering import numbered, ordered

LAW = "bytes"


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (n x dimensions, ``bits`` each).

    Gray-code walk from the highest bit down: in each sub-cube the axes are
    reflected and exchanged as the curve's orientation demands.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            on = (x[d] & top) != 0
            swap = np.where(on, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[d] = x[d] ^ swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> level) & 1, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            out = out << 1 | (x[d] >> level & 1)
    return out


def _curve(spark: SparkSession, dims: int, bits: int) -> DataFrame:
    """(cell, h) of all 2^(dims*bits) cells; the bound of what is broadcast."""
    cell = np.arange(1 << dims * bits)
    axes = np.stack([cell >> bits * (dims - 1 - d) & (1 << bits) - 1 for d in range(dims)], axis=1)
    table = pa.table({"cell": pa.array(cell, pa.int64()), "h": pa.array(hilbert_index(axes, bits), pa.int64())})
    return spark.createDataFrame(table)


def _string_cuts(rows: DataFrame, column: str, levels: int) -> list[str]:
    """The ``levels`` - 1 quantiles of a string column, whole values in string order; nulls don't count.

    From the distinct values' counts; as a cut is one of at most ``levels`` - 1
    values, so few rows reach the driver.
    """
    counts = rows.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    placed, _, total = numbered(ordered(counts, ["value"]), "n")
    upto = lambda n: F.floor(n.cast("decimal(38,0)") * levels / F.lit(max(total, 1)).cast("decimal(38,0)"))
    cuts = upto(F.col("before") + F.col("n")) - upto(F.col("before"))
    # a value that several quantiles fall on is that many cuts; the last row ends at no cut
    found = placed.select("value", "before", cuts.cast("int").alias("k")).where("k > 0").orderBy("before").collect()
    return [r["value"] for r in found for _ in range(r["k"])][: levels - 1]


def shard(
    docs: DataFrame,
    shards: int = 24,
    bits: int = 5,
    key: str = "doc_id",
    text: str = "text",
    dimensions: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """(doc_id, size, text_crc32, h, shard, slot): every row in one of ``shards`` shards.

    The dimensions are the given columns and the size.  Rows are ordered by
    curve place, text checksum and id, so equal texts of equal metadata lie
    together; a shard is the run whose middle byte falls into its share of all
    bytes, so two shards' bytes differ by at most the largest rows.

    Defined cases: a null text counts 8 bytes; null ids and null dimensions sort
    first; ties and equal rows keep a place each; one huge row may leave a
    neighbouring shard empty; an empty table gives no rows; extra columns are
    left out.
    """
    spark = docs.sparkSession
    names = {f"d{i}": c for i, c in enumerate(dimensions)}
    # strings and numbers as they are
    plain = pick(docs, doc_id=key, text=text, **names)
    kinds = dict(plain.dtypes)
    rows = plain.select(
        F.col("doc_id").cast("long"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        *[F.col(d) if kinds[d] == "string" else F.col(d).cast("double").alias(d) for d in names],
    ).withColumn("dsize", F.col("size").cast("double"))
    axes = [*names, "dsize"]
    steps = (1 << bits) - 1
    numbers = [a for a in axes if kinds.get(a) != "string"]
    cuts = rows.agg(
        *[F.percentile_approx(a, [(i + 1) / (steps + 1) for i in range(steps)], 2000).alias(a) for a in numbers]
    ).first().asDict()
    cuts |= {a: _string_cuts(rows, a, steps + 1) for a in axes if a not in numbers}
    cell = F.lit(0).cast("long")
    for a in axes:
        level = F.lit(0).cast("long")
        for c in cuts[a] or []:
            above = F.col(a) > F.lit(float(c) if a in numbers else c)
            level = level + F.coalesce(above, F.lit(False)).cast("long")
        cell = cell * (steps + 1) + level
    placed = rows.select("doc_id", "size", "text_crc32", cell.alias("cell"))
    curve = _curve(spark, len(axes), bits)
    placed = placed.join(F.broadcast(curve), "cell").drop("cell")
    kept = ordered(placed, ["h", "text_crc32", "doc_id", "size"])
    rows, _, total = numbered(kept, "size")
    middle = F.col("before").cast("decimal(38,0)") * 2 + F.col("size")
    share = F.floor(middle * shards / F.lit(2 * max(total, 1)).cast("decimal(38,0)"))
    rows = rows.withColumn("shard", F.least(share, F.lit(shards - 1)).cast("int"))
    first = {r["shard"]: r["s"] for r in rows.groupBy("shard").agg(F.min("rn").alias("s")).collect()}
    start = F.lit(0).cast("long")
    for s, at in first.items():
        start = F.when(F.col("shard") == s, F.lit(at).cast("long")).otherwise(start)
    return rows.select("doc_id", "size", "text_crc32", "h", "shard", (F.col("rn") - start).alias("slot"))
