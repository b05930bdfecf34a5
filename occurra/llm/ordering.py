"""Global row numbers and running sums without a single-task sort.

Rows are range-partitioned on the order columns, written once to the shared
folder, and numbered by adding to each row's place in its partition what lies
in the partitions before.  Only one small row per partition reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from occurra.llm.common import cut, prepare


def ordered(df: DataFrame, order: list[str], parts: int | None = None) -> DataFrame:
    """``df`` in global order, kept in the shared folder, with its partition as ``pid``."""
    prepare(df.sparkSession)
    ranged = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return cut(ranged.sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id()))


def numbered(kept: DataFrame, size: str | None = None) -> tuple[DataFrame, int, int]:
    """Adds ``rn`` (rows before) and, with ``size``, ``before`` (the sum of ``size`` before).

    ``kept`` comes from :func:`ordered`.  Also returns the number of rows and
    the total size.
    """
    total = F.sum(size).alias("b") if size else F.lit(0).alias("b")
    rows = kept.groupBy("pid").agg(F.count("*").alias("n"), total).orderBy("pid").collect()
    starts, n, b = {}, 0, 0
    for r in rows:
        starts[r["pid"]] = (n, b)
        n, b = n + r["n"], b + (r["b"] or 0)
    schema = kept.withColumn("rn", F.lit(0).cast("long"))
    schema = schema.withColumn("before", F.lit(0).cast("long")) if size else schema
    arrow, names = to_arrow_schema(schema.schema), kept.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, list[int]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            pids = batch.column(names.index("pid")).to_numpy()
            edges = np.flatnonzero(np.diff(pids)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(pids)]):
                part = batch.slice(lo, hi - lo)
                state = at.setdefault(int(pids[lo]), list(starts[int(pids[lo])]))
                cols = list(part.columns) + [pa.array(np.arange(state[0], state[0] + hi - lo), pa.int64())]
                state[0] += hi - lo
                if size:
                    s = part.column(names.index(size)).to_numpy(zero_copy_only=False).astype(np.int64)
                    ends = np.cumsum(s)
                    cols.append(pa.array(ends - s + state[1], pa.int64()))
                    state[1] += int(ends[-1])
                yield pa.RecordBatch.from_arrays(cols, schema=arrow)

    return kept.mapInArrow(number, schema.schema), n, b
