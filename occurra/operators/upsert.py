"""Keyed upsert, last-arrival de-duplication, per-group caps, ingest statistics.

Arrival order is always explicit (columns such as file / row position or
page / offset): partition order is never relied on.

Skew: de-duplication is a ``max_by`` aggregate, which combines map-side, so a
key repeated in a third of the batch costs one row per map task in the
shuffle.  The per-group cap runs in two bounded rounds (see ``cap_per_group``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from occurra.functions.expr import ident


def dedupe_last(df: DataFrame, key: str | Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the one that arrived last (greatest ``order``).

    Equivalent to applying the rows one by one as upserts.  ``order`` must be
    unique within a key (e.g. batch sequence + row position).
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    value = "struct(" + ", ".join(ident(c) for c in rest) + ")"
    arrival = "struct(" + ", ".join(ident(c) for c in order) + ")"
    latest = df.groupBy(*keys).agg(F.expr(f"max_by({value}, {arrival})").alias("_latest"))
    return latest.selectExpr(*[ident(k) for k in keys], *[f"_latest.{ident(c)}" for c in rest])


def upsert_by_key(
    target: DataFrame,
    batch: DataFrame,
    key: str = "gbif_id",
    order: Sequence[str] = (),
) -> DataFrame:
    """Insert-or-replace ``batch`` into ``target`` on ``key``.

    The batch is first reduced to its last arrival per key (W1), so repeated
    keys in one batch behave like sequential upserts.  Target rows whose key
    is in the batch are replaced as a whole; the result has the target's
    columns.  Applying the same batch twice gives the same table.
    """
    latest = dedupe_last(batch, key, order) if order else batch
    latest = latest.select(*target.columns)
    kept = target.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest)


def cap_per_group(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    cap: int,
    salt_buckets: int = 64,
) -> DataFrame:
    """The first ``cap`` rows of every group in arrival order.

    Round 1 ranks within (group, salt) where the salt is the input partition
    modulo ``salt_buckets``; because every input task holds one salt, Spark's
    partial ``WindowGroupLimit`` lets each task ship at most ``cap`` rows per
    group, and a hot group is spread over ``salt_buckets`` reducers.  Round 2
    ranks the at most ``salt_buckets * cap`` survivors per group.  The result
    is exact: a row among a group's first ``cap`` is among the first ``cap`` of
    its own salt.  ``order`` must be a total order within a group.
    """
    if cap < 1:
        raise ValueError("cap must be >= 1")
    # Spark plans the partial limit below the shuffle up to this rank
    threshold = "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(df.sparkSession.conf.get(threshold)) < cap:
        df.sparkSession.conf.set(threshold, str(cap))
    grp = ", ".join(ident(c) for c in group)
    ordering = ", ".join(ident(c) for c in order)
    salted = df.selectExpr("*", f"pmod(spark_partition_id(), {int(salt_buckets)}) as _salt")
    round1 = salted.selectExpr(
        "*", f"row_number() over (partition by {grp}, _salt order by {ordering}) as _rn"
    ).filter(f"_rn <= {int(cap)}")
    round2 = round1.selectExpr(
        *[ident(c) for c in df.columns],
        f"row_number() over (partition by {grp} order by {ordering}) as _rn",
    ).filter(f"_rn <= {int(cap)}")
    return round2.drop("_rn")


INGEST_METRICS = ("rows_processed", "rows_upsert_attempted")


def observe_ingest(normalized: DataFrame, name: str = "ingest") -> tuple[DataFrame, Observation]:
    """Attach run statistics to the normalised rows.

    Every normalised row is sent to the upsert, so both counts are the number
    of rows that survived normalisation (not the number of net-new keys).  The
    metrics are filled in by whatever action writes the rows.
    """
    obs = Observation(name)
    observed = normalized.observe(
        obs,
        F.count(F.lit(1)).alias("rows_processed"),
        F.count(F.lit(1)).alias("rows_upsert_attempted"),
    )
    return observed, obs


def ingest_stats(normalized: DataFrame) -> DataFrame:
    """A12 as a one-row DataFrame (for reporting without a write)."""
    return normalized.selectExpr(
        "count(1) as rows_processed", "count(1) as rows_upsert_attempted"
    )
