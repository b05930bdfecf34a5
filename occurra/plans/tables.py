"""Catalog tables: the raw store (K1 / K2) and the materialised models (K5-K7).

The raw store ``<table>`` is a view over plain Parquet tables, both bucketed and
sorted by the key:

* ``<table>__snap_<n>``  one complete snapshot, a row per key;
* ``<table>__loads``     the batches since, partitioned by ``load_id``.

An upsert writes its de-duplicated batch once, as a new load, and then replaces
the view so that it includes the load.  Nothing that is stored already is read
or rewritten, so a small batch costs what the batch costs.  The view is the
snapshot without the loads' keys, and the newest load's row of every key; both
sides of that join have the same buckets, so the snapshot is never shuffled.
What counts is written in the view's properties (``State``), so a run that stops
before the view is replaced leaves the old state, and its files are never read.

``upkeep`` bounds the loads: ``fan`` loads of a level are merged into one of the
next, and once loads hold a good share of the snapshot's rows everything becomes
the next snapshot, so a row is rewritten a logarithmic number of times.  Replaced
tables and loads stay for readers of an earlier state until ``grace_seconds``
have passed.  There is one writer at a time.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurra.functions.expr import ident, lit_sql
from occurra.operators.staging import staging_view_sql
from occurra.operators.upsert import dedupe_last
from occurra.schema import (
    COLUMN_COMMENTS, LEGACY_SCHEMA, RAW_COLUMNS, RAW_KEY, TABLE_COMMENTS,
)

LOAD = "load_id"
_STATE = "occurra.state"
FAN = 8  # loads of a level that are merged
SHARE = 0.5  # of the snapshot's rows; with so many in loads a snapshot is due
GRACE_SECONDS = 86_400.0
_COLUMNS = ", ".join(ident(n) for n, _ in RAW_COLUMNS)


@dataclass(frozen=True)
class State:
    """What a raw store's view stands for."""

    snapshot: int = 0
    buckets: int = 1
    rows: int = 0  # of the snapshot
    loads: list[list[int]] = field(default_factory=list)  # id, level, rows; oldest first, ids ascend
    max_event_date: str | None = None
    streams: dict[str, int] = field(default_factory=dict)  # last batch of each stream
    retired: list[list] = field(default_factory=list)  # kind, id, when replaced

    @property
    def ids(self) -> list[int]:
        return [x[0] for x in self.loads]


def _create_database(spark: SparkSession, table: str) -> None:
    if "." in table:
        spark.sql(f"create database if not exists {table.split('.')[0]}")


def _create_table(spark: SparkSession, name: str, buckets: int, partitioned: bool = False) -> None:
    cols = [
        f"{ident(n)} {t.simpleString()}" + (f" comment {lit_sql(COLUMN_COMMENTS[n])}" if n in COLUMN_COMMENTS else "")
        for n, t in RAW_COLUMNS
    ]
    part = f"partitioned by ({LOAD}) " if partitioned else ""
    cols += [f"{LOAD} bigint"] if partitioned else []
    k = ident(RAW_KEY)
    spark.sql(
        f"create table if not exists {name} ({', '.join(cols)}) using parquet {part}"
        f"clustered by ({k}) sorted by ({k}) into {int(buckets)} buckets"
    )


def _state(spark: SparkSession, table: str) -> State:
    props = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {table}").collect()}
    if _STATE not in props:
        raise ValueError(f"{table} is not a raw store")
    return State(**json.loads(props[_STATE]))


def _newest(table: str, loads: list[int]) -> str:
    """SQL: the newest row of every key among some loads."""
    k = ident(RAW_KEY)
    return (
        f"select {_COLUMNS} from (select *, row_number() over (partition by {k} order by {LOAD} desc) as _rn "
        f"from {table}__loads where {LOAD} in ({', '.join(map(str, loads))})) where _rn = 1"
    )


def state_sql(table: str, snapshot: int, loads: list[int]) -> str:
    """SQL: the rows of a snapshot and the loads after it."""
    k = ident(RAW_KEY)
    if not loads:
        return f"select {_COLUMNS} from {table}__snap_{snapshot}"
    return (
        f"select {', '.join(f's.{ident(n)}' for n, _ in RAW_COLUMNS)} from {table}__snap_{snapshot} s "
        f"left anti join (select {k} from {table}__loads where {LOAD} in ({', '.join(map(str, loads))})) l on s.{k} = l.{k} "
        f"union all {_newest(table, loads)}"
    )


def _set_state(spark: SparkSession, table: str, state: State) -> None:
    """Point the view at a state; one catalog operation."""
    named = ", ".join(
        ident(n) + (f" comment {lit_sql(COLUMN_COMMENTS[n])}" if n in COLUMN_COMMENTS else "") for n, _ in RAW_COLUMNS
    )
    spark.sql(
        f"create or replace view {table} ({named}) tblproperties ('{_STATE}' = {lit_sql(json.dumps(asdict(state)))}) "
        f"as {state_sql(table, state.snapshot, state.ids)}"
    )


def ensure_raw_table(spark: SparkSession, table: str, buckets: int | None = None) -> None:
    """K1: create the database and the empty raw store if missing.

    ``buckets`` is fixed then; by default as many as there are shuffle
    partitions, so that a de-duplicated batch is written a file per bucket.
    """
    _create_database(spark, table)
    if spark.catalog.tableExists(table):
        _state(spark, table)
        return
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    _create_table(spark, f"{table}__snap_0", buckets)
    _create_table(spark, f"{table}__loads", buckets, partitioned=True)
    _set_state(spark, table, State(buckets=buckets))


def _load_ids(spark: SparkSession, table: str) -> list[int]:
    """All loads on disk, also those of runs that never committed."""
    rows = spark.sql(f"show partitions {table}__loads").collect()
    return [int(r[0].split("=")[1]) for r in rows]


def _next_load(spark: SparkSession, table: str, state: State) -> int:
    return max([0, *state.ids, *_load_ids(spark, table)]) + 1


def _watermark(spark: SparkSession, table: str, state: State, load: int, latest: dt.date | None) -> str | None:
    """The latest event date once ``load``, whose own is ``latest``, is applied.

    Only a load that ends before the watermark looks at stored rows: first at
    those of the watermark's day, and if it replaces all of these, at all.
    """
    now = state.max_event_date
    if now is None or (latest is not None and latest.isoformat() >= now):
        return latest and latest.isoformat()
    keys = spark.table(f"{table}__loads").filter(F.col(LOAD) == load).select(RAW_KEY)
    kept = spark.table(table).join(keys, RAW_KEY, "left_anti").select("event_date")
    if kept.filter(F.col("event_date") == F.lit(now).cast("date")).limit(1).count():
        return now
    rest = kept.agg(F.max("event_date")).first()[0]
    dates = [d.isoformat() for d in (rest, latest) if d is not None]
    return max(dates, default=None)


def max_event_date(spark: SparkSession, table: str) -> dt.date | None:
    """The latest event date of the raw store, kept at every commit; reads no data file."""
    known = _state(spark, table).max_event_date
    return known and dt.date.fromisoformat(known)


def upsert_into_table(
    spark: SparkSession,
    table: str,
    batch: DataFrame,
    order: Sequence[str],
    stream: tuple[str, int] | None = None,
) -> int | None:
    """K2: insert-or-replace ``batch`` (raw columns + order columns) into ``table``.

    Returns the id of the new load, or ``None`` for an empty batch, which
    changes nothing.  The batch is read once and nothing stored is rewritten.
    ``stream`` names the stream and the number of a micro-batch; it is committed
    with the load, and a batch that was committed before is left out.  A row
    without a key fails the load.
    """
    state = _state(spark, table)
    if stream and state.streams.get(stream[0], -1) >= stream[1]:
        return None
    load = _next_load(spark, table, state)
    missing = F.raise_error(F.lit(f"a row of the batch for {table} has no {RAW_KEY}"))
    keyed = batch.withColumn(RAW_KEY, F.coalesce(F.col(RAW_KEY), missing.cast("string")))
    latest = dedupe_last(keyed, RAW_KEY, list(order)).select(
        *[F.col(ident(n)) for n, _ in RAW_COLUMNS], F.lit(load).cast("bigint").alias(LOAD)
    )
    # an append to a partition of its own: neither overwrite mode nor other loads matter
    latest.write.insertInto(f"{table}__loads", overwrite=False)
    rows, last = _stats(spark, table, load)
    if not rows:
        return None
    _set_state(spark, table, replace(
        state, loads=[*state.loads, [load, 0, rows]], max_event_date=_watermark(spark, table, state, load, last),
        streams={**state.streams, **({stream[0]: stream[1]} if stream else {})},
    ))
    return load


def _stats(spark: SparkSession, table: str, load: int) -> tuple[int, dt.date | None]:
    """Rows and latest event date of one load; reads one column."""
    part = spark.table(f"{table}__loads").filter(F.col(LOAD) == load)
    return tuple(part.agg(F.count("*"), F.max("event_date")).first())


def _retire(state: State, snapshot: bool, loads: list[int]) -> list[list]:
    now = time.time()
    return [*state.retired, *([["snap", state.snapshot, now]] if snapshot else []), *([["load", x, now] for x in loads])]


def compact(spark: SparkSession, table: str) -> int:
    """Write the current state as the next snapshot and switch the view to it."""
    state = _state(spark, table)
    if not state.loads:
        return state.snapshot
    new = state.snapshot + 1
    name = f"{table}__snap_{new}"
    spark.sql(f"drop table if exists {name}")  # left by a run that stopped before its switch
    _create_table(spark, name, state.buckets)
    spark.table(table).write.insertInto(name, overwrite=False)
    _set_state(spark, table, replace(
        state, snapshot=new, rows=spark.table(name).count(), loads=[], retired=_retire(state, True, state.ids)
    ))
    return new


def merge_level(spark: SparkSession, table: str, level: int) -> int:
    """Write the loads of a level and below as one of the next level and switch the view to it."""
    state = _state(spark, table)
    old = [x for x in state.loads if x[1] <= level]  # the newest ones
    load = _next_load(spark, table, state)
    merged = spark.sql(_newest(table, [x[0] for x in old])).withColumn(LOAD, F.lit(load).cast("bigint"))
    merged.write.insertInto(f"{table}__loads", overwrite=False)
    rows, _ = _stats(spark, table, load)
    kept = [x for x in state.loads if x[1] > level]
    _set_state(spark, table, replace(
        state, loads=[*kept, [load, level + 1, rows]], retired=_retire(state, False, [x[0] for x in old])
    ))
    return load


def upkeep(
    spark: SparkSession, table: str, fan: int = FAN, share: float = SHARE, grace_seconds: float = GRACE_SECONDS
) -> None:
    """Merge what has become many loads, then remove what was replaced ``grace_seconds`` ago.

    A level has fewer than ``fan`` loads afterwards.
    """
    while True:
        state = _state(spark, table)
        counts: dict[int, int] = {}
        for _, level, _ in state.loads:
            counts[level] = counts.get(level, 0) + 1
        full = [level for level, n in counts.items() if n >= fan]
        if not full:
            break
        if sum(x[2] for x in state.loads) >= share * state.rows:
            compact(spark, table)
        else:
            merge_level(spark, table, min(full))
    drop_unused(spark, table, grace_seconds)


def drop_unused(spark: SparkSession, table: str, grace_seconds: float = 0.0) -> None:
    """Remove snapshots and loads that were replaced ``grace_seconds`` ago, or never committed.

    Readers that began before that must have ended.
    """
    state, now = _state(spark, table), time.time()
    waiting = [r for r in state.retired if r[2] > now - grace_seconds]
    keep = {("snap", state.snapshot), *(("load", x) for x in state.ids), *((r[0], r[1]) for r in waiting)}
    for load in _load_ids(spark, table):
        if ("load", load) not in keep:
            spark.sql(f"alter table {table}__loads drop if exists partition ({LOAD} = {load})")
    database, _, name = table.rpartition(".")
    shown = spark.sql(f"show tables {'in ' + database if database else ''} like '{name}__snap_*'").collect()
    for row in shown:
        if ("snap", int(row["tableName"].rpartition("_")[2])) not in keep:
            spark.sql(f"drop table {database + '.' if database else ''}{row['tableName']}")
    if waiting != state.retired:
        _set_state(spark, table, replace(state, retired=waiting))


def check_unique_after_load(spark: SparkSession, table: str, load: int) -> DataFrame:
    """Q2: keys of one load that the store's view has more than once; none, if the store is sound.

    The same as the check over all keys, as only a load's keys can have become
    repeated.  Snapshot and loads have the same buckets, so they meet without
    being shuffled, and what is counted is as large as the load.
    """
    keys = spark.table(f"{table}__loads").filter(F.col(LOAD) == load).select(RAW_KEY).distinct()
    rows = spark.table(table).select(RAW_KEY).join(keys, RAW_KEY, "left_semi")
    return rows.groupBy(RAW_KEY).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def create_staging_view(spark: SparkSession, raw_table: str, view: str) -> DataFrame:
    """K5: (re)create the staging model as a persistent view over the raw
    table; readers of the view always see the current raw table."""
    _create_database(spark, view)
    spark.sql(staging_view_sql(view, raw_table))
    return spark.table(view)


def read_raw(spark: SparkSession, table: str) -> DataFrame:
    """The current state of the raw store."""
    return spark.table(table)


def _mart_versions(spark: SparkSession, database: str, name: str) -> list[int]:
    shown = spark.sql(f"show tables in {database} like '{name}__v*'").collect()
    tails = [r["tableName"].rpartition("__v")[2] for r in shown]
    return sorted(int(t) for t in tails if t.isdigit())


def mart_names(database: str) -> dict[str, str]:
    return {"dim": f"{database}.dim_species", "fct": f"{database}.fct_daily_species_observations"}


def mart_view(spark: SparkSession, name: str, columns: list[str], body: str, properties: dict[str, str] | None = None) -> None:
    """Create or replace a mart's view, with its comments; one catalog operation."""
    cols = ", ".join(
        ident(c) + (f" comment {lit_sql(COLUMN_COMMENTS[c])}" if c in COLUMN_COMMENTS else "") for c in columns
    )
    comment = TABLE_COMMENTS.get(name.split(".")[-1])
    props = ", ".join(f"{lit_sql(k)} = {lit_sql(v)}" for k, v in (properties or {}).items())
    spark.sql(
        f"create or replace view {name} ({cols}) {'comment ' + lit_sql(comment) if comment else ''} "
        f"{f'tblproperties ({props})' if props else ''} as {body}"
    )


def stage_marts(spark: SparkSession, models, database: str) -> dict[str, str]:
    """K6: write the marts as tables of a new version, which nobody reads yet; their names."""
    spark.sql(f"create database if not exists {database}")
    names = mart_names(database)
    version = max([0, *(v for n in names.values() for v in _mart_versions(spark, database, n.split(".")[-1]))]) + 1
    staged = {short: f"{name}__v{version}" for short, name in names.items()}
    for short, name in staged.items():
        getattr(models, short).write.saveAsTable(name)
    return staged


def publish_marts(spark: SparkSession, staged: dict[str, str], database: str, keep: int = 2) -> dict[str, str]:
    """K6: point the mart views, which have the comments, at a staged version; older versions but
    ``keep`` are removed.

    The switch is a catalog operation per mart and writes nothing; one that stops
    between the two is mended by publishing again.
    """
    names = mart_names(database)
    for short, name in names.items():
        mart_view(spark, name, spark.table(staged[short]).columns, f"select * from {staged[short]}")
    for short, name in names.items():
        current = int(staged[short].rpartition("__v")[2])
        older = [v for v in _mart_versions(spark, database, name.split(".")[-1]) if v < current]
        for v in older[: max(0, len(older) - keep + 1)]:
            spark.sql(f"drop table if exists {name}__v{v}")
    return names


def materialize(
    spark: SparkSession,
    models,
    database: str,
    staging_database: str | None = None,
    raw_table: str | None = None,
    check=None,
) -> dict[str, str]:
    """K5-K7: staging as a view, marts as full-refresh versions behind views, with comments.

    With ``raw_table`` the staging view is a persistent catalog view over that
    table; otherwise a session view of ``models.stg``.  Returns the names.  The
    marts are written once, ``check`` sees the written version (a dict of
    DataFrames), and only then readers do: if it raises, the old marts stay.
    """
    staging_database = staging_database or database
    for db in {database, staging_database}:
        spark.sql(f"create database if not exists {db}")
    if raw_table:
        stg = f"{staging_database}.stg_belgian_birds"
        create_staging_view(spark, raw_table, stg)
    else:
        stg = "stg_belgian_birds"
        models.stg.createOrReplaceTempView(stg)
    staged = stage_marts(spark, models, database)
    if check is not None:
        check({short: spark.table(name) for short, name in staged.items()})
    return {"stg": stg, **publish_marts(spark, staged, database)}


def append_legacy(spark: SparkSession, table: str, rows: DataFrame) -> None:
    """K4: append the 6-column legacy projection (no upsert: a rerun appends
    the same rows again, as the append-only source sink does)."""
    _create_database(spark, table)
    if not spark.catalog.tableExists(table):
        spark.createDataFrame([], LEGACY_SCHEMA).write.saveAsTable(table)
    cols = [f"cast({ident(f.name)} as {f.dataType.simpleString()}) as {ident(f.name)}" for f in LEGACY_SCHEMA.fields]
    rows.selectExpr(*cols).write.insertInto(table)
