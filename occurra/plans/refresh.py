"""Marts kept up to date from the loads of the raw store (A1 / A2 / K6).

A refresh looks at the loads that came since the marts were built.  Their rows,
and the rows they replaced, say which days and species changed; only these are
aggregated again, from the current rows.  The fact lies in one table by version
and day: a refresh writes whole new partitions of the days it touched and a
manifest, a row per day, that says which version of a day counts.  The mart views
are switched after the checks, so readers see one build or the next, and nothing
they read is overwritten.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurra.functions.expr import ident
from occurra.operators.marts import SPECIES_ID, build_dim_species, build_fct_daily, valid_dated
from occurra.operators.staging import build_staging
from occurra.plans import tables as TB
from occurra.schema import RAW_KEY

DAY, FACT_KEY = "observation_date", ["observation_date", "species_id"]
DIM_KEY = ["species_id", "taxon_key", "species_name"]
_BUILT = "occurra.built"


def _only(df: DataFrame, keys: DataFrame, names: list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (``left_anti``: isn't) in ``keys``; null keys are equal."""
    other = keys.select(*[F.col(k).alias(f"_{k}") for k in names]).distinct()
    cond = F.lit(True)
    for k in names:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return df.join(other, cond, how)


def _built(spark: SparkSession, fct: str) -> dict | None:
    """The raw state that the marts were built from."""
    if not spark.catalog.tableExists(fct):
        return None
    props = {r["key"]: r["value"] for r in spark.sql(f"show tblproperties {fct}").collect()}
    return json.loads(props[_BUILT]) if _BUILT in props else None


def _keys(raw: DataFrame) -> DataFrame:
    """The fact's and the dimension's keys of the rows that count."""
    return valid_dated(build_staging(raw)).selectExpr(DAY, f"{SPECIES_ID} as species_id", "taxon_key", "species_name").distinct()


def touched(spark: SparkSession, raw_table: str, built: dict, loads: list[int]) -> DataFrame:
    """Keys of the rows of ``loads`` and of the rows that they replaced in the state of ``built``."""
    rows = spark.table(f"{raw_table}__loads").filter(F.col(TB.LOAD).isin(loads)).drop(TB.LOAD)
    before = spark.sql(TB.state_sql(raw_table, built["snapshot"], built["loads"]))
    replaced = before.join(rows.select(RAW_KEY).distinct(), RAW_KEY, "left_semi").select(*rows.columns)
    return _keys(rows).unionByName(_keys(replaced)).distinct()


def _since(spark: SparkSession, raw_table: str, state: TB.State, built: dict | None) -> list[int] | None:
    """Loads since the marts were built; None if that can't be told, as after a new snapshot."""
    if built is None or built["raw"] != raw_table or built["snapshot"] != state.snapshot:
        return None
    if not set(built["loads"]) <= set(TB._load_ids(spark, raw_table)):
        return None
    return [x for x in state.ids if x not in built["loads"]]  # a merged load may hold older rows, too


def _versions(spark: SparkSession, database: str, names: dict[str, str]) -> list[int]:
    tails = [names["dim"].split(".")[-1], names["fct"].split(".")[-1] + "__days"]
    return sorted({v for t in tails for v in TB._mart_versions(spark, database, t)})


def refresh_marts(
    spark: SparkSession, raw_table: str, database: str, check: Callable[[dict[str, DataFrame]], None] | None = None, keep: int = 2
) -> str:
    """Bring ``dim_species`` and ``fct_daily_species_observations`` up to the raw store's state.

    Returns ``"none"`` if they are, ``"partial"`` if only touched keys were
    aggregated, ``"full"`` after a new snapshot of the store, and the first time.
    ``check`` sees the new marts (``dim``, ``fct``) before readers do; if it
    raises, the old ones stay.  ``keep`` versions stay for running readers.
    """
    spark.sql(f"create database if not exists {database}")
    names = TB.mart_names(database)
    dim, fct = names["dim"], names["fct"]
    state, built = TB._state(spark, raw_table), _built(spark, fct)
    loads = _since(spark, raw_table, state, built)
    if loads == []:
        return "none"
    version = max([0, *_versions(spark, database, names)]) + 1
    parts, days, changed = f"{fct}__parts", f"{fct}__days__v{version}", f"{fct}__touched__v{version}"
    stg = build_staging(spark.sql(TB.state_sql(raw_table, state.snapshot, state.ids)))
    if loads is None:
        new_dim, new_fct, old_days = build_dim_species(stg), build_fct_daily(stg), None
    else:
        spark.sql(f"drop table if exists {changed}")
        touched(spark, raw_table, built, loads).write.saveAsTable(changed)
        keys = spark.table(changed)
        keyed = stg.withColumn("species_id", F.expr(SPECIES_ID))
        new_dim = _only(spark.table(dim), keys, DIM_KEY, "left_anti").unionByName(
            build_dim_species(_only(keyed, keys, DIM_KEY).drop("species_id")))
        kept = _only(_only(spark.table(fct), keys, [DAY]), keys, FACT_KEY, "left_anti")
        new_fct = kept.unionByName(build_fct_daily(_only(keyed, keys, FACT_KEY).drop("species_id")))
        old_days = _only(spark.table(f"{fct}__days__v{built['version']}"), keys, [DAY], "left_anti")
    columns = [c for c in new_fct.columns if c != DAY]
    if not spark.catalog.tableExists(parts):
        types = dict(new_fct.dtypes)
        cols = ", ".join(f"{ident(c)} {types[c]}" for c in columns)
        spark.sql(f"create table {parts} ({cols}, v int, {DAY} date) using parquet partitioned by (v, {DAY})")
    else:  # left by a run that stopped before its switch
        _drop_parts(spark, parts, lambda v, _: v >= version)
    # rows come together by day; adaptive execution merges small days into a task and splits large ones
    rows = new_fct.select(*columns, F.lit(version).alias("v"), DAY)
    rows.hint("rebalance", F.col(DAY)).write.insertInto(parts, overwrite=False)
    spark.sql(f"drop table if exists {dim}__v{version}")
    new_dim.write.saveAsTable(f"{dim}__v{version}")
    written = spark.table(parts).filter(F.col("v") == version).select(DAY, "v").distinct()
    spark.sql(f"drop table if exists {days}")
    (written if old_days is None else old_days.unionByName(written)).write.saveAsTable(days)
    body = (
        f"select {', '.join(f'p.{ident(c)}' for c in new_fct.columns)} from {parts} p "
        f"join {days} d on p.{DAY} = d.{DAY} and p.v = d.v"
    )
    if check is not None:
        check({"dim": spark.table(f"{dim}__v{version}"), "fct": spark.sql(body)})
    TB.mart_view(spark, dim, new_dim.columns, f"select * from {dim}__v{version}")
    mark = {"raw": raw_table, "version": version, "snapshot": state.snapshot, "loads": state.ids}
    TB.mart_view(spark, fct, new_fct.columns, body, {_BUILT: json.dumps(mark)})
    spark.sql(f"drop table if exists {changed}")
    _clean(spark, database, names, version, keep)
    return "full" if loads is None else "partial"


def _drop_parts(spark: SparkSession, parts: str, unused: Callable[[int, str], bool]) -> None:
    for row in spark.sql(f"show partitions {parts}").collect():  # a row per day and version that is kept
        v, day = (x.split("=")[1] for x in row[0].split("/"))
        if unused(int(v), day):
            spark.sql(f"alter table {parts} drop if exists partition (v = {v}, {DAY} = date '{day}')")


def _clean(spark: SparkSession, database: str, names: dict[str, str], version: int, keep: int) -> None:
    """Remove versions but the last ``keep`` and the day partitions that none of these refers to."""
    dim, fct = names["dim"], names["fct"]
    held = [v for v in _versions(spark, database, names) if v <= version][-keep:]
    used: set[tuple[int, str]] = set()
    for v in _versions(spark, database, names):
        if v in held:
            if spark.catalog.tableExists(f"{fct}__days__v{v}"):
                used |= {(r["v"], str(r[DAY])) for r in spark.table(f"{fct}__days__v{v}").collect()}  # a row per day
        else:
            spark.sql(f"drop table if exists {dim}__v{v}")
            spark.sql(f"drop table if exists {fct}__days__v{v}")
    _drop_parts(spark, f"{fct}__parts", lambda v, day: (v, day) not in used)
