"""Catalog-level behaviour: summary over missing tables, comments, legacy append."""

import uuid

import pytest
from pyspark.sql import functions as F

from occurra.operators.normalize import legacy_projection
from occurra.operators.serving import data_summary_from_catalog
from occurra.plans.models import build_models
from occurra.plans.tables import append_legacy, ensure_raw_table, materialize, upsert_into_table
from occurra.schema import RAW_COLUMNS
from occurra.sources.fixture import events_as_raw, events_as_search_records, read_events

from conftest import SF_SMALL


def test_summary_with_missing_tables(spark):
    row = data_summary_from_catalog(
        spark, "nope.raw", "nope.stg", "nope.fct", "nope.dim"
    ).collect()
    assert len(row) == 1 and all(v is None for v in row[0])


def test_materialize_comments_and_summary(spark):
    raw = events_as_raw(read_events(spark, SF_SMALL))
    raw.write.mode("overwrite").saveAsTable("default.t_raw_for_summary")
    names = materialize(spark, build_models(spark.table("default.t_raw_for_summary")), "t_mart2")
    comments = {
        r["col_name"]: r["comment"] for r in spark.sql(f"describe table {names['fct']}").collect()
    }
    assert all(comments[c] for c in ("individuals_observed", "species_id", "centroid_latitude"))
    s = data_summary_from_catalog(
        spark, "default.t_raw_for_summary", names["stg"], names["fct"], "t_mart2.missing"
    ).first()
    assert s["raw_row_count"] == s["stg_row_count"] == raw.count()
    assert s["mart_daily_rows"] > 0 and s["mart_species_rows"] is None


def test_legacy_append_is_append_only(spark):
    rows = legacy_projection(events_as_search_records(read_events(spark, SF_SMALL)))
    append_legacy(spark, "t_legacy.birds", rows)
    append_legacy(spark, "t_legacy.birds", rows)
    assert spark.table("t_legacy.birds").count() == 2 * rows.count()
    assert [f.name for f in spark.table("t_legacy.birds").schema] == [
        "gbif_id", "species", "date", "latitude", "longitude", "individual_count"]


def test_staging_view_over_raw_table(spark):
    from occurra.plans.tables import create_staging_view

    raw = events_as_raw(read_events(spark, SF_SMALL))
    raw.write.mode("overwrite").saveAsTable("default.t_raw_for_view")
    view = create_staging_view(spark, "default.t_raw_for_view", "t_stg.stg_belgian_birds")
    expected = build_models(spark.table("default.t_raw_for_view")).stg
    assert view.columns == expected.columns
    assert view.exceptAll(expected).count() == 0 and expected.exceptAll(view).count() == 0
    assert spark.catalog.tableExists("t_stg.stg_belgian_birds")


# -- the raw store ----------------------------------------------------------------------------
def files(spark, table):
    """Data files below a store's tables, with their change times."""
    import os

    out = {}
    for name in (f"{table}__loads", f"{table}__snap_0", f"{table}__snap_1"):
        if spark.catalog.tableExists(name):
            where = spark.sql(f"describe formatted {name}").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
            for d, _, names in os.walk(where):
                out |= {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for n in names if n.endswith(".parquet")}
    return out


def rows_of(spark, table):
    return sorted(map(tuple, spark.table(table).select("gbif_id", "individual_count", "species").collect()))


def expected(*loads):
    state = {}
    for load in loads:
        for r in load.select("gbif_id", "individual_count", "species").collect():
            state[r[0]] = tuple(r)
    return sorted(state.values())


@pytest.fixture
def store(spark):
    name = f"t_store_{uuid.uuid4().hex[:8]}.observations"
    ensure_raw_table(spark, name)
    return name


def test_small_batch_writes_only_itself(spark, store):
    raw = events_as_raw(read_events(spark, SF_SMALL))
    upsert_into_table(spark, store, raw, ["key"])
    before = files(spark, store)
    batch = raw.filter("key < 3").withColumn("individual_count", F.lit(77))
    for mode in ("static", "dynamic"):  # neither overwrite mode matters
        was = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        try:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
            upsert_into_table(spark, store, batch, ["key"])
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", was)
    after = files(spark, store)
    assert all(after[f] == t for f, t in before.items()) and len(after) > len(before)
    assert rows_of(spark, store) == expected(raw, batch)


def test_empty_batch_changes_nothing(spark, store):
    raw = events_as_raw(read_events(spark, SF_SMALL))
    upsert_into_table(spark, store, raw, ["key"])
    assert upsert_into_table(spark, store, raw.limit(0), ["key"]) is None
    assert rows_of(spark, store) == expected(raw)


def test_load_without_its_switch_is_not_seen(spark, store, monkeypatch):
    import occurra.plans.tables as TB

    raw = events_as_raw(read_events(spark, SF_SMALL))
    upsert_into_table(spark, store, raw, ["key"])
    batch = raw.filter("key < 50").withColumn("individual_count", F.lit(9))

    def crash(*a, **k):
        raise RuntimeError("stopped")

    for step in (lambda: upsert_into_table(spark, store, batch, ["key"]), lambda: TB.compact(spark, store)):
        with monkeypatch.context() as m:
            m.setattr(TB, "_set_state", crash)
            with pytest.raises(RuntimeError):
                step()
        assert rows_of(spark, store) == expected(raw)
    upsert_into_table(spark, store, batch, ["key"])
    assert rows_of(spark, store) == expected(raw, batch)
    assert TB.compact(spark, store) == 1 and rows_of(spark, store) == expected(raw, batch)
    TB.drop_unused(spark, store)
    assert rows_of(spark, store) == expected(raw, batch)
    assert not spark.catalog.tableExists(f"{store}__snap_0")
    later = raw.filter("key = 1").withColumn("individual_count", F.lit(5))
    upsert_into_table(spark, store, later, ["key"])
    assert rows_of(spark, store) == expected(raw, batch, later)


def test_batch_is_read_once(spark, store):
    raw = events_as_raw(read_events(spark, SF_SMALL))
    acc = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            acc.add(b.num_rows)
            yield b

    counted = raw.mapInArrow(seen, raw.schema)
    upsert_into_table(spark, store, counted, ["key"])
    assert acc.value == raw.count()


def test_raw_store_has_descriptions(spark, store):
    comments = {r["col_name"]: r["comment"] for r in spark.sql(f"describe table {store}").collect()}
    assert all(comments[n] for n, _ in RAW_COLUMNS)
