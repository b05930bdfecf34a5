"""Raw store upkeep: merged loads, retention, buckets, watermark, stream ledger; staged marts."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from occurra.operators import incremental as INC
from occurra.operators.quality import QualityGateError
from occurra.plans import pipeline as P
from occurra.plans import tables as TB
from occurra.plans.models import build_models
from occurra.sources.fixture import events_as_download_rows, events_as_raw, read_events
from occurra.streaming.landed import start_landed_ingest

from conftest import SF_SMALL


@pytest.fixture
def store(spark):
    name = f"t_store_{uuid.uuid4().hex[:8]}.observations"
    TB.ensure_raw_table(spark, name, buckets=2)
    return name


@pytest.fixture(scope="module")
def raw(spark):
    rows = events_as_raw(read_events(spark, SF_SMALL)).filter("key < 200").collect()
    return spark.createDataFrame(rows, events_as_raw(read_events(spark, SF_SMALL)).schema).coalesce(1)


def held(spark, table):
    return {(r.gbif_id, r.individual_count, r.event_date) for r in spark.table(table).collect()}


def scanned(spark, table):
    return INC.first_value(INC.max_event_date(spark.table(table)), "max_event_date")


def test_many_batches_leave_few_loads_and_rewrite_little(spark, store, raw, monkeypatch):
    """Random overlapping batches, replacing later dates by earlier ones too, against a plain dict."""
    rng, state, written, batches, fan = random.Random(4), {}, [], 30, 3
    stats = TB._stats
    monkeypatch.setattr(TB, "_stats", lambda *a: written.append(stats(*a)) or written[-1])
    rows = raw.collect()
    for step in range(batches):
        picked = [r.asDict() | {"individual_count": step, "event_date": None if rng.random() < 0.2 else
                  dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 9 if step < 20 else 3))} for r in rng.sample(rows, 6)]
        TB.upsert_into_table(spark, store, spark.createDataFrame(picked, raw.schema).coalesce(1), ["key"])
        TB.upkeep(spark, store, fan=fan, grace_seconds=0)
        state |= {r["gbif_id"]: (r["gbif_id"], step, r["event_date"]) for r in picked}
        at = TB._state(spark, store)
        levels = [x[1] for x in at.loads]
        assert all(levels.count(v) < fan for v in levels) and levels == sorted(levels, reverse=True)
        assert sorted(TB._load_ids(spark, store)) == at.ids  # nothing unused is left
        if step % 5 == 4 or step > 25:
            assert held(spark, store) == set(state.values())
        assert TB.max_event_date(spark, store) == max((d for _, _, d in state.values() if d), default=None)
    assert scanned(spark, store) == TB.max_event_date(spark, store)
    assert len(TB._state(spark, store).loads) <= 6
    assert sum(n for n, _ in written) <= 6 * batches * 4  # every row is rewritten a few times


def test_merged_loads_without_a_due_snapshot(spark, store, raw):
    TB.upsert_into_table(spark, store, raw, ["key"])
    TB.compact(spark, store)
    snapshot = TB._state(spark, store).snapshot
    for step in range(4):
        TB.upsert_into_table(spark, store, raw.filter(f"key in ({step}, {step + 1}, 7)").withColumn("individual_count", F.lit(step)), ["key"])
        TB.upkeep(spark, store, fan=2, grace_seconds=0)
    at = TB._state(spark, store)
    assert at.snapshot == snapshot and [x[1] for x in at.loads] == [2]
    assert {k: c for k, c, _ in held(spark, store) if c in range(4) and len(k) == 1 and k in "012347"} == {"0": 0, "1": 1, "2": 2, "3": 3, "4": 3, "7": 3}


def test_readers_of_an_earlier_state_finish_within_the_grace(spark, store, raw):
    TB.upsert_into_table(spark, store, raw, ["key"])
    reader = spark.table(store)
    before = reader._jdf.queryExecution().executedPlan() and {r.gbif_id for r in raw.collect()}
    TB.upsert_into_table(spark, store, raw.filter("key < 5"), ["key"])
    TB.compact(spark, store)
    TB.drop_unused(spark, store, grace_seconds=3600)
    assert {r.gbif_id for r in reader.collect()} == before
    assert spark.catalog.tableExists(f"{store}__snap_0") and len(TB._load_ids(spark, store)) == 2
    TB.drop_unused(spark, store)
    assert not spark.catalog.tableExists(f"{store}__snap_0") and TB._load_ids(spark, store) == []
    assert TB._state(spark, store).retired == [] and spark.table(store).count() == len(before)


def test_snapshot_isnt_shuffled(spark, store, raw):
    TB.upsert_into_table(spark, store, raw, ["key"])
    TB.compact(spark, store)
    TB.upsert_into_table(spark, store, raw.filter("key < 50"), ["key"])
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        plan = spark.table(store)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_uniqueness_is_checked_for_a_loads_keys_only(spark, store, raw):
    from occurra.operators.quality import check_unique

    TB.upsert_into_table(spark, store, raw, ["key"])
    TB.compact(spark, store)
    load = TB.upsert_into_table(spark, store, raw.filter("key < 50"), ["key"])
    assert TB.check_unique_after_load(spark, store, load).collect() == []
    # rows that another writer repeats are found by a load that holds their keys as by the full check
    state = TB._state(spark, store)
    view = f"{store}_doubled"
    spark.sql(f"create or replace view {view} as {TB.state_sql(store, state.snapshot, state.ids)} union all select * from {store} where key in (3, 4)")
    spark.sql(f"create or replace view {view}__loads as select * from {store}__loads")
    found = TB.check_unique_after_load(spark, view, load).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, check_unique(spark.table(view), "gbif_id").collect())) and len(found) == 2
    later = load
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        plan = TB.check_unique_after_load(spark, store, later)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange") <= 1  # of the rows that are counted, after the joins


def test_rows_without_a_key_fail(spark, store, raw):
    broken = raw.limit(3).withColumn("gbif_id", F.when(F.col("key") != 1, F.col("gbif_id")))
    with pytest.raises(Exception, match="no gbif_id"):
        TB.upsert_into_table(spark, store, broken, ["key"])
    assert spark.table(store).count() == 0


def test_watermark_reads_no_file_and_an_incremental_run_begins_there(spark, store, raw):
    assert TB.max_event_date(spark, store) is None
    TB.upsert_into_table(spark, store, raw, ["key"])
    last = scanned(spark, store)
    assert TB.max_event_date(spark, store) == last
    # the rows of the last day are replaced by earlier ones: the watermark goes back
    gone = raw.filter(F.col("event_date") == F.lit(last)).withColumn("event_date", F.lit(dt.date(2023, 5, 1)))
    TB.upsert_into_table(spark, store, gone, ["key"])
    assert TB.max_event_date(spark, store) == scanned(spark, store) < last
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("watermark", "none")
    try:
        TB.max_event_date(spark, store)
        assert not tracker.getJobIdsForGroup("watermark")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for day in (None, dt.date(2024, 1, 9), dt.date(2025, 3, 3)):
        frame = spark.createDataFrame([(day,)], "event_date date")
        rule = INC.first_value(INC.incremental_start(frame, "2024-12-31", 3), "start_date")
        assert INC.start_after(day, "2024-12-31", 3) == rule


def test_a_batch_delivered_twice_around_a_later_one_is_left_out(spark, store, raw):
    old = raw.filter("key < 9").withColumn("individual_count", F.lit(1))
    new = raw.filter("key < 9").withColumn("individual_count", F.lit(2))
    assert TB.upsert_into_table(spark, store, old, ["key"], stream=("s", 0)) == 1
    assert TB.upsert_into_table(spark, store, new, ["key"], stream=("s", 1)) == 2
    TB.compact(spark, store)
    assert TB.upsert_into_table(spark, store, old, ["key"], stream=("s", 0)) is None
    assert {c for _, c, _ in held(spark, store)} == {2}
    assert TB.upsert_into_table(spark, store, old, ["key"], stream=("another", 0)) is not None


def test_the_stream_keeps_its_store_in_shape(spark, scratch):
    landing, table = os.path.join(scratch, "landing for upkeep"), f"t_stream_{uuid.uuid4().hex[:6]}.raw"
    keep = {"sep": "\t", "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows = events_as_download_rows(read_events(spark, SF_SMALL)).filter("_row between 1 and 30").drop("_row")
    name = f"upkeep_{uuid.uuid4().hex[:6]}"
    for step in range(5):
        said = rows.withColumn("stateProvince", F.lit(f"step {step}\n\"two\" lines"))
        said.coalesce(1).write.mode("append").options(**keep).csv(landing)
        start_landed_ingest(spark, landing, table, name=name, fan=2, grace_seconds=0).awaitTermination()
    at = TB._state(spark, table)
    assert len(at.loads) <= 2 and at.snapshot > 0 and list(at.streams.values()) == [4]
    assert {r.state_province for r in spark.table(table).collect()} == {"step 4\n\"two\" lines"}


def test_marts_are_published_after_their_checks(spark, raw):
    database = f"t_marts_{uuid.uuid4().hex[:6]}"
    first = TB.materialize(spark, build_models(raw.filter("key < 100")), database)
    before = {s: spark.table(first[s]).count() for s in ("dim", "fct")}

    def fails(written):
        assert written["dim"].count() > before["dim"]
        raise QualityGateError([])

    with pytest.raises(QualityGateError):
        TB.materialize(spark, build_models(raw), database, check=fails)
    assert {s: spark.table(first[s]).count() for s in ("dim", "fct")} == before  # readers still see the old marts
    for _ in range(3):
        TB.materialize(spark, build_models(raw), database)
    assert spark.table(first["dim"]).count() > before["dim"]
    assert TB._mart_versions(spark, database, "dim_species") == [4, 5]


def test_a_failing_mart_check_keeps_the_old_marts(spark, raw):
    cfg = P.IngestConfig(mart_database=f"t_gate_{uuid.uuid4().hex[:6]}")
    one_name = raw.withColumn("species", F.lit("corvus")).withColumn("individual_count", F.lit(1))
    P.build_and_check(spark, one_name, cfg)
    names = TB.mart_names(cfg.mart_database)
    before = spark.table(names["dim"]).collect()
    fan_out = raw.withColumn("individual_count", F.lit(1))  # several names of a taxon: species_id isn't unique
    with pytest.raises(QualityGateError):
        P.build_and_check(spark, fan_out, cfg)
    assert spark.table(names["dim"]).collect() == before
