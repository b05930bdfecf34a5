"""Marts refreshed from loads equal a full build, and write only what was touched."""

import uuid

import pytest
from pyspark.sql import functions as F

from occurra.operators.quality import QualityGateError
from occurra.plans import refresh as RF
from occurra.plans import tables as TB
from occurra.plans.models import build_models
from occurra.sources.fixture import events_as_raw, read_events

from conftest import SF_SMALL


@pytest.fixture
def names():
    one = uuid.uuid4().hex[:6]
    return f"t_refresh_{one}.observations", f"t_refresh_marts_{one}"


def rows(df):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else str(v) for v in r) for r in df.collect())


def equal_to_full(spark, store, database):
    full = build_models(spark.table(store))
    marts = TB.mart_names(database)
    assert rows(spark.table(marts["dim"]).select(*full.dim.columns)) == rows(full.dim)
    assert rows(spark.table(marts["fct"]).select(*full.fct.columns)) == rows(full.fct)


def test_five_overlapping_loads(spark, names):
    store, database = names
    fct = TB.mart_names(database)["fct"]
    raw = spark.createDataFrame(events_as_raw(read_events(spark, SF_SMALL)).filter("key < 400").collect(), events_as_raw(read_events(spark, SF_SMALL)).schema)
    TB.ensure_raw_table(spark, store, buckets=2)
    TB.upsert_into_table(spark, store, raw.filter("key < 300").coalesce(1), ["key"])
    TB.compact(spark, store)
    assert RF.refresh_marts(spark, store, database) == "full" and RF.refresh_marts(spark, store, database) == "none"
    steps = [
        raw.filter("key between 250 and 320"),  # new rows and the same rows again
        raw.filter("key % 40 = 3").withColumn("event_date", F.expr("date '2024-01-02'")),  # rows that leave their days
        raw.filter("key % 50 = 7").withColumn("species", F.lit("corvus")).withColumn("taxon_key", F.lit(None).cast("long")),
        raw.filter("key % 30 = 1").withColumn("latitude", F.lit(None).cast("double")),  # no longer valid
        raw.filter("event_date = date '2024-01-05'").withColumn("event_date", F.lit(None).cast("date")),  # a day that empties
    ]
    for step, batch in enumerate(steps):
        days = {str(r[0]) for r in spark.table(store).join(batch.select("gbif_id"), "gbif_id", "left_semi").select("event_date").collect()}
        days |= {str(r[0]) for r in batch.select("event_date").collect()}
        TB.upsert_into_table(spark, store, batch.coalesce(1), ["key"])
        if step == 2:
            TB.upkeep(spark, store, fan=3, share=9.0)  # merges loads, also ones that the marts know
        assert RF.refresh_marts(spark, store, database) == "partial"
        equal_to_full(spark, store, database)
        version = RF._built(spark, fct)["version"]
        wrote = {r[0].split("=")[-1] for r in spark.sql(f"show partitions {fct}__parts").collect() if r[0].startswith(f"v={version}/")}
        if step != 2:
            assert wrote <= days and (wrote or step == 4)
    assert "2024-01-05" not in {str(r[0]) for r in spark.table(fct).select("observation_date").collect()}
    assert len(RF._versions(spark, database, TB.mart_names(database))) == 2
    TB.compact(spark, store)
    assert RF.refresh_marts(spark, store, database) == "full"
    equal_to_full(spark, store, database)

    def fails(written):
        assert written["fct"].count() >= 0
        raise QualityGateError("no")

    before = rows(spark.table(fct))
    TB.upsert_into_table(spark, store, raw.filter("key < 30").withColumn("individual_count", F.lit(500)).coalesce(1), ["key"])
    with pytest.raises(QualityGateError):
        RF.refresh_marts(spark, store, database, check=fails)
    assert rows(spark.table(fct)) == before
    assert RF.refresh_marts(spark, store, database) == "partial"
    equal_to_full(spark, store, database)
