"""Work that has to be dealt by the input's size, and done once a row."""

import datetime as dt
import glob

import pytest

import __spark_entry__ as E
from occurra.operators.normalize import legacy_projection, normalize_search
from occurra.sources.fixture import EVENTS_SCHEMA
from occurra.sources.readers import parse_search_records

FILES = 9


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    """A folder with an events table of ``FILES`` files, each a split of its own."""
    root = tmp_path_factory.mktemp("growth")
    rows = [(k, dt.datetime(2024, 1, 1 + k % 28, k % 24), k % 7, "view", k / 3, '{"a": 1}') for k in range(450)]
    spark.createDataFrame(rows, EVENTS_SCHEMA).repartition(FILES).write.parquet(f"{root}/events.parquet")
    return str(root)


@pytest.mark.parametrize("query,part", [("read_tsv_parts", "occurrence/part-*.csv"), ("read_parquet_shards", "occurrence.parquet/part-*")])
def test_exports_land_in_as_many_parts_as_the_input_has(spark, events, tmp_path, monkeypatch, query, part):
    monkeypatch.setattr(E, "_scratch", lambda s: str(tmp_path / "landed"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        rows = E.queries()[query](spark, events).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(glob.glob(f"{tmp_path}/landed/{part}")) == FILES
    assert sorted(r["key"] for r in rows if r["key"] < 450) == [k for k in range(450) if k % 41 and k % 43]


def test_a_search_record_is_parsed_once(spark, events):
    for query in ("normalize_search", "legacy_projection"):
        plan = E.queries()[query](spark, events)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json") == 1, query


def test_parsed_records_keep_every_row(spark):
    texts = ['{"gbifID": "1", "key": 1, "individualCount": 2.9}', '{"key": 7}', '{"gbifID": ""}', "no json", "", None, "{}"]
    rows = parse_search_records(spark.createDataFrame(list(enumerate(texts)), "n int, _record string").repartition(2))
    assert sorted((r["n"], r["_record"]) for r in rows.collect()) == list(enumerate(texts))
    got = {r["gbif_id"]: (r["individual_count"], r["raw_payload"]) for r in normalize_search(rows).collect()}
    assert got == {"1": (2, texts[0]), "7": (1, texts[1])}
    assert legacy_projection(rows).collect() == []
