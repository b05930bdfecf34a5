"""Normalisers P1 / P2 / P4 and the F1 id filter."""

import datetime as dt
import json

from pyspark.sql import types as T

from occurra.operators.normalize import legacy_projection, normalize_download, normalize_search
from occurra.schema import RAW_COLUMNS, SEARCH_RECORD_SCHEMA

TS = dt.datetime(2026, 1, 1, 12, 0, 0)


def _records(spark, rows):
    return spark.createDataFrame(rows, SEARCH_RECORD_SCHEMA)


def _search(**kw):
    base = {f.name: None for f in SEARCH_RECORD_SCHEMA.fields}
    base.update(kw)
    return tuple(base[f.name] for f in SEARCH_RECORD_SCHEMA.fields)


# fixed values: golden rows of the rules
def test_search_record_golden(spark):
    df = _records(spark, [_search(
        gbifID="42", key=42, eventDate="2020-01-02", species="Turdus merula",
        decimalLatitude=50.1, decimalLongitude=4.2, individualCount="2",
        issues=["COUNTRY_COORDINATE_MISMATCH"], media=[("StillImage",)],
    )])
    out = normalize_search(df, ingestion_ts=TS).collect()
    assert len(out) == 1
    r = out[0].asDict()
    assert [c for c in out[0].asDict()] == [n for n, _ in RAW_COLUMNS]
    assert r["gbif_id"] == "42"
    assert r["event_date"] == dt.date(2020, 1, 2)
    assert r["species"] == "Turdus merula"
    assert (r["latitude"], r["longitude"]) == (50.1, 4.2)
    assert r["individual_count"] == 2
    assert r["media_count"] == 1
    assert "COUNTRY_COORDINATE_MISMATCH" in r["issues_json"]
    assert r["ingestion_ts"] == TS
    payload = json.loads(r["raw_payload"])
    assert payload["gbifID"] == "42" and payload["species"] == "Turdus merula"


def test_search_record_without_id_is_dropped(spark):
    df = _records(spark, [_search(key=None), _search(key=0), _search(gbifID="", key=None)])
    assert normalize_search(df).count() == 0


def test_search_falls_back_to_key_and_genus(spark):
    df = _records(spark, [_search(key=7, species="", genus="Parus", individualCount="2.9")])
    r = normalize_search(df).collect()[0]
    assert (r["gbif_id"], r["species"], r["individual_count"], r["media_count"]) == ("7", "Parus", 1, 0)
    assert r["issues_json"] is None


def test_download_row_golden(spark):
    rows = spark.createDataFrame(
        [("99", "2021-06-01", "Parus major", "51.0", "3.7", "A;B")],
        "gbifID string, eventDate string, species string, decimalLatitude string, "
        "decimalLongitude string, issues string",
    )
    r = normalize_download(rows).collect()[0]
    assert r["gbif_id"] == "99"
    assert r["event_date"] == dt.date(2021, 6, 1)
    assert json.loads(r["issues_json"]) == ["A", "B"]
    assert r["media_count"] == 0
    assert r["key"] == 99
    assert r["individual_count"] == 1  # missing -> default
    assert r["genus"] is None  # absent header -> NULL


def test_download_rules(spark):
    rows = spark.createDataFrame(
        [
            (" 5 ", "", "   ", "Parus", "2.9", "5d", "1e1", "7.0", "", "X"),
            ("", "1000000006", "", "Parus", "abc", "50", "4", "", " ; ", "Y"),
            ("  ", "1", "Sp", None, None, None, None, None, None, None),
        ],
        "gbifID string, gbifKey string, species string, genus string, individualCount string, "
        "decimalLatitude string, decimalLongitude string, taxonKey string, issues string, issue string",
    )
    out = {r["gbif_id"]: r for r in normalize_download(rows).collect()}
    assert set(out) == {"5", "1000000006"}  # whitespace id: dropped, no fallback
    a, b = out["5"], out["1000000006"]
    assert a["species"] == "Unknown"  # whitespace species does not fall back to genus
    assert (a["individual_count"], a["latitude"], a["longitude"], a["taxon_key"]) == (2, None, 10.0, 7)
    assert a["key"] == 5
    assert a["issues_json"] == '["X"]'  # '' issues -> falls back to issue
    assert b["species"] == "Parus" and b["individual_count"] == 1 and b["key"] == 1000000006
    assert b["issues_json"] is None  # ' ; ' is truthy but leaves nothing


def test_download_typed_parquet_row(spark):
    schema = T.StructType([
        T.StructField("gbifID", T.LongType()),
        T.StructField("eventDate", T.TimestampNTZType()),
        T.StructField("species", T.StringType()),
        T.StructField("individualCount", T.DoubleType()),
        T.StructField("decimalLatitude", T.DoubleType()),
        T.StructField("taxonKey", T.LongType()),
        T.StructField("issue", T.ArrayType(T.StringType())),
    ])
    rows = spark.createDataFrame(
        [(12, dt.datetime(2024, 3, 15, 23, 0), "Sp", -2.9, 50.5, 9, ["A"]),
         (0, None, "Sp", None, None, None, [])],
        schema,
    )
    out = normalize_download(rows).collect()
    assert len(out) == 1  # id 0 is falsy -> dropped
    r = out[0]
    assert (r["gbif_id"], r["event_date"], r["individual_count"]) == ("12", dt.date(2024, 3, 15), -2)
    assert (r["latitude"], r["taxon_key"], r["issues_json"]) == (50.5, 9, '["A"]')


def test_legacy_projection(spark):
    df = _records(spark, [
        _search(gbifID="1", eventDate="2024-01-02", species="A", decimalLatitude=1.0,
                decimalLongitude=2.0, individualCount="3"),
        _search(gbifID=None, eventDate="2024-01-02", species="", genus="G",
                decimalLatitude=1.0, decimalLongitude=2.0),
        _search(gbifID="3", eventDate="2024-01", species="A", decimalLatitude=1.0, decimalLongitude=2.0),
        _search(gbifID="4", eventDate="2024-01-02", species="A", decimalLatitude=None, decimalLongitude=2.0),
        _search(gbifID="5", eventDate="2024-01-02", species=None, genus=None,
                decimalLatitude=1.0, decimalLongitude=2.0, individualCount="x"),
    ])
    out = sorted(tuple(r) for r in legacy_projection(df).collect())
    d = dt.date(2024, 1, 2)
    assert out == [("1", "A", d, 1.0, 2.0, 3), ("5", "Unknown", d, 1.0, 2.0, 1), ("None", "G", d, 1.0, 2.0, 1)]


def test_download_lower_case_headers(spark):
    rows = spark.createDataFrame(
        [(7, "2024-01-02", "Sp", 50.5)],
        "gbifid bigint, eventdate string, species string, decimallatitude double",
    )
    r = normalize_download(rows).collect()[0]
    assert (r["gbif_id"], r["event_date"], r["latitude"], r["key"]) == ("7", dt.date(2024, 1, 2), 50.5, 7)
