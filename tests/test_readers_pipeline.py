"""Readers over landed files, the table upsert, the pipeline and the stream.

Landed inputs are written from the driver's ``events`` table (sf0.001) with
Spark itself: a tab-separated export, Parquet shards and JSON search pages.
"""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from occurra.operators.normalize import normalize_download
from occurra.plans import pipeline as P
from occurra.plans.tables import ensure_raw_table, read_raw, upsert_into_table
from occurra.sources import readers as R
from occurra.sources.fixture import events_as_download_rows, read_events, search_record_json
from occurra.schema import DOWNLOAD_FIELDS

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark, scratch):
    root = os.path.join(scratch, "landed")
    events = read_events(spark, SF_SMALL)
    rows = events_as_download_rows(events).drop("_row")
    tsv = os.path.join(root, "tsv_export")
    keep_ws = {"sep": "\t", "header": "true", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
    rows.coalesce(1).write.options(**keep_ws).csv(os.path.join(tsv, "occurrence"))
    # a metadata member that is the largest file
    with open(os.path.join(tsv, "citations.txt"), "w") as fh:
        fh.write("x\n" * 100000)
    pq = os.path.join(root, "pq_export")
    rows.repartition(4).write.parquet(os.path.join(pq, "occurrence.parquet"))
    rows.limit(2).write.parquet(os.path.join(pq, "metadata"))
    pages = os.path.join(root, "pages")
    recs = search_record_json(events).filter("_request_day <= date '2024-01-03'").collect()
    by_day = {}
    for r in recs:
        by_day.setdefault(r["_request_day"].isoformat(), []).append(json.loads(r["_record"]))
    for d, items in by_day.items():
        os.makedirs(os.path.join(pages, f"day={d}"))
        for i in range(0, len(items), 10):
            chunk = items[i:i + 10]
            page = {"offset": i, "limit": 10, "endOfRecords": i + 10 >= len(items), "results": chunk}
            with open(os.path.join(pages, f"day={d}", f"page-{i:05d}.json"), "w") as fh:
                json.dump(page, fh)
        # a page after the end: must be ignored
        with open(os.path.join(pages, f"day={d}", "page-99999.json"), "w") as fh:
            json.dump({"offset": 99999, "limit": 10, "endOfRecords": True, "results": items[:1]}, fh)
    return {"tsv": tsv, "pq": pq, "pages": pages, "n_rows": rows.count(), "by_day": by_day}


def test_every_text_part_is_read(spark, landed, scratch):
    rows = R.read_download_export(spark, landed["tsv"]).drop("_file", "_block")
    parts = os.path.join(scratch, "two parts (x)")
    keep = {"sep": "\t", "header": "true"}
    rows.repartition(2).write.options(**keep).csv(os.path.join(parts, "data"))
    with open(os.path.join(parts, "Rights.TXT"), "w") as fh:
        fh.write("none\n")
    assert len(R.text_members(spark, parts)) == 2
    assert R.read_download_export(spark, parts).count() == landed["n_rows"]
    one = R.read_download_export(spark, parts, only_largest=True).count()
    assert 0 < one < landed["n_rows"]
    relative = os.path.relpath(parts)
    assert len(R.text_members(spark, relative)) == 2
    # a part with another header fails instead of being read shifted
    rows.limit(3).select(*reversed(rows.columns)).coalesce(1).write.options(**keep).csv(os.path.join(parts, "other"))
    with pytest.raises(Exception, match="header"):
        R.read_download_export(spark, parts).collect()


def test_tsv_reader_and_member_choice(spark, landed):
    member = R.largest_text_member(spark, landed["tsv"])
    assert "occurrence" in member and "citation" not in member
    df = R.arrival_order(R.read_download_export(spark, landed["tsv"]))
    assert df.count() == landed["n_rows"]
    assert set(DOWNLOAD_FIELDS) <= set(df.columns)
    assert {"_file", "_block", "_row"} <= set(df.columns)
    assert df.select("_file", "_block", "_row").distinct().count() == landed["n_rows"]


def test_parquet_reader_skips_metadata(spark, landed):
    df = R.read_download_export(spark, landed["pq"], prefer_parquet=True)
    assert df.count() == landed["n_rows"]


def test_missing_data_raises(spark, scratch):
    empty = os.path.join(scratch, "empty_export")
    os.makedirs(empty)
    with open(os.path.join(empty, "eml.xml"), "w") as fh:
        fh.write("<x/>")
    with pytest.raises(ValueError):
        R.read_download_export(spark, empty)


def test_tsv_and_parquet_normalise_alike(spark, landed):
    a = normalize_download(R.read_download_export(spark, landed["tsv"])).drop("ingestion_ts", "raw_payload")
    b = normalize_download(R.read_download_export(spark, landed["pq"], prefer_parquet=True)).drop(
        "ingestion_ts", "raw_payload")
    # unquoted empty text reads as NULL from CSV and as '' from Parquet
    norm = lambda df: df.select([F.expr(f"nullif(`{c}`, '')").alias(c) if t == "string" else F.col(c)
                                 for c, t in df.dtypes])
    assert norm(a).exceptAll(norm(b)).count() == 0 and norm(b).exceptAll(norm(a)).count() == 0


def test_search_pages(spark, landed):
    recs = R.read_search_pages(spark, landed["pages"])
    expected = sum(len(v) for v in landed["by_day"].values())
    assert recs.count() == expected  # page after the end ignored
    assert {"_request_day", "_offset", "_pos", "gbifID", "media"} <= set(recs.columns)
    # coordinates landed as JSON numbers parse to the same doubles
    from occurra.operators.normalize import normalize_search

    got = {r["gbif_id"]: r["latitude"] for r in normalize_search(recs).collect()}
    want = {str(rec["gbifID"] or rec["key"]): rec["decimalLatitude"]
            for items in landed["by_day"].values() for rec in items
            if (rec["gbifID"] or rec["key"])}
    assert got == want
    # the payload is the whole record, and counts go by their JSON type
    for r in normalize_search(recs).collect():
        rec = json.loads(r["raw_payload"])
        assert rec["recordedBy"].startswith("observer") and "extensions" in rec
        assert rec in landed["by_day"][[d for d in landed["by_day"] if rec in landed["by_day"][d]][0]]
        c = rec["individualCount"]
        if isinstance(c, float):
            assert r["individual_count"] == int(c)


def test_table_upsert_and_pipeline(spark, landed):
    cfg = P.IngestConfig(raw_table="t_raw.observations", mart_database="t_mart",
                         default_start=dt.date(2024, 1, 1))
    stats = P.run_historical(spark, landed["tsv"], "download", 2024, 2024, cfg)
    raw = read_raw(spark, cfg.raw_table)
    n = raw.count()
    assert n == raw.select("gbif_id").distinct().count()
    assert stats.rows_processed == stats.rows_upsert_attempted > 0
    # idempotent rerun
    P.run_historical(spark, landed["tsv"], "download", 2024, 2024, cfg)
    again = read_raw(spark, cfg.raw_table)
    cols = [c for c in again.columns if c != "ingestion_ts"]
    assert again.select(cols).exceptAll(raw.select(cols)).count() == 0
    assert again.count() == n
    # incremental: start = max - 2 days, re-read and upsert; no-op when start > today
    assert P.run_incremental(spark, landed["tsv"], "download", today=dt.date(2024, 1, 2), config=cfg) is None
    inc = P.run_incremental(spark, landed["tsv"], "download", today=dt.date(2024, 2, 1), config=cfg)
    assert inc is not None and inc.rows_processed > 0
    assert read_raw(spark, cfg.raw_table).count() == n
    from occurra.operators.quality import QualityGateError

    with pytest.raises(QualityGateError, match="unique\\(species_id\\)"):
        P.build_and_check(spark, read_raw(spark, cfg.raw_table), cfg, count_check_severity="warn")  # fan-out names
    with pytest.raises(QualityGateError, match="individual_count >= 0"):  # the declared severity
        P.build_and_check(spark, read_raw(spark, cfg.raw_table), cfg)
    models, report = P.build_and_check(
        spark, read_raw(spark, cfg.raw_table), cfg, fail_on=(), raw_table=cfg.raw_table)
    comments = {r["col_name"]: r["comment"] for r in spark.sql("describe table t_mart.stg_belgian_birds").collect()}
    assert all(comments[c] for c in models.stg.columns)
    assert spark.catalog.tableExists("t_mart.stg_belgian_birds")
    assert len(report) == 24
    failing = {r["check_name"] for r in report if r["failing_rows"]}
    assert failing == {"unique(species_id)", "expression_is_true(individual_count >= 0)"}
    assert models.fct.agg(F.sum("observation_records")).first()[0] == models.stg.filter(
        "is_valid_observation and observation_date is not null").count()


def test_search_mode_keeps_every_record(spark, scratch):
    day = os.path.join(scratch, "big_day", "day=2024-01-02")
    os.makedirs(day)
    n = 10_001
    with open(os.path.join(day, "page.json"), "w") as fh:
        json.dump({"offset": 0, "endOfRecords": True, "results": [{"gbifID": str(i), "eventDate": "2024-01-02"} for i in range(n)]}, fh)
    cfg = P.IngestConfig(raw_table="t_raw.big_day")
    P.run_historical(spark, os.path.dirname(day), "search", 2024, 2024, cfg)
    assert read_raw(spark, cfg.raw_table).count() == n


@pytest.mark.parametrize("lower", [False, True])
def test_export_filter_finds_columns_whatever_their_case(spark, lower):
    rows = [
        ("1", "212", "BE", "2024-01-10"), ("2", "359", "BE", "2024-01-10"), ("3", "212", "NL", "2024-01-10"),
        ("4", "212", "BE", "2024-03"), ("5", "212", "BE", None), ("6", "212", "BE", "2023-01-10"),
        ("7", "212", "BE", "2024-01-10T10:00:00/2024-01-11T10:00:00"),
    ]
    names = ["gbifID", "classKey", "countryCode", "eventDate"]
    df = spark.createDataFrame(rows, ", ".join(f"{n.lower() if lower else n} string" for n in names))
    kept = P.filter_export(df, dt.date(2024, 1, 1), dt.date(2024, 12, 31), P.IngestConfig())
    assert sorted(r[0] for r in kept.collect()) == ["1", "4", "5", "7"]


def test_search_mode_caps_per_day(spark, landed):
    cfg = P.IngestConfig(raw_table="t_raw.search_obs", max_per_day=12)
    P.run_historical(spark, landed["pages"], "search", 2024, 2024, cfg)
    raw = read_raw(spark, cfg.raw_table)
    assert raw.count() <= 12 * len(landed["by_day"])
    assert raw.count() == raw.select("gbif_id").distinct().count()


def test_streaming_ingest(spark, landed, scratch):
    from occurra.streaming.landed import start_landed_ingest

    landing = os.path.join(landed["tsv"], "occurrence")
    name = "t_stream_" + os.path.basename(scratch).replace("-", "_")  # fresh progress per run
    q = start_landed_ingest(spark, landing, "t_raw.stream_obs", name=name)
    q.awaitTermination(300)
    raw = read_raw(spark, "t_raw.stream_obs")
    expected = normalize_download(R.read_tsv_export(spark, landing)).count()
    assert raw.count() == expected
    # restart on the same checkpoint: nothing new landed, nothing reprocessed
    before = raw.collect()
    q2 = start_landed_ingest(spark, landing, "t_raw.stream_obs", name=name)
    q2.awaitTermination(300)
    assert q2.lastProgress is None or q2.lastProgress["numInputRows"] == 0
    assert sorted(map(tuple, read_raw(spark, "t_raw.stream_obs").collect())) == sorted(map(tuple, before))


def test_predicate_reaches_parquet_scan(spark, landed):
    """On stored export columns the range predicate is pushed into the scan."""
    rows = R.read_parquet_shards(spark, landed["pq"])
    hits = P.filter_export(rows, dt.date(2024, 1, 5), dt.date(2024, 1, 20), P.IngestConfig())
    plan = hits._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "EqualTo(classKey,212)" in scan and "EqualTo(countryCode,BE)" in scan


def test_mart_reads_prune_and_push(spark, landed):
    """Serving reads of a materialised fact read only used columns and push the
    trailing-window filter into the scan."""
    from occurra.operators import serving as SV

    fct = spark.table("t_mart.fct_daily_species_observations")
    q = SV.daily_trend(fct, days=7, as_of=dt.date(2024, 1, 30))
    plan = q._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan parquet" in line)
    assert "GreaterThanOrEqual(observation_date" in scan
    assert "centroid" not in scan.split("ReadSchema")[1]


def test_search_day_range_prunes_partitions(spark, landed):
    from occurra.operators.incremental import in_date_range

    recs = in_date_range(R.read_search_pages(spark, landed["pages"]), "_request_day",
                         dt.date(2024, 1, 2), dt.date(2024, 1, 2))
    import re

    plan = recs._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[[^\]]*\]", plan)
    assert filters and all("day" in f and "2024-01-02" in f for f in filters)
    assert recs.count() == len(landed["by_day"]["2024-01-02"])


def test_stream_rejects_other_column_order(spark, scratch):
    from pyspark.errors import StreamingQueryException

    from occurra.streaming.landed import DEFAULT_HEADER, start_landed_ingest

    landing = os.path.join(scratch, "misordered_landing")
    os.makedirs(landing)
    header = list(DEFAULT_HEADER)
    header[0], header[2] = header[2], header[0]  # eventDate first, gbifID third
    with open(os.path.join(landing, "export.csv"), "w") as fh:
        fh.write("\t".join(header) + "\n")
        fh.write("\t".join("x" for _ in header) + "\n")
    name = "t_misordered_" + os.path.basename(scratch).replace("-", "_")
    q = start_landed_ingest(spark, landing, "t_raw.misordered", name=name)
    with pytest.raises(StreamingQueryException):
        q.awaitTermination(300)


def test_parquet_mode_pipeline_matches_tsv(spark, landed):
    base = dict(default_start=dt.date(2024, 1, 1))
    P.run_historical(spark, landed["tsv"], "download", 2024, 2024,
                     P.IngestConfig(raw_table="t_raw.from_tsv", **base))
    P.run_historical(spark, landed["pq"], "download", 2024, 2024,
                     P.IngestConfig(raw_table="t_raw.from_pq", prefer_parquet=True, **base))
    cols = [c for c in read_raw(spark, "t_raw.from_tsv").columns
            if c not in ("ingestion_ts", "raw_payload")]
    # unquoted empty CSV text reads as NULL, Parquet keeps '' (documented)
    norm = lambda df: df.select([F.expr(f"nullif(`{c}`, '')").alias(c) if t == "string" else F.col(c)
                                 for c, t in df.select(cols).dtypes])
    a, b = norm(read_raw(spark, "t_raw.from_tsv")), norm(read_raw(spark, "t_raw.from_pq"))
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gaps_of_page_offsets_are_reported(spark, scratch):
    root = os.path.join(scratch, "gappy pages")

    def land(day, offset, n, ends):
        os.makedirs(os.path.join(root, f"day={day}"), exist_ok=True)
        page = {"offset": offset, "limit": 10, "endOfRecords": ends, "results": [{"key": k, "x": [{}]} for k in range(n)]}
        with open(os.path.join(root, f"day={day}", f"p{offset}.json"), "w") as fh:
            json.dump(page, fh)

    for offset, n, ends in ((0, 10, False), (10, 10, False), (20, 3, True), (50, 10, False)):
        land("2024-01-01", offset, n, ends)  # whole; a page after the end doesn't count
    for offset, n, ends in ((10, 10, False), (30, 10, False), (60, 0, False), (90, 4, True)):
        land("2024-01-02", offset, n, ends)
    land("2024-01-03", 0, 10, False)
    got = {(str(r.day), r.missing_from, r.missing_to) for r in R.page_gaps(spark, root).collect()}
    assert got == {("2024-01-02", 0, 9), ("2024-01-02", 20, 29), ("2024-01-02", 40, 59), ("2024-01-03", 10, None)}
    records = R.read_search_pages(spark, root)
    assert records.count() == 23 + 20 + 10
    plan = records._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("JsonToStructs") <= 2 and "parse_json" not in plan
