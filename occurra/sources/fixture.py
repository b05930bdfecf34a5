"""Projections of the driver's ``events`` table into the pipeline's shapes.

The test tables carry no occurrence records, so every pipeline input is
derived from ``events`` with column arithmetic on ``event_id`` (a pure,
per-row projection: it scales with the table and runs as one codegen stage).

* ``events_as_raw``            the 28-column raw table (two taxon-key variants)
* ``events_as_download_rows``  a landed tab-separated export: every value text,
                               with malformed dates, counts and coordinates
* ``search_record_json``       search-API records as JSON texts
* ``events_as_search_records`` the same, parsed as the page reader parses them
* ``upsert_inputs``            target table and a batch with late duplicates; every row is in one
* ``late_copies``              a batch of all rows with late duplicates

Each projection is one ``selectExpr`` (SQL text, parsed once on the JVM).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurra.schema import DOWNLOAD_FIELDS, RAW_COLUMNS
from occurra.sources.readers import parse_search_records, spread

EVENTS = "events"
# The driver table's documented schema (read with it: no footer inference).
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string"
)


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir.rstrip('/')}/{EVENTS}.parquet")


LAT = "((event_id * 37) % 2001) / 10.0D - 100"
LON = "((event_id * 53) % 4001) / 10.0D - 200"
SCI_NAME = "concat(event_type, ' L., ', cast(1700 + user_id as string))"

TAXON_KEY = {
    # several species names per key: drives the join fan-out
    "fanout": "case when event_id % 7 = 0 then null else user_id end",
    # one name per key
    "clean": (
        "case when event_id % 23 = 0 or event_id % 31 = 0 then null "
        "when event_type = 'click' then 101 when event_type = 'view' then 102 "
        "when event_type = 'error' then 103 else null end"
    ),
}


def _sql_type(dtype) -> str:
    return dtype.simpleString()


def raw_projection(variant: str = "fanout") -> list[str]:
    if variant not in TAXON_KEY:
        raise ValueError(f"unknown taxon_key variant {variant!r}")
    derived = {
        "gbif_id": "cast(event_id as string)",
        "event_date": "case when event_id % 29 = 0 then null else cast(ts as date) end",
        "species": (
            "case when event_id % 23 = 0 then '  ' when event_id % 31 = 0 then null "
            "else event_type end"
        ),
        "taxon_key": TAXON_KEY[variant],
        "individual_count": (
            "case when event_id % 13 = 0 then null else cast(floor(value) as int) - 5 end"
        ),
        "latitude": f"case when event_id % 17 = 0 then null else {LAT} end",
        "longitude": f"case when event_id % 19 = 0 then null else {LON} end",
        "scientific_name": SCI_NAME,
        "basis_of_record": "'HUMAN_OBSERVATION'",
        "occurrence_status": "'PRESENT'",
        "country_code": "'BE'",
        "dataset_key": "event_type",
        "key": "event_id",
        "ingestion_ts": "cast(ts as timestamp_ntz)",
        "raw_payload": "props",
    }
    return [
        f"cast({derived.get(name, 'null')} as {_sql_type(dtype)}) as `{name}`"
        for name, dtype in RAW_COLUMNS
    ]


def events_as_raw(events: DataFrame, variant: str = "fanout") -> DataFrame:
    """The raw table: invented NULLs, bad coordinates and negative counts."""
    return events.selectExpr(*raw_projection(variant))


# Eight textual date shapes, chosen by event_id % 8.
EVENT_DATE_TEXT = """case event_id % 8
  when 0 then date_format(ts, 'yyyy-MM-dd')
  when 1 then concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), 'Z')
  when 2 then concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '-05:00')
  when 3 then concat(date_format(ts, 'yyyy-MM-dd'), '/',
                     date_format(date_add(cast(ts as date), 1), 'yyyy-MM-dd'))
  when 4 then date_format(ts, 'yyyy-MM-dd HH:mm:ss')
  when 5 then ''
  when 6 then date_format(ts, 'yyyy-MM')
  else concat('  ', date_format(ts, 'yyyy-M-d'), ' ') end"""

# Six textual count shapes, chosen by event_id % 6.
COUNT_TEXT = """case event_id % 6
  when 0 then cast(cast(floor(value) as int) - 5 as string)
  when 1 then cast(value as string)
  when 2 then ''
  when 3 then 'many'
  when 4 then concat(cast(cast(floor(value) as int) as string), 'e0')
  else concat(' ', cast(cast(floor(value) as int) as string), ' ') end"""


def _coord_text(value: str, salt: int) -> str:
    return (
        f"case (event_id + {salt}) % 7 when 0 then '' when 1 then 'n/a' when 2 then '5d' "
        f"else cast({value} as string) end"
    )


DOWNLOAD_ROW = {
    "gbifID": (
        "case when event_id % 41 = 0 then '' when event_id % 43 = 0 then '  ' "
        "else cast(event_id as string) end"
    ),
    "gbifKey": "cast(event_id + 1000000000 as string)",
    "eventDate": EVENT_DATE_TEXT,
    "species": (
        "case when event_id % 23 = 0 then '   ' when event_id % 31 = 0 then '' "
        "else event_type end"
    ),
    "genus": "case when event_id % 37 = 0 then '' else concat(event_type, 'idae') end",
    "scientificName": SCI_NAME,
    "taxonRank": "'SPECIES'",
    "basisOfRecord": "'HUMAN_OBSERVATION'",
    "occurrenceStatus": "'PRESENT'",
    "individualCount": COUNT_TEXT,
    "decimalLatitude": _coord_text(LAT, 0),
    "decimalLongitude": _coord_text(LON, 3),
    "coordinateUncertaintyInMeters": (
        "case when event_id % 2 = 0 then cast(value as string) else '' end"
    ),
    "countryCode": "case when event_id % 10 = 0 then 'NL' else 'BE' end",
    "stateProvince": "case when user_id % 2 = 0 then 'Flanders' else 'Wallonia' end",
    "datasetKey": "concat('ds-', cast(user_id % 5 as string))",
    "publishingOrgKey": "'org-1'",
    "taxonKey": (
        "case when event_id % 7 = 0 then '' "
        "when event_id % 5 = 0 then concat(cast(user_id as string), '.0') "
        "else cast(user_id as string) end"
    ),
    "family": "'Turdidae'",
    "order": "'Passeriformes'",
    "class": "'Aves'",
    "phylum": "'Chordata'",
    "kingdom": "'Animalia'",
    "issues": (
        "case event_id % 4 when 0 then 'COORDINATE_ROUNDED; GEODETIC_DATUM_ASSUMED_WGS84' "
        "when 1 then '' when 2 then ' ; ' else 'RECORDED_DATE_INVALID' end"
    ),
    "issue": "case when event_id % 4 = 1 then 'ISSUE_FALLBACK' else '' end",
}


def events_as_download_rows(events: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """A landed download export: one text column per export field, plus
    ``classKey`` (the export's class filter column) and ``_row`` (file order);
    in ``min_partitions`` parts at least (default: the default parallelism)."""
    cols = [f"{DOWNLOAD_ROW[n]} as `{n}`" for n in DOWNLOAD_FIELDS]
    cols.append("case when event_id % 9 = 0 then '359' else '212' end as classKey")
    cols.append("event_id as _row")
    # spread the compact source (6 columns) rather than the 26 text columns
    return spread(events, min_partitions).selectExpr(*cols)


def json_object_sql(fields: list[tuple[str, str, str]]) -> str:
    """SQL (also other engines') of a JSON object; kind: text, number or json."""
    def value(kind: str, sql: str) -> str:
        if kind == "text":  # values of the fixture need no escapes
            return f"case when {sql} is null then 'null' else concat('\"', {sql}, '\"') end"
        return f"coalesce(cast({sql} as string), 'null')" if kind == "number" else sql

    pairs = [f"'{'{' if i == 0 else ', '}\"{n}\": ', {value(k, sql)}" for i, (n, k, sql) in enumerate(fields)]
    return f"concat({', '.join(pairs)}, '}}')"


WHOLE = "cast(cast(floor(value) as int) as string)"
# Counts by event_id % 12: whole numbers, text, null, words, numbers with a fraction, padded text.
COUNT_JSON = f"""case event_id % 6
  when 0 then cast(cast(floor(value) as int) - 5 as string)
  when 1 then concat('"', {WHOLE}, '.9"')
  when 2 then 'null'
  when 3 then '"many"'
  when 4 then concat({WHOLE}, case when event_id % 12 = 4 then '.9' else '.0' end)
  else concat('" ', {WHOLE}, ' "') end"""

SEARCH_RECORD = [
    ("gbifID", "text", "case when event_id % 41 = 0 then null else cast(event_id as string) end"),
    ("key", "number", "case when event_id % 82 = 0 then null else event_id end"),
    ("eventDate", "text", EVENT_DATE_TEXT),
    (
        "species", "text",
        "case when event_id % 23 = 0 then null when event_id % 31 = 0 then '' "
        "when event_id % 47 = 0 then '  ' else event_type end",
    ),
    ("genus", "text", "case when event_id % 37 = 0 then null else concat(event_type, 'idae') end"),
    ("family", "text", "'Turdidae'"),
    ("order", "text", "'Passeriformes'"),
    ("class", "text", "'Aves'"),
    ("phylum", "text", "'Chordata'"),
    ("kingdom", "text", "'Animalia'"),
    ("scientificName", "text", SCI_NAME),
    ("taxonRank", "text", "'SPECIES'"),
    ("basisOfRecord", "text", "'HUMAN_OBSERVATION'"),
    ("occurrenceStatus", "text", "'PRESENT'"),
    ("individualCount", "json", COUNT_JSON),
    ("decimalLatitude", "number", f"case when event_id % 17 = 0 then null else {LAT} end"),
    ("decimalLongitude", "number", f"case when event_id % 19 = 0 then null else {LON} end"),
    ("coordinateUncertaintyInMeters", "number", "value"),
    ("countryCode", "text", "'BE'"),
    ("stateProvince", "text", "case when user_id % 2 = 0 then 'Flanders' else 'Wallonia' end"),
    ("datasetKey", "text", "concat('ds-', cast(user_id % 5 as string))"),
    ("publishingOrgKey", "text", "'org-1'"),
    ("taxonKey", "number", "case when event_id % 7 = 0 then null else user_id end"),
    (
        "issues", "json",
        "case event_id % 4 "
        """when 0 then '["COUNTRY_COORDINATE_MISMATCH", "RECORDED_DATE_INVALID"]' """
        """when 1 then '[]' when 3 then '["TAXON_MATCH_FUZZY"]' else 'null' end""",
    ),
    (
        "media", "json",
        "case event_id % 3 when 0 then "
        """concat('[{"type": "StillImage", "identifier": "https://example.org/', cast(event_id as string), """
        """'"}, {"type": "StillImage"}]') when 1 then '[]' else 'null' end""",
    ),
    # fields outside the raw table's columns: only the payload keeps them
    ("recordedBy", "text", "concat('observer ', cast(user_id as string))"),
    ("extensions", "json", """concat('{"depth": [', cast(event_id % 5 as string), ', null]}')"""),
]


def search_record_json(events: DataFrame) -> DataFrame:
    """Search-API records as JSON (``_record``), with the day and place they arrived on."""
    return spread(events).selectExpr(
        f"{json_object_sql(SEARCH_RECORD)} as _record", "cast(ts as date) as _request_day", "event_id as _row"
    )


def events_as_search_records(events: DataFrame) -> DataFrame:
    """Search-API records as the page reader gives them."""
    return parse_search_records(search_record_json(events))


def upsert_inputs(events: DataFrame, variant: str = "fanout") -> tuple[DataFrame, DataFrame]:
    """Target = even ids; batch = odd ids and ids divisible by 3 with count+1, then
    a later second copy of ids divisible by 9 with count+2.  ``_seq`` and ``key``
    give the arrival order of the batch."""
    raw = events_as_raw(events, variant)
    target = raw.filter("key % 2 = 0")
    copies = "explode(case when key % 9 = 0 then array(0, 1) else array(0) end) as _seq"
    batch = raw.filter("key % 2 = 1 or key % 3 = 0").selectExpr("*", copies).withColumn(
        "individual_count", F.expr("individual_count + 1 + _seq")
    )
    return target, batch


def late_copies(events: DataFrame, variant: str = "fanout") -> DataFrame:
    """A batch of all events with count+1, then a later second copy of ids divisible by 9 with count+2."""
    copies = "explode(case when key % 9 = 0 then array(0, 1) else array(0) end) as _seq"
    return events_as_raw(events, variant).selectExpr("*", copies).withColumn(
        "individual_count", F.expr("individual_count + 1 + _seq")
    )


def with_line_breaks(rows: DataFrame) -> DataFrame:
    """Export rows some of whose texts hold line breaks, quotes and tabs."""
    broken = """case when _row % 11 = 0 then concat(stateProvince, '\n"near"\tthe coast\n') else stateProvince end"""
    return rows.withColumn("stateProvince", F.expr(broken))
