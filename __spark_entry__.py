"""

Every query reads the driver's parquet tables under ``sf_dir`` (only
``events`` is relevant to this pipeline) and derives its input with the
projections in ``occurra.sources.fixture``.  The oracle SQL recomputes the same
result in DuckDB from the same ``events`` view; column names, their order and
the formulas of the models are fixed values that both sides have to state.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

# the package lives next to this file; importable however this module is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from occurra.functions.expr import parse_event_date_sql
from occurra.operators import incremental as INC
from occurra.operators import quality as Q
from occurra.operators import serving as SV
from occurra.operators import upsert as UP
from occurra.operators.normalize import legacy_projection, normalize_download, normalize_search
from occurra.operators.staging import quality_tag_counts
from occurra.plans.models import Models, build_models
from occurra.plans.pipeline import IngestConfig, filter_export
from occurra.plans.refresh import refresh_marts
from occurra.plans.tables import compact, ensure_raw_table, mart_names, materialize, max_event_date, read_raw, upkeep, upsert_into_table
from occurra.schema import RAW_COLUMNS
from occurra.sources.fixture import (
    events_as_download_rows,
    events_as_raw,
    events_as_search_records,
    json_object_sql,
    late_copies,
    read_events,
    search_record_json,
    upsert_inputs,
    with_line_breaks,
)
from occurra.sources.readers import read_download_export, read_search_pages
from occurra.sources.predicate import (
    CLASS_KEY,
    COUNTRY,
    EVENT_DATE,
    predicate_to_column,
    range_predicate,
)

try:  # the training-data operators are optional; what breaks inside them isn't
    import corpus_pipeline
    from occurra.llm import queries as LLM
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "occurra.llm"):
        raise
    corpus_pipeline = LLM = None

# Fixed parameters of the registered queries.
AS_OF = dt.date(2024, 1, 30)  # literal "today" for trailing windows
WINDOW_DAYS = 7
TAIL_ROWS = 20
TOP_SPECIES_LIMIT = 20
ACTIVITY_LIMIT = 50
GEO_LIMIT = 1000

HISTORICAL = (dt.date(2024, 1, 5), dt.date(2024, 1, 20))
CAP_PER_DAY = 50
INCREMENTAL_DEFAULT_START = dt.date(2024, 1, 1)
LOOKBACK_DAYS = 2
TARGET_LOADED_UNTIL = dt.date(2024, 1, 24)  # state of the table before the incremental run
PREDICATE = range_predicate("BE", 212, dt.date(2024, 1, 5), dt.date(2024, 1, 20))
PREDICATE_COLUMNS = {
    CLASS_KEY: ("classKey", "string"),
    COUNTRY: ("countryCode", "string"),
    EVENT_DATE: (parse_event_date_sql("eventDate"), "date"),
}
# Run-dependent columns left out of normaliser comparisons.
VOLATILE = ("ingestion_ts",)

SMOKE_DIR = "/root/testdata/sf0.001"


def _models(spark: SparkSession, sf_dir: str, variant: str = "fanout") -> Models:
    return build_models(events_as_raw(read_events(spark, sf_dir), variant))


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def q_scan_raw(spark, sf_dir):
    return _models(spark, sf_dir).raw


def q_stg_observations(spark, sf_dir):
    return _models(spark, sf_dir).stg


def q_quality_tag_counts(spark, sf_dir):
    return quality_tag_counts(_models(spark, sf_dir).stg)


def q_dim_species(spark, sf_dir):
    return _models(spark, sf_dir).dim


def q_fct_daily(spark, sf_dir):
    return _models(spark, sf_dir).fct


def q_dim_species_clean(spark, sf_dir):
    return _models(spark, sf_dir, "clean").dim


def q_top_species(spark, sf_dir):
    m = _models(spark, sf_dir)
    return SV.top_species(m.fct, m.dim, TOP_SPECIES_LIMIT)


def q_top_species_deduped(spark, sf_dir):
    m = _models(spark, sf_dir)
    return SV.top_species(m.fct, m.dim, TOP_SPECIES_LIMIT, dedupe_names=True)


def q_top_species_individuals(spark, sf_dir):
    m = _models(spark, sf_dir)
    return SV.top_species_individuals(m.fct, m.dim, TOP_SPECIES_LIMIT)


def q_species_activity(spark, sf_dir):
    return SV.species_activity(_models(spark, sf_dir).dim, ACTIVITY_LIMIT)


def q_geo_density(spark, sf_dir):
    return SV.geo_density(_models(spark, sf_dir).fct, 2, GEO_LIMIT)


def q_geo_density_clean(spark, sf_dir):
    return SV.geo_density(_models(spark, sf_dir, "clean").fct, 2, GEO_LIMIT)


def q_daily_trend(spark, sf_dir):
    return SV.daily_trend(_models(spark, sf_dir).fct)


def q_daily_trend_window(spark, sf_dir):
    return SV.daily_trend(_models(spark, sf_dir).fct, days=WINDOW_DAYS, as_of=AS_OF)


def q_daily_trend_tail(spark, sf_dir):
    return SV.last_n_days_rows(SV.daily_trend(_models(spark, sf_dir).fct), TAIL_ROWS)


def q_data_summary(spark, sf_dir):
    m = _models(spark, sf_dir)
    return SV.data_summary(spark, m.raw, m.stg, m.fct, m.dim)


def q_dq_not_null(spark, sf_dir):
    checks = [c for c in Q.declared_checks() if "not_null" in c.tags]
    return Q.dq_report(_models(spark, sf_dir).tables(), checks)


def q_dq_unique_species_id(spark, sf_dir):
    return Q.check_unique(_models(spark, sf_dir).dim, "species_id")


def q_dq_accepted_values(spark, sf_dir):
    return Q.check_accepted_values(_models(spark, sf_dir).stg, "is_valid_observation", [True, False])


def q_dq_expression_count(spark, sf_dir):
    return Q.check_expression(_models(spark, sf_dir).stg, "individual_count >= 0")


def q_dq_expression_where(spark, sf_dir):
    return Q.check_expression(
        _models(spark, sf_dir).stg,
        "latitude is not null and longitude is not null and latitude between -90 and 90 "
        "and longitude between -180 and 180",
        where="is_valid_observation",
    )


def q_dq_expression_marts(spark, sf_dir):
    checks = [
        c
        for c in Q.declared_checks()
        if "expression" in c.tags and c.table in ("dim_species", "fct_daily_species_observations")
    ]
    return Q.dq_report(_models(spark, sf_dir).tables(), checks)


def q_dq_unique_combination(spark, sf_dir):
    return Q.check_unique_combination(_models(spark, sf_dir).fct, ["observation_date", "species_id"])


def q_dq_relationships(spark, sf_dir):
    m = _models(spark, sf_dir)
    return Q.check_relationship(m.fct, "species_id", m.dim, "species_id")


def q_dq_valid_lat_lon(spark, sf_dir):
    return Q.check_valid_lat_lon(_models(spark, sf_dir).stg)


def q_dq_report(spark, sf_dir):
    return Q.dq_report(_models(spark, sf_dir).tables(), Q.declared_checks())


# --- normalisers, predicate, legacy -----------------------------------------
def q_normalize_download(spark, sf_dir):
    rows = events_as_download_rows(read_events(spark, sf_dir))
    return normalize_download(rows).drop(*VOLATILE)


def q_normalize_search(spark, sf_dir):
    records = events_as_search_records(read_events(spark, sf_dir))
    return normalize_search(records).drop(*VOLATILE)


def q_historical_load(spark, sf_dir):
    """Range filter and normalising of an export with lower-case headers; undated rows stay."""
    rows = events_as_download_rows(read_events(spark, sf_dir)).drop("_row")
    lower = rows.toDF(*[c.lower() for c in rows.columns])
    config = IngestConfig()
    return normalize_download(filter_export(lower, *HISTORICAL, config)).drop(*VOLATILE)


def q_legacy_projection(spark, sf_dir):
    return legacy_projection(events_as_search_records(read_events(spark, sf_dir)))


def q_predicate_filter(spark, sf_dir):
    rows = events_as_download_rows(read_events(spark, sf_dir))
    hits = rows.filter(predicate_to_column(PREDICATE, PREDICATE_COLUMNS))
    return normalize_download(hits).select(
        "gbif_id", "event_date", "country_code", "species", "individual_count"
    )


def q_ingest_stats(spark, sf_dir):
    rows = events_as_download_rows(read_events(spark, sf_dir))
    return UP.ingest_stats(normalize_download(rows))


# --- upsert, de-duplication, caps -------------------------------------------
def q_dedupe_last_wins(spark, sf_dir):
    return UP.dedupe_last(late_copies(read_events(spark, sf_dir)), "gbif_id", ["_seq", "key"])


def q_upsert_by_key(spark, sf_dir):
    target, batch = upsert_inputs(read_events(spark, sf_dir))
    return UP.upsert_by_key(target, batch, "gbif_id", ["_seq", "key"])


def q_cap_per_day(spark, sf_dir):
    raw = events_as_raw(read_events(spark, sf_dir))
    arrivals = raw.selectExpr("*", "cast(ingestion_ts as date) as request_day")
    return UP.cap_per_group(arrivals, ["request_day"], ["key"], CAP_PER_DAY)


# --- the raw store and the readers over landed files --------------------------
def _scratch(spark) -> str:
    """A new folder below the shared checkpoint folder; one beside the warehouse where none is set."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return f"{(configured or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/occurra-{uuid.uuid4().hex}"


def q_upsert_table_state(spark, sf_dir):
    """K1 / K2: two overlapping loads, a compaction between, read back through the view."""
    target, batch = upsert_inputs(read_events(spark, sf_dir))
    database = f"occurra_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{_scratch(spark)}'")
    table = f"{database}.observations"
    ensure_raw_table(spark, table)
    upsert_into_table(spark, table, target, ["key"])
    compact(spark, table)
    upsert_into_table(spark, table, batch, ["_seq", "key"])
    return read_raw(spark, table)


def _refreshed(spark, sf_dir) -> dict[str, str]:
    """Marts built from one load and refreshed after two overlapping ones; their names."""
    target, batch = upsert_inputs(read_events(spark, sf_dir))
    database = f"occurra_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{_scratch(spark)}'")
    table = f"{database}.observations"
    ensure_raw_table(spark, table)
    upsert_into_table(spark, table, target, ["key"])
    refresh_marts(spark, table, database)
    for part in (batch.filter("key % 3 = 0"), batch.filter("key % 3 <> 0")):
        upsert_into_table(spark, table, part, ["_seq", "key"])
        refresh_marts(spark, table, database)
    return mart_names(database)


def q_fct_refreshed(spark, sf_dir):
    """A2 / K6: the daily fact, refreshed from loads."""
    return spark.table(_refreshed(spark, sf_dir)["fct"])


def q_dim_refreshed(spark, sf_dir):
    """A1 / K6: the species dimension, refreshed from loads."""
    return spark.table(_refreshed(spark, sf_dir)["dim"])


def q_catalog_summary(spark, sf_dir):
    """Raw store, staging view and published marts in the catalog, and their summary."""
    database = f"occurra_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{_scratch(spark)}'")
    table = f"{database}.observations"
    ensure_raw_table(spark, table)
    for k in range(3):  # loads, two of which are merged
        upsert_into_table(spark, table, events_as_raw(read_events(spark, sf_dir)).filter(f"key % 3 = {k}"), ["key"])
    upkeep(spark, table, fan=2)
    names = materialize(spark, build_models(read_raw(spark, table)), database, raw_table=table)
    return SV.data_summary_from_catalog(spark, table, names["stg"], names["fct"], names["dim"])


def _export_parts(spark) -> int:
    """Parts of a landed export: several, at least one a core; a larger input has one a split, so none grows with it."""
    return max(3, spark.sparkContext.defaultParallelism)


def q_read_tsv_parts(spark, sf_dir):
    """The export landed as several text parts beside metadata, read back; with quoted line breaks."""
    root = _scratch(spark)
    rows = with_line_breaks(events_as_download_rows(read_events(spark, sf_dir), _export_parts(spark))).drop("_row")
    keep = {"sep": "\t", "header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    rows.write.options(**keep).csv(f"{root}/occurrence")
    rows.limit(5).write.options(**keep).csv(f"{root}/rights")  # by its name no data
    return normalize_download(read_download_export(spark, root)).drop(*VOLATILE)


def q_read_parquet_shards(spark, sf_dir):
    """The export landed as Parquet shards beside metadata, read back."""
    root = _scratch(spark)
    rows = events_as_download_rows(read_events(spark, sf_dir), _export_parts(spark)).drop("_row")
    rows.write.parquet(f"{root}/occurrence.parquet")
    rows.limit(5).write.parquet(f"{root}/metadata")
    landed = read_download_export(spark, root, prefer_parquet=True)
    return normalize_download(landed).drop(*VOLATILE)


def q_read_search_pages(spark, sf_dir):
    """All records landed as pages by day, with a page after each day's end, read back."""
    root = _scratch(spark)
    records = search_record_json(read_events(spark, sf_dir))
    paged = records.selectExpr("_record", "_row", "_request_day as day", "_row div 40 as page").groupBy("day", "page").agg(
        F.expr("array_join(transform(array_sort(collect_list(struct(_row, _record))), x -> x._record), ', ')").alias("r")
    )
    ends = paged.groupBy("day").agg(F.max("page").alias("last"))
    pages = paged.join(ends, "day").selectExpr(
        "day", "explode(case when page = last then array(0, 1) else array(0) end) as after", "page", "last", "r"
    )
    text = pages.selectExpr(
        "day",
        "concat('{\"offset\": ', cast(page * 40 + after as string), ', \"limit\": 40, \"endOfRecords\": ', "
        "case when page = last then 'true' else 'false' end, ', \"results\": [', r, ']}') as value",
    )
    text.write.partitionBy("day").text(root)
    landed = read_search_pages(spark, root, multi_line=False)
    return normalize_search(landed).drop(*VOLATILE)


# --- incremental -------------------------------------------------------------
def q_max_event_date(spark, sf_dir):
    return INC.max_event_date(_models(spark, sf_dir).raw)


def q_incremental_start(spark, sf_dir):
    return INC.incremental_start(
        _models(spark, sf_dir).raw, INCREMENTAL_DEFAULT_START, LOOKBACK_DAYS
    )


def q_calendar_days(spark, sf_dir):
    return INC.days_spanned(_models(spark, sf_dir).raw, "event_date")


def q_store_watermark(spark, sf_dir):
    """The raw store's own latest date after a load that takes the last days away."""
    database = f"occurra_{uuid.uuid4().hex}"
    spark.sql(f"create database {database} location '{_scratch(spark)}'")
    table = f"{database}.observations"
    ensure_raw_table(spark, table)
    raw = _models(spark, sf_dir).raw
    upsert_into_table(spark, table, raw, ["key"])
    late = raw.filter(f"event_date > date '{TARGET_LOADED_UNTIL}'").withColumn("event_date", F.lit(None).cast("date"))
    upsert_into_table(spark, table, late, ["key"])
    return spark.createDataFrame([(max_event_date(spark, table),)], "max_event_date date")


def q_incremental_run(spark, sf_dir):
    """I2-I4 + K2: re-read [max - lookback, as_of] and upsert it into the table."""
    raw = _models(spark, sf_dir).raw
    target = raw.filter(f"event_date is null or event_date <= date '{TARGET_LOADED_UNTIL}'")
    start = INC.first_value(
        INC.incremental_start(target, INCREMENTAL_DEFAULT_START, LOOKBACK_DAYS), "start_date"
    )
    if start > AS_OF:
        return target
    batch = INC.in_date_range(raw, "event_date", start, AS_OF).withColumn(
        "individual_count", F.col("individual_count") + F.lit(1)
    )
    return UP.upsert_by_key(target, batch, "gbif_id")


# ---------------------------------------------------------------------------
# Contract
# ---------------------------------------------------------------------------
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: top species by individuals (fact LEFT JOIN dim) at sf0.001."""
    return q_top_species(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {
        name[2:]: fn
        for name, fn in globals().items()
        if name.startswith("q_") and callable(fn)
    }
    if LLM is not None:
        out |= LLM.queries() | {"pipeline": corpus_pipeline.run}
    return out


# ---------------------------------------------------------------------------
# DuckDB oracle (independent SQL over the ``events`` view)
# ---------------------------------------------------------------------------
def _raw_sql(variant: str = "fanout") -> str:
    if variant == "fanout":
        taxon = "case when event_id % 7 = 0 then null else user_id end"
    else:
        taxon = (
            "case when event_id % 23 = 0 or event_id % 31 = 0 then null "
            "when event_type = 'click' then 101 when event_type = 'view' then 102 "
            "when event_type = 'error' then 103 else null end"
        )
    return f"""
    select
      cast(event_id as varchar) as gbif_id,
      case when event_id % 29 = 0 then null else cast(ts as date) end as event_date,
      cast(null as varchar) as event_date_raw,
      case when event_id % 23 = 0 then '  ' when event_id % 31 = 0 then null
           else event_type end as species,
      concat(event_type, ' L., ', cast(1700 + user_id as varchar)) as scientific_name,
      cast(null as varchar) as taxon_rank,
      'HUMAN_OBSERVATION' as basis_of_record,
      'PRESENT' as occurrence_status,
      case when event_id % 13 = 0 then null
           else cast(floor(value) as integer) - 5 end as individual_count,
      case when event_id % 17 = 0 then null
           else ((event_id * 37) % 2001) / 10.0::double - 100 end as latitude,
      case when event_id % 19 = 0 then null
           else ((event_id * 53) % 4001) / 10.0::double - 200 end as longitude,
      cast(null as double) as coordinate_uncertainty_m,
      'BE' as country_code,
      cast(null as varchar) as state_province,
      event_type as dataset_key,
      cast(null as varchar) as publishing_org_key,
      cast(event_id as bigint) as key,
      cast({taxon} as bigint) as taxon_key,
      cast(null as varchar) as genus,
      cast(null as varchar) as family,
      cast(null as varchar) as "order",
      cast(null as varchar) as class_name,
      cast(null as varchar) as phylum,
      cast(null as varchar) as kingdom,
      cast(null as varchar) as issues_json,
      cast(null as integer) as media_count,
      cast(ts as timestamp) as ingestion_ts,
      props as raw_payload
    from events"""


_STG_SQL = """
    select
      gbif_id, species_name, observation_date, latitude, longitude, individual_count,
      scientific_name, taxon_key, basis_of_record, occurrence_status, country_code,
      state_province, dataset_key, ingestion_ts, raw_payload,
      case when latitude is not null and longitude is not null
                and latitude between -90 and 90 and longitude between -180 and 180
                and coalesce(individual_count, 0) >= 0
           then true else false end as is_valid_observation
    from (
      select
        gbif_id,
        coalesce(nullif(trim(species), ''), 'Unknown') as species_name,
        event_date as observation_date,
        latitude, longitude,
        coalesce(individual_count, 1) as individual_count,
        scientific_name, taxon_key, basis_of_record, occurrence_status, country_code,
        state_province, dataset_key, ingestion_ts, raw_payload
      from raw
    ) s"""

_DIM_SQL = """
    select coalesce(cast(taxon_key as varchar), species_name) as species_id,
           taxon_key, species_name,
           max(scientific_name) as scientific_name,
           min(observation_date) as first_observed_date,
           max(observation_date) as last_observed_date,
           count(*) as total_observation_records
    from stg
    where is_valid_observation and observation_date is not null
    group by 1, 2, 3"""

_FCT_SQL = """
    select observation_date,
           coalesce(cast(taxon_key as varchar), species_name) as species_id,
           count(*) as observation_records,
           cast(sum(individual_count) as bigint) as individuals_observed,
           avg(latitude) as centroid_latitude,
           avg(longitude) as centroid_longitude
    from stg
    where is_valid_observation and observation_date is not null
    group by 1, 2"""


def _with_models(body: str, variant: str = "fanout") -> str:
    return (
        f"with raw as ({_raw_sql(variant)}),\n stg as ({_STG_SQL}),\n"
        f" dim as ({_DIM_SQL}),\n fct as ({_FCT_SQL})\n{body}"
    )


def _daily_sql(where: str = "") -> str:
    return f"""
    select observation_date,
           cast(sum(observation_records) as bigint) as observation_records,
           cast(sum(individuals_observed) as bigint) as individuals_observed
    from fct {where}
    group by 1"""


def _top_sql(measures: list[tuple[str, str]], names: str = "dim") -> str:
    sums = ",\n".join(f"cast(sum(fact.{src}) as bigint) as {out}" for src, out in measures)
    first = measures[0][1]
    return f"""
    select fact.species_id,
           coalesce(d.species_name, fact.species_id) as species_name,
           {sums}
    from fct as fact
    left join {names} as d on fact.species_id = d.species_id
    group by 1, 2
    order by {first} desc, species_id, species_name
    limit {TOP_SPECIES_LIMIT}"""


def _geo_sql() -> str:
    def bucket(c: str) -> str:
        return f"sign({c}) * floor(abs(round({c}, 9) * 100.0) + 0.5) / 100.0"

    return f"""
    select {bucket('centroid_latitude')} as lat_bucket,
           {bucket('centroid_longitude')} as lon_bucket,
           cast(sum(individuals_observed) as bigint) as individuals
    from fct
    group by 1, 2
    order by individuals desc, lat_bucket, lon_bucket
    limit {GEO_LIMIT}"""


def _report_rows(rows: list[tuple[str, str, str, str]]) -> str:
    """rows: (check_name, table_name, severity, failing_rows_sql)."""
    parts = [
        f"select '{n}' as check_name, '{t}' as table_name, '{s}' as severity, "
        f"cast(({c}) as bigint) as failing_rows"
        for n, t, s, c in rows
    ]
    return "\nunion all\n".join(parts)


_COORDS = (
    "latitude is not null and longitude is not null and latitude between -90 and 90 "
    "and longitude between -180 and 180"
)
_NOT_NULL = [
    ("gbif_observations_raw", "raw", "gbif_id"),
    ("stg_belgian_birds", "stg", "gbif_id"),
    ("stg_belgian_birds", "stg", "species_name"),
    ("stg_belgian_birds", "stg", "individual_count"),
    ("dim_species", "dim", "species_id"),
    ("dim_species", "dim", "species_name"),
    ("dim_species", "dim", "first_observed_date"),
    ("dim_species", "dim", "last_observed_date"),
    ("dim_species", "dim", "total_observation_records"),
    ("fct_daily_species_observations", "fct", "observation_date"),
    ("fct_daily_species_observations", "fct", "species_id"),
    ("fct_daily_species_observations", "fct", "observation_records"),
    ("fct_daily_species_observations", "fct", "individuals_observed"),
]
_MART_EXPR = [
    ("dim_species", "dim", "total_observation_records > 0"),
    ("fct_daily_species_observations", "fct", "observation_records > 0"),
    ("fct_daily_species_observations", "fct", "individuals_observed >= 0"),
]


def _not_null_rows():
    return [
        (f"not_null({c})", t, "error", f"select count(*) from {v} where {c} is null")
        for t, v, c in _NOT_NULL
    ]


def _mart_expr_rows():
    return [
        (f"expression_is_true({e})", t, "error", f"select count(*) from {v} where not ({e})")
        for t, v, e in _MART_EXPR
    ]


def _report_all_rows():
    stg, dim, fct = "stg_belgian_birds", "dim_species", "fct_daily_species_observations"
    return (
        _not_null_rows()
        + _mart_expr_rows()
        + [
            ("unique(gbif_id)", stg, "error",
             "select count(*) from (select gbif_id from stg where gbif_id is not null "
             "group by 1 having count(*) > 1)"),
            ("expression_is_true(individual_count >= 0)", stg, "error",
             "select count(*) from stg where not (individual_count >= 0)"),
            ("accepted_values(is_valid_observation)", stg, "error",
             "select count(*) from stg where is_valid_observation not in (true, false)"),
            (f"expression_is_true({_COORDS} where is_valid_observation)", stg, "error",
             f"select count(*) from stg where is_valid_observation and not ({_COORDS})"),
            ("valid_lat_lon", stg, "error",
             "select count(*) from stg where is_valid_observation and (latitude is null "
             "or longitude is null or latitude not between -90 and 90 "
             "or longitude not between -180 and 180)"),
            ("unique(species_id)", dim, "error",
             "select count(*) from (select species_id from dim where species_id is not null "
             "group by 1 having count(*) > 1)"),
            ("unique_combination(observation_date, species_id)", fct, "error",
             "select count(*) from (select observation_date, species_id from fct "
             "group by 1, 2 having count(*) > 1)"),
            ("relationships(species_id -> dim_species.species_id)", fct, "error",
             "select count(*) from fct where species_id is not null and species_id not in "
             "(select species_id from dim where species_id is not null)"),
        ]
    )


# --- expected normaliser outputs, computed from events arithmetic -----------
_LAT = "((event_id * 37) % 2001) / 10.0::double - 100"
_LON = "((event_id * 53) % 4001) / 10.0::double - 200"
_SCI = "concat(event_type, ' L., ', cast(1700 + user_id as varchar))"
_DATE_TEXT = """case event_id % 8
  when 0 then strftime(ts, '%Y-%m-%d')
  when 1 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
  when 2 then strftime(ts, '%Y-%m-%dT%H:%M:%S') || '-05:00'
  when 3 then strftime(ts, '%Y-%m-%d') || '/' || strftime(cast(ts as date) + 1, '%Y-%m-%d')
  when 4 then strftime(ts, '%Y-%m-%d %H:%M:%S')
  when 5 then ''
  when 6 then strftime(ts, '%Y-%m')
  else '  ' || strftime(ts, '%Y-%-m-%-d') || ' ' end"""
# the calendar day each text shape denotes (UTC), NULL for unparseable shapes
_DATE_VALUE = """case event_id % 8
  when 2 then cast(ts + interval 5 hour as date)
  when 5 then null when 6 then null
  else cast(ts as date) end"""
_GENUS_OR_UNKNOWN = (
    "case when event_id % 37 = 0 then 'Unknown' else event_type || 'idae' end"
)


_PROVINCE = "case when user_id % 2 = 0 then 'Flanders' else 'Wallonia' end"
_BROKEN = f"{_PROVINCE} || case when event_id % 11 = 0 then chr(10) || '\"near\"' || chr(9) || 'the coast' || chr(10) else '' end"


def _download_payload_sql(read_back: bool = False, lower: bool = False) -> str:
    """The landed export's text fields as a struct (payload order).

    Empty text reads as NULL from a text file, whose provinces have line breaks.
    """
    coord = (lambda v, salt: f"case (event_id + {salt}) % 7 when 0 then '' when 1 then 'n/a' "
             f"when 2 then '5d' else cast({v} as varchar) end")
    fields = [
        ("gbifID", "case when event_id % 41 = 0 then '' when event_id % 43 = 0 then '  ' "
                   "else cast(event_id as varchar) end"),
        ("gbifKey", "cast(event_id + 1000000000 as varchar)"),
        ("eventDate", _DATE_TEXT),
        ("species", "case when event_id % 23 = 0 then '   ' when event_id % 31 = 0 then '' "
                    "else event_type end"),
        ("genus", "case when event_id % 37 = 0 then '' else event_type || 'idae' end"),
        ("scientificName", _SCI),
        ("taxonRank", "'SPECIES'"),
        ("basisOfRecord", "'HUMAN_OBSERVATION'"),
        ("occurrenceStatus", "'PRESENT'"),
        ("individualCount", """case event_id % 6
            when 0 then cast(cast(floor(value) as integer) - 5 as varchar)
            when 1 then cast(value as varchar) when 2 then '' when 3 then 'many'
            when 4 then cast(cast(floor(value) as integer) as varchar) || 'e0'
            else ' ' || cast(cast(floor(value) as integer) as varchar) || ' ' end"""),
        ("decimalLatitude", coord(_LAT, 0)),
        ("decimalLongitude", coord(_LON, 3)),
        ("coordinateUncertaintyInMeters",
         "case when event_id % 2 = 0 then cast(value as varchar) else '' end"),
        ("countryCode", "case when event_id % 10 = 0 then 'NL' else 'BE' end"),
        ("stateProvince", _BROKEN if read_back else _PROVINCE),
        ("datasetKey", "'ds-' || cast(user_id % 5 as varchar)"),
        ("publishingOrgKey", "'org-1'"),
        ("taxonKey", "case when event_id % 7 = 0 then '' when event_id % 5 = 0 "
                     "then cast(user_id as varchar) || '.0' else cast(user_id as varchar) end"),
        ("family", "'Turdidae'"), ("order", "'Passeriformes'"), ("class", "'Aves'"),
        ("phylum", "'Chordata'"), ("kingdom", "'Animalia'"),
        ("issues", "case event_id % 4 when 0 then 'COORDINATE_ROUNDED; GEODETIC_DATUM_ASSUMED_WGS84' "
                   "when 1 then '' when 2 then ' ; ' else 'RECORDED_DATE_INVALID' end"),
        ("issue", "case when event_id % 4 = 1 then 'ISSUE_FALLBACK' else '' end"),
        ("classKey", "case when event_id % 9 = 0 then '359' else '212' end"),
    ]
    if read_back:
        fields = [(name, f"nullif({sql}, '')") for name, sql in fields]
    return "struct_pack(" + ", ".join(f'"{name.lower() if lower else name}" := {sql}' for name, sql in fields) + ")"


def _download_expected_sql(read_back: bool = False, lower: bool = False) -> str:
    """P2 applied to the landed export (one row per kept record)."""
    return f"""
    select
      event_id as _e,
      case when event_id % 41 = 0 then cast(event_id + 1000000000 as varchar)
           else cast(event_id as varchar) end as gbif_id,
      {_DATE_VALUE} as event_date,
      {_DATE_TEXT} as event_date_raw,
      case when event_id % 23 = 0 then 'Unknown'
           when event_id % 31 = 0 then {_GENUS_OR_UNKNOWN}
           else event_type end as species,
      {_SCI} as scientific_name,
      'SPECIES' as taxon_rank, 'HUMAN_OBSERVATION' as basis_of_record,
      'PRESENT' as occurrence_status,
      cast(case event_id % 6 when 0 then floor(value) - 5 when 2 then 1 when 3 then 1
                else floor(value) end as integer) as individual_count,
      case when event_id % 7 in (0, 1, 2) then null else {_LAT} end as latitude,
      case when (event_id + 3) % 7 in (0, 1, 2) then null else {_LON} end as longitude,
      case when event_id % 2 = 0 then value end as coordinate_uncertainty_m,
      case when event_id % 10 = 0 then 'NL' else 'BE' end as country_code,
      {_BROKEN if read_back else _PROVINCE} as state_province,
      'ds-' || cast(user_id % 5 as varchar) as dataset_key,
      'org-1' as publishing_org_key,
      case when event_id % 41 = 0 then event_id + 1000000000 else event_id end as key,
      case when event_id % 7 = 0 then null else user_id end as taxon_key,
      case when event_id % 37 = 0 then '' else event_type || 'idae' end as genus,
      'Turdidae' as family, 'Passeriformes' as "order", 'Aves' as class_name,
      'Chordata' as phylum, 'Animalia' as kingdom,
      case event_id % 4 when 0 then '["COORDINATE_ROUNDED", "GEODETIC_DATUM_ASSUMED_WGS84"]'
           when 1 then '["ISSUE_FALLBACK"]' when 2 then null
           else '["RECORDED_DATE_INVALID"]' end as issues_json,
      0 as media_count,
      to_json({_download_payload_sql(read_back, lower)}) as raw_payload
    from events
    where not (event_id % 43 = 0 and event_id % 41 <> 0)"""


def _search_expected_sql() -> str:
    """P1 applied to the search records (one row per kept record)."""
    return f"""
    select
      cast(event_id as varchar) as gbif_id,
      {_DATE_VALUE} as event_date,
      {_DATE_TEXT} as event_date_raw,
      case when event_id % 23 = 0 then {_GENUS_OR_UNKNOWN}
           when event_id % 31 = 0 then {_GENUS_OR_UNKNOWN}
           when event_id % 47 = 0 then '  '
           else event_type end as species,
      {_SCI} as scientific_name,
      'SPECIES' as taxon_rank, 'HUMAN_OBSERVATION' as basis_of_record,
      'PRESENT' as occurrence_status,
      cast(case event_id % 6 when 0 then floor(value) - 5 when 4 then floor(value)
                when 5 then floor(value) else 1 end as integer) as individual_count,
      case when event_id % 17 = 0 then null else {_LAT} end as latitude,
      case when event_id % 19 = 0 then null else {_LON} end as longitude,
      value as coordinate_uncertainty_m,
      'BE' as country_code,
      case when user_id % 2 = 0 then 'Flanders' else 'Wallonia' end as state_province,
      'ds-' || cast(user_id % 5 as varchar) as dataset_key,
      'org-1' as publishing_org_key,
      event_id as key,
      case when event_id % 7 = 0 then null else user_id end as taxon_key,
      case when event_id % 37 = 0 then null else event_type || 'idae' end as genus,
      'Turdidae' as family, 'Passeriformes' as "order", 'Aves' as class_name,
      'Chordata' as phylum, 'Animalia' as kingdom,
      case event_id % 4 when 0 then '["COUNTRY_COORDINATE_MISMATCH", "RECORDED_DATE_INVALID"]'
           when 1 then '[]' when 2 then null else '["TAXON_MATCH_FUZZY"]' end as issues_json,
      case event_id % 3 when 0 then 2 else 0 end as media_count,
      {_search_record_sql()} as raw_payload
    from events
    where event_id % 82 <> 0"""


def _search_record_sql() -> str:
    """A search record's JSON text, which is its payload."""
    whole = "cast(cast(floor(value) as integer) as varchar)"
    return json_object_sql([
        ("gbifID", "text", "case when event_id % 41 = 0 then null else cast(event_id as varchar) end"),
        ("key", "number", "case when event_id % 82 = 0 then null else event_id end"),
        ("eventDate", "text", _DATE_TEXT),
        ("species", "text", "case when event_id % 23 = 0 then null when event_id % 31 = 0 then '' "
                            "when event_id % 47 = 0 then '  ' else event_type end"),
        ("genus", "text", "case when event_id % 37 = 0 then null else event_type || 'idae' end"),
        ("family", "text", "'Turdidae'"), ("order", "text", "'Passeriformes'"), ("class", "text", "'Aves'"),
        ("phylum", "text", "'Chordata'"), ("kingdom", "text", "'Animalia'"),
        ("scientificName", "text", _SCI), ("taxonRank", "text", "'SPECIES'"),
        ("basisOfRecord", "text", "'HUMAN_OBSERVATION'"), ("occurrenceStatus", "text", "'PRESENT'"),
        ("individualCount", "json",
         f"""case event_id % 6 when 0 then cast(cast(floor(value) as integer) - 5 as varchar)
             when 1 then '"' || {whole} || '.9"' when 2 then 'null' when 3 then '"many"'
             when 4 then {whole} || case when event_id % 12 = 4 then '.9' else '.0' end
             else '" ' || {whole} || ' "' end"""),
        ("decimalLatitude", "number", f"case when event_id % 17 = 0 then null else {_LAT} end"),
        ("decimalLongitude", "number", f"case when event_id % 19 = 0 then null else {_LON} end"),
        ("coordinateUncertaintyInMeters", "number", "value"), ("countryCode", "text", "'BE'"),
        ("stateProvince", "text", "case when user_id % 2 = 0 then 'Flanders' else 'Wallonia' end"),
        ("datasetKey", "text", "'ds-' || cast(user_id % 5 as varchar)"), ("publishingOrgKey", "text", "'org-1'"),
        ("taxonKey", "number", "case when event_id % 7 = 0 then null else user_id end"),
        ("issues", "json", """case event_id % 4 when 0 then '["COUNTRY_COORDINATE_MISMATCH", "RECORDED_DATE_INVALID"]'
             when 1 then '[]' when 3 then '["TAXON_MATCH_FUZZY"]' else 'null' end"""),
        ("media", "json", """case event_id % 3 when 0 then '[{"type": "StillImage", "identifier": "https://example.org/'
             || cast(event_id as varchar) || '"}, {"type": "StillImage"}]' when 1 then '[]' else 'null' end"""),
        ("recordedBy", "text", "'observer ' || cast(user_id as varchar)"),
        ("extensions", "json", """'{"depth": [' || cast(event_id % 5 as varchar) || ', null]}'"""),
    ])


def _tsv_expected_sql() -> str:
    """As the export, but empty text reads as NULL from a text file."""
    empty = ", ".join(f"nullif({c}, '') as {c}" for c in ("event_date_raw", "genus"))
    return f"select * replace ({empty}) from ({_download_expected_sql(read_back=True)})"


_RAW_COLS = ", ".join(f'"{n}"' for n, _ in RAW_COLUMNS)


def _upsert_inputs_sql() -> str:
    return f"""raw as ({_raw_sql()}),
    target as (select * from raw where key % 2 = 0),
    batch as (
      select * replace (individual_count + 1 as individual_count), 0 as _seq
      from raw where key % 2 = 1 or key % 3 = 0
      union all
      select * replace (individual_count + 2 as individual_count), 1 as _seq
      from raw where key % 9 = 0),
    latest as (
      select * exclude (rn) from (
        select *, row_number() over (partition by gbif_id order by _seq desc, key desc) as rn
        from batch) where rn = 1)"""


def _state_models_sql() -> str:
    """The models over the state after the upsert of :func:`_upsert_inputs_sql`."""
    return f"""state as (
      select * from target where gbif_id not in (select gbif_id from latest)
      union all select {_RAW_COLS} from latest),
    stg as ({_STG_SQL.replace('from raw', 'from state')}), dim as ({_DIM_SQL}), fct as ({_FCT_SQL})"""


def oracle_sql() -> dict[str, str]:
    stg_cols = (
        "gbif_id, species_name, observation_date, latitude, longitude, individual_count, "
        "scientific_name, taxon_key, basis_of_record, occurrence_status, country_code, "
        "state_province, dataset_key, ingestion_ts, raw_payload, is_valid_observation"
    )
    out = {
        "scan_raw": f"{_raw_sql()}",
        "stg_observations": _with_models(f"select {stg_cols} from stg"),
        "quality_tag_counts": _with_models(
            "select is_valid_observation, count(*) as row_count from stg group by 1"
        ),
        "dim_species": _with_models("select * from dim"),
        "fct_daily": _with_models("select * from fct"),
        "dim_species_clean": _with_models("select * from dim", "clean"),
        "top_species": _with_models(
            _top_sql([("individuals_observed", "individuals_observed"),
                      ("observation_records", "observation_records")])
        ),
        "top_species_deduped": _with_models(
            ", names as (select species_id, species_name from ("
            " select species_id, species_name, row_number() over (partition by species_id"
            " order by total_observation_records desc, species_name desc) as rn from dim)"
            " where rn = 1)\n"
            + _top_sql([("individuals_observed", "individuals_observed"),
                        ("observation_records", "observation_records")], names="names")
        ),
        "top_species_individuals": _with_models(
            _top_sql([("individuals_observed", "total_individuals")])
        ),
        "species_activity": _with_models(
            "select species_id, first_observed_date, last_observed_date, total_observation_records"
            " from dim order by total_observation_records desc, species_id,"
            f" first_observed_date, last_observed_date limit {ACTIVITY_LIMIT}"
        ),
        "geo_density": _with_models(_geo_sql()),
        "geo_density_clean": _with_models(_geo_sql(), "clean"),
        "daily_trend": _with_models(_daily_sql() + " order by 1"),
        "daily_trend_window": _with_models(
            _daily_sql(f"where observation_date >= date '{AS_OF}' - {WINDOW_DAYS}") + " order by 1"
        ),
        "daily_trend_tail": _with_models(
            f"select * from ({_daily_sql()} order by observation_date desc limit {TAIL_ROWS})"
            " order by observation_date"
        ),
        "data_summary": _with_models(
            "select (select count(*) from raw) as raw_row_count,"
            " (select count(*) from stg) as stg_row_count,"
            " (select count(*) from fct) as mart_daily_rows,"
            " (select count(*) from dim) as mart_species_rows,"
            " (select min(event_date) from raw) as min_event_date,"
            " (select max(event_date) from raw) as max_event_date"
        ),
        "dq_not_null": _with_models(_report_rows(_not_null_rows())),
        "dq_unique_species_id": _with_models(
            "select species_id, count(*) as n_records from dim where species_id is not null"
            " group by 1 having count(*) > 1"
        ),
        "dq_accepted_values": _with_models(
            "select is_valid_observation, count(*) as n_records from stg"
            " where is_valid_observation not in (true, false) group by 1"
        ),
        "dq_expression_count": _with_models(
            f"select {stg_cols} from stg where not (individual_count >= 0)"
        ),
        "dq_expression_where": _with_models(
            f"select {stg_cols} from stg where is_valid_observation and not ({_COORDS})"
        ),
        "dq_expression_marts": _with_models(_report_rows(_mart_expr_rows())),
        "dq_unique_combination": _with_models(
            "select observation_date, species_id, count(*) as n_records from fct"
            " group by 1, 2 having count(*) > 1"
        ),
        "dq_relationships": _with_models(
            "select f.* from fct f where f.species_id is not null and not exists"
            " (select 1 from dim d where d.species_id = f.species_id)"
        ),
        "dq_valid_lat_lon": _with_models(
            f"select {stg_cols} from stg where is_valid_observation and (latitude is null"
            " or longitude is null or latitude not between -90 and 90"
            " or longitude not between -180 and 180)"
        ),
        "dq_report": _with_models(_report_rows(_report_all_rows())),
        "normalize_download": f"select * exclude (_e) from ({_download_expected_sql()})",
        "normalize_search": f"select * from ({_search_expected_sql()})",
        "historical_load": f"""
            select * exclude (_e) from ({_download_expected_sql(lower=True)})
            where country_code = 'BE' and _e % 9 <> 0 and coalesce(event_date between
              date '{HISTORICAL[0]}' and date '{HISTORICAL[1]}', true)""",
        "read_tsv_parts": f"select * exclude (_e) from ({_tsv_expected_sql()})",
        "read_parquet_shards": f"select * exclude (_e) from ({_download_expected_sql()})",
        "read_search_pages": f"select * from ({_search_expected_sql()})",
        "upsert_table_state": f"""with {_upsert_inputs_sql()}
            select * from target where gbif_id not in (select gbif_id from latest)
            union all select {_RAW_COLS} from latest""",
        "fct_refreshed": f"with {_upsert_inputs_sql()}, {_state_models_sql()} select * from fct",
        "dim_refreshed": f"with {_upsert_inputs_sql()}, {_state_models_sql()} select * from dim",
        "catalog_summary": _with_models(
            "select (select count(*) from raw) as raw_row_count,"
            " (select count(*) from stg) as stg_row_count,"
            " (select count(*) from fct) as mart_daily_rows,"
            " (select count(*) from dim) as mart_species_rows,"
            " (select min(event_date) from raw) as min_event_date,"
            " (select max(event_date) from raw) as max_event_date"
        ),
        "store_watermark": f"""
            select max(event_date) as max_event_date from ({_raw_sql()})
            where event_date <= date '{TARGET_LOADED_UNTIL}'""",
        "legacy_projection": f"""
            select case when event_id % 41 = 0 then 'None' else cast(event_id as varchar) end
                     as gbif_id,
                   case when event_id % 23 = 0 or event_id % 31 = 0 then {_GENUS_OR_UNKNOWN}
                        when event_id % 47 = 0 then '  ' else event_type end as species,
                   {_DATE_VALUE} as "date",
                   {_LAT} as latitude,
                   {_LON} as longitude,
                   cast(case event_id % 6 when 0 then floor(value) - 5 when 4 then floor(value)
                             when 5 then floor(value) else 1 end as bigint) as individual_count
            from events
            where event_id % 17 <> 0 and event_id % 19 <> 0 and event_id % 8 not in (5, 6)""",
        "predicate_filter": f"""
            select gbif_id, event_date, country_code, species, individual_count
            from ({_download_expected_sql()})
            where _e % 9 <> 0 and country_code = 'BE'
              and event_date between date '2024-01-05' and date '2024-01-20'""",
        "ingest_stats": f"""
            select count(*) as rows_processed, count(*) as rows_upsert_attempted
            from ({_download_expected_sql()})""",
        "dedupe_last_wins": f"""
            with raw as ({_raw_sql()}),
            batch as (
              select * replace (individual_count + 1 as individual_count), 0 as _seq from raw
              union all
              select * replace (individual_count + 2 as individual_count), 1 as _seq from raw where key % 9 = 0)
            select * exclude (rn) from (
              select *, row_number() over (partition by gbif_id order by _seq desc, key desc) as rn from batch)
            where rn = 1""",
        "upsert_by_key": f"""with {_upsert_inputs_sql()}
            select * from target where gbif_id not in (select gbif_id from latest)
            union all select {_RAW_COLS} from latest""",
        "cap_per_day": f"""
            select * exclude (rn) from (
              select *, row_number() over (partition by request_day order by key) as rn
              from (select *, cast(ingestion_ts as date) as request_day from ({_raw_sql()})))
            where rn <= {CAP_PER_DAY}""",
        "max_event_date": f"""
            select max(event_date) as max_event_date from ({_raw_sql()})
            where event_date is not null""",
        "incremental_start": f"""
            select max_event_date,
                   coalesce(greatest(max_event_date - {LOOKBACK_DAYS},
                                     date '{INCREMENTAL_DEFAULT_START}'),
                            date '{INCREMENTAL_DEFAULT_START}') as start_date
            from (select max(event_date) as max_event_date from ({_raw_sql()})
                  where event_date is not null)""",
        "calendar_days": f"""
            select cast(unnest(generate_series(lo, hi, interval 1 day)) as date) as day
            from (select min(event_date) as lo, max(event_date) as hi from ({_raw_sql()}))
            where lo is not null""",
        "incremental_run": f"""
            with raw as ({_raw_sql()}),
            target as (select * from raw
                       where event_date is null or event_date <= date '{TARGET_LOADED_UNTIL}'),
            st as (select coalesce(greatest(max(event_date) - {LOOKBACK_DAYS},
                                            date '{INCREMENTAL_DEFAULT_START}'),
                                   date '{INCREMENTAL_DEFAULT_START}') as start_date
                   from target where event_date is not null),
            batch as (select raw.* replace (individual_count + 1 as individual_count)
                      from raw, st
                      where raw.event_date between st.start_date and date '{AS_OF}')
            select * from target where gbif_id not in (select gbif_id from batch)
            union all select * from batch""",
    }
    if LLM is not None:
        out |= LLM.oracle_sql()
    return out
