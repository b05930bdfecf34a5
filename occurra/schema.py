"""Table schemas, table names and column descriptions.

The column lists and types are fixed values: they must equal the source
system's layout so that downstream SQL sees the same columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Table names (one naming constant per layer).
# ---------------------------------------------------------------------------
RAW_SCHEMA_NAME = "raw"
STAGING_SCHEMA_NAME = "stg_bird_data"
MART_SCHEMA_NAME = "mart_bird_data"

S, D, I, L, DB, TS, B = (
    T.StringType(),
    T.DateType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.TimestampNTZType(),
    T.BooleanType(),
)

# ---------------------------------------------------------------------------
# The 28-column raw table, in storage order.
# ---------------------------------------------------------------------------
RAW_COLUMNS: list[tuple[str, T.DataType]] = [
    ("gbif_id", S),
    ("event_date", D),
    ("event_date_raw", S),
    ("species", S),
    ("scientific_name", S),
    ("taxon_rank", S),
    ("basis_of_record", S),
    ("occurrence_status", S),
    ("individual_count", I),
    ("latitude", DB),
    ("longitude", DB),
    ("coordinate_uncertainty_m", DB),
    ("country_code", S),
    ("state_province", S),
    ("dataset_key", S),
    ("publishing_org_key", S),
    ("key", L),
    ("taxon_key", L),
    ("genus", S),
    ("family", S),
    ("order", S),
    ("class_name", S),
    ("phylum", S),
    ("kingdom", S),
    ("issues_json", S),
    ("media_count", I),
    ("ingestion_ts", TS),
    ("raw_payload", S),
]
RAW_SCHEMA = T.StructType(
    [T.StructField(n, t, nullable=(n != "gbif_id")) for n, t in RAW_COLUMNS]
)
RAW_KEY = "gbif_id"

# Legacy append-only table: 6 columns, REQUIRED except the count.
LEGACY_SCHEMA = T.StructType(
    [
        T.StructField("gbif_id", S, False),
        T.StructField("species", S, False),
        T.StructField("date", D, False),
        T.StructField("latitude", DB, False),
        T.StructField("longitude", DB, False),
        T.StructField("individual_count", L, True),
    ]
)

# ---------------------------------------------------------------------------
# Source shapes.
# ---------------------------------------------------------------------------
# Download export (SIMPLE_CSV / SIMPLE_PARQUET): every value read as text.
DOWNLOAD_FIELDS = [
    "gbifID",
    "gbifKey",
    "eventDate",
    "species",
    "genus",
    "scientificName",
    "taxonRank",
    "basisOfRecord",
    "occurrenceStatus",
    "individualCount",
    "decimalLatitude",
    "decimalLongitude",
    "coordinateUncertaintyInMeters",
    "countryCode",
    "stateProvince",
    "datasetKey",
    "publishingOrgKey",
    "taxonKey",
    "family",
    "order",
    "class",
    "phylum",
    "kingdom",
    "issues",
    "issue",
]

# Search API record (one element of a page's ``results`` array).
SEARCH_RECORD_SCHEMA = T.StructType(
    [
        T.StructField("gbifID", S),
        T.StructField("key", L),
        T.StructField("eventDate", S),
        T.StructField("species", S),
        T.StructField("genus", S),
        T.StructField("family", S),
        T.StructField("order", S),
        T.StructField("class", S),
        T.StructField("phylum", S),
        T.StructField("kingdom", S),
        T.StructField("scientificName", S),
        T.StructField("taxonRank", S),
        T.StructField("basisOfRecord", S),
        T.StructField("occurrenceStatus", S),
        T.StructField("individualCount", S),
        T.StructField("decimalLatitude", DB),
        T.StructField("decimalLongitude", DB),
        T.StructField("coordinateUncertaintyInMeters", DB),
        T.StructField("countryCode", S),
        T.StructField("stateProvince", S),
        T.StructField("datasetKey", S),
        T.StructField("publishingOrgKey", S),
        T.StructField("taxonKey", L),
        T.StructField("issues", T.ArrayType(S)),
        T.StructField("media", T.ArrayType(T.StructType([T.StructField("type", S)]))),
    ]
)
# Landed pages are read with the coordinate fields as text: JSON numbers come
# back as their text and quoted values as is, and the normaliser's float rule
# (X2) parses both, as the source system does.
_TEXT_NUMBERS = ("decimalLatitude", "decimalLongitude", "coordinateUncertaintyInMeters")
SEARCH_RECORD_TEXT_SCHEMA = T.StructType(
    [
        T.StructField(f.name, S) if f.name in _TEXT_NUMBERS else f
        for f in SEARCH_RECORD_SCHEMA.fields
    ]
)
# A page's envelope; every record stays the JSON text that it is.
SEARCH_PAGE_SCHEMA = T.StructType(
    [
        T.StructField("offset", L),
        T.StructField("limit", L),
        T.StructField("endOfRecords", B),
        T.StructField("count", L),
        T.StructField("results", T.ArrayType(S)),
    ]
)

# ---------------------------------------------------------------------------
# Descriptions stored in the catalog.
# ---------------------------------------------------------------------------
TABLE_COMMENTS = {
    "dim_species": "A row per species key, taxon key and name among valid, dated observations.",
    "fct_daily_species_observations": "A row per day and species among valid, dated observations.",
}
COLUMN_COMMENTS = {
    # raw store
    "gbif_id": "Key of an occurrence record.",
    "event_date": "Day of the event, if its text could be parsed.",
    "event_date_raw": "The event date as the source wrote it.",
    "species": "Species name, else genus, else Unknown.",
    "scientific_name": "Scientific name, with its author where the source gives one.",
    "taxon_rank": "Rank of the identified taxon.",
    "basis_of_record": "Kind of evidence for the record, such as HUMAN_OBSERVATION.",
    "occurrence_status": "PRESENT or ABSENT, if given.",
    "individual_count": "How many individuals were seen; 1 if not given.",
    "latitude": "Degrees north; null if missing or not a number.",
    "longitude": "Degrees east; null if missing or not a number.",
    "coordinate_uncertainty_m": "Radius of the position's uncertainty in metres.",
    "country_code": "Two-letter code of the country.",
    "state_province": "State or province, if given.",
    "dataset_key": "Dataset the record comes from.",
    "publishing_org_key": "Organisation that published the dataset.",
    "key": "The record's key as a number.",
    "taxon_key": "Number of the identified taxon, if given.",
    "genus": "Genus.",
    "family": "Family.",
    "order": "Order.",
    "class_name": "Class.",
    "phylum": "Phylum.",
    "kingdom": "Kingdom.",
    "issues_json": "Quality issues that the source flagged, as a JSON list.",
    "media_count": "How many media are attached.",
    "ingestion_ts": "When the row was ingested.",
    "raw_payload": "The whole source record as JSON, to parse again later.",
    # staging
    "species_name": "Species name without blanks around it; Unknown if empty.",
    "observation_date": "Day of the observation; null if it isn't known.",
    "is_valid_observation": "Whether the position is complete and on the globe, and the count isn't negative.",
    # marts
    "species_id": "The taxon key as text, else the species name.",
    "first_observed_date": "First day with a valid observation.",
    "last_observed_date": "Last day with a valid observation.",
    "total_observation_records": "Number of valid, dated records.",
    "observation_records": "Records of the day and species.",
    "individuals_observed": "Individuals counted on the day.",
    "centroid_latitude": "Mean latitude of the records.",
    "centroid_longitude": "Mean longitude of the records.",
}
