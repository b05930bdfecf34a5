"""Staging view: typed rename of the raw table, standardisation, quality tag.

All rows are kept; ``is_valid_observation`` marks the rows the marts use.
The result is a pure projection of its input, so Catalyst prunes it to the
columns a consumer reads and pushes consumer filters through it to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from occurra.functions.expr import ident, lit_sql
from occurra.schema import COLUMN_COMMENTS

# (staging name, raw source column, type) in output order.
CASTS = [
    ("gbif_id", "gbif_id", "string"),
    ("species_name", "species", "string"),
    ("observation_date", "event_date", "date"),
    ("latitude", "latitude", "double"),
    ("longitude", "longitude", "double"),
    ("individual_count", "individual_count", "int"),
    ("scientific_name", "scientific_name", "string"),
    ("taxon_key", "taxon_key", "bigint"),
    ("basis_of_record", "basis_of_record", "string"),
    ("occurrence_status", "occurrence_status", "string"),
    ("country_code", "country_code", "string"),
    ("state_province", "state_province", "string"),
    ("dataset_key", "dataset_key", "string"),
    ("ingestion_ts", "ingestion_ts", "timestamp_ntz"),
    ("raw_payload", "raw_payload", "string"),
]

def coords_in_range_sql(lat: str = "latitude", lon: str = "longitude") -> str:
    """Both coordinates present and inside WGS84 bounds (NaN is outside)."""
    return (
        f"{lat} is not null and {lon} is not null "
        f"and {lat} between -90 and 90 and {lon} between -180 and 180"
    )


def validity_rule_sql(
    lat: str = "latitude", lon: str = "longitude", count: str = "individual_count"
) -> str:
    """The row-level quality rule; never NULL."""
    return (
        f"case when {coords_in_range_sql(lat, lon)} and coalesce({count}, 0) >= 0 "
        "then true else false end"
    )


COORDS_IN_RANGE = coords_in_range_sql()
VALIDITY_RULE = validity_rule_sql()
# Standardisation applied on top of the typed columns.
STANDARDIZE = {
    "species_name": "coalesce(nullif(trim(species_name), ''), 'Unknown')",
    "individual_count": "coalesce(individual_count, 1)",
}


def staging_columns_sql() -> list[str]:
    """The staging projection as SQL select items (shared by the DataFrame
    build and the catalog view)."""
    typed = {name: f"cast(`{src}` as {dtype})" for name, src, dtype in CASTS}
    for name, rule in STANDARDIZE.items():
        typed[name] = rule.replace(name, typed[name])
    flag = validity_rule_sql(typed["latitude"], typed["longitude"], typed["individual_count"])
    return [f"{sql} as {name}" for name, sql in typed.items()] + [
        f"{flag} as is_valid_observation"
    ]


def build_staging(raw: DataFrame) -> DataFrame:
    """cast/rename 15 raw columns, standardise, add ``is_valid_observation``."""
    return raw.selectExpr(*staging_columns_sql())


def staging_view_sql(view: str, raw_table: str) -> str:
    """K5: the staging model as a persistent catalog view over the raw table."""
    items = ",\n  ".join(staging_columns_sql())
    names = [c for c, _, _ in CASTS] + ["is_valid_observation"]
    named = ", ".join(
        ident(n) + (f" comment {lit_sql(COLUMN_COMMENTS[n])}" if n in COLUMN_COMMENTS else "") for n in names
    )
    about = lit_sql("Typed and cleaned occurrence records; all rows, flagged where unusable for the marts.")
    return f"create or replace view {view} ({named}) comment {about} as select\n  {items}\nfrom {raw_table}"


def quality_tag_counts(stg: DataFrame) -> DataFrame:
    """Rows per value of the quality flag."""
    return stg.groupBy("is_valid_observation").agg(F.count(F.lit(1)).alias("row_count"))
