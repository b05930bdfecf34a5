"""Mart builds: species dimension and daily species fact.

Both are single hash aggregations over the filtered staging rows.  Every
aggregate (count / sum / min / max / avg) has a partial form, so each map task
ships at most one row per group key: a key holding a third of all rows costs
one row per task in the shuffle, not a third of the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Taxon key as text when present, else the species name.
SPECIES_ID = "coalesce(cast(taxon_key as string), species_name)"
# rows the marts aggregate.
VALID_DATED = "is_valid_observation and observation_date is not null"


def valid_dated(stg: DataFrame) -> DataFrame:
    return stg.filter(VALID_DATED)


def _aggregate(df: DataFrame, keys: list[str], aggs: list[str]) -> DataFrame:
    return df.groupBy(*[F.expr(k) for k in keys]).agg(*[F.expr(a) for a in aggs])


def build_dim_species(stg: DataFrame) -> DataFrame:
    """A1: one row per (species_id, taxon_key, species_name).

    Two rounds with the same result as one: the raw rows are first reduced
    per (grain, scientific_name) with fixed-width buffers (count, min / max
    date), which Spark runs as a hash aggregate; the string ``max`` - which
    needs a sort-based aggregate - then only sees one row per name.
    """
    per_name = _aggregate(
        valid_dated(stg),
        [f"{SPECIES_ID} as species_id", "taxon_key", "species_name", "scientific_name"],
        [
            "min(observation_date) as first_observed_date",
            "max(observation_date) as last_observed_date",
            "count(1) as total_observation_records",
        ],
    )
    return _aggregate(
        per_name,
        ["species_id", "taxon_key", "species_name"],
        [
            "max(scientific_name) as scientific_name",
            "min(first_observed_date) as first_observed_date",
            "max(last_observed_date) as last_observed_date",
            "sum(total_observation_records) as total_observation_records",
        ],
    )


def build_fct_daily(stg: DataFrame) -> DataFrame:
    """A2: one row per (observation_date, species_id)."""
    return _aggregate(
        valid_dated(stg),
        ["observation_date", f"{SPECIES_ID} as species_id"],
        [
            "count(1) as observation_records",
            "cast(sum(individual_count) as bigint) as individuals_observed",
            "avg(latitude) as centroid_latitude",
            "avg(longitude) as centroid_longitude",
        ],
    )
