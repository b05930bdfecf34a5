"""Serving queries over the marts: top species, activity window, daily trend,
geo density and the one-row data summary.

Top-k results use ``orderBy(...).limit(k)``, which
Spark plans as ``TakeOrderedAndProject``: every partition keeps its own k best
rows and only those reach the final merge.  Ties at the cut are broken by the
group keys so that the k rows are deterministic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from occurra.functions.expr import portable_round_sql


def _positive(name: str, value: int) -> int:
    if int(value) < 1:
        raise ValueError(f"{name} must be at least 1, not {value}")
    return int(value)


def _date_lit(as_of: dt.date | str | None) -> Column:
    if as_of is None:
        return F.current_date()
    return F.lit(as_of if isinstance(as_of, dt.date) else dt.date.fromisoformat(as_of))


# ---------------------------------------------------------------------------
# Top species (fact LEFT JOIN dim on species_id)
# ---------------------------------------------------------------------------
def top_species(
    fct: DataFrame,
    dim: DataFrame,
    limit: int = 20,
    measures: tuple[tuple[str, str], ...] = (
        ("individuals_observed", "individuals_observed"),
        ("observation_records", "observation_records"),
    ),
    dedupe_names: bool = False,
) -> DataFrame:
    """Species ranked by the first measure.

    The dimension's grain is (species_id, taxon_key, species_name) while the
    join key is species_id alone, so one id with two names counts its facts
    twice.  That fan-out is the faithful default.  The fact side is summed per
    species_id *before* the join: the join then sees one row per species, and
    each dimension row contributes that species' totals exactly as the
    row-level join would.  ``dedupe_names=True`` keeps one name per id (the one
    with most records, ties to the greatest name) and removes the fan-out.
    """
    limit = _positive("limit", limit)
    per_species = fct.groupBy("species_id").agg(
        *[F.expr(f"cast(sum({src}) as bigint) as {out}") for src, out in measures]
    )
    names = dim.select("species_id", "species_name")
    if dedupe_names:
        names = dim.groupBy("species_id").agg(
            F.expr(
                "max_by(species_name, struct(total_observation_records, species_name)) "
                "as species_name"
            )
        )
    joined = per_species.join(names, "species_id", "left")
    ranked = joined.groupBy(
        F.col("species_id"), F.expr("coalesce(species_name, species_id) as species_name")
    ).agg(*[F.expr(f"cast(sum({out}) as bigint) as {out}") for _, out in measures])
    first = measures[0][1]
    return ranked.orderBy(F.col(first).desc(), "species_id", "species_name").limit(limit)


def top_species_individuals(fct: DataFrame, dim: DataFrame, limit: int = 20) -> DataFrame:
    """Individuals only, as ``total_individuals``."""
    return top_species(fct, dim, limit, measures=(("individuals_observed", "total_individuals"),))


# ---------------------------------------------------------------------------
# Dimension window and geo density
# ---------------------------------------------------------------------------
def species_activity(dim: DataFrame, limit: int = 50) -> DataFrame:
    """Most-recorded species with their first / last observed dates."""
    cols = ["species_id", "first_observed_date", "last_observed_date", "total_observation_records"]
    return (
        dim.select(*cols)
        .orderBy(F.desc("total_observation_records"), *cols[:3])
        .limit(limit)
    )


def geo_density(fct: DataFrame, digits: int = 2, limit: int = 1000) -> DataFrame:
    """Individuals per rounded centroid cell, densest first."""
    cells = fct.groupBy(
        F.expr(f"{portable_round_sql('centroid_latitude', digits)} as lat_bucket"),
        F.expr(f"{portable_round_sql('centroid_longitude', digits)} as lon_bucket"),
    ).agg(F.expr("cast(sum(individuals_observed) as bigint) as individuals"))
    return cells.orderBy(F.col("individuals").desc(), "lat_bucket", "lon_bucket").limit(limit)


# ---------------------------------------------------------------------------
# Daily series
# ---------------------------------------------------------------------------
def _daily_totals(fct: DataFrame) -> DataFrame:
    return fct.groupBy("observation_date").agg(
        F.expr("cast(sum(observation_records) as bigint) as observation_records"),
        F.expr("cast(sum(individuals_observed) as bigint) as individuals_observed"),
    )


def daily_trend(
    fct: DataFrame, days: int | None = None, as_of: dt.date | str | None = None
) -> DataFrame:
    """Daily totals, optionally in a trailing window.

    The window keeps dates on or after ``as_of - days`` (future dates pass).  ``as_of`` defaults to today.
    """
    if days is not None:
        days = _positive("days", days)
        fct = fct.filter(F.col("observation_date") >= F.date_sub(_date_lit(as_of), days))
    return _daily_totals(fct).orderBy("observation_date")


def last_n_days_rows(daily: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` rows of an ascending daily series, still ascending.

    Expressed as a descending top-n (bounded) and a re-sort, never ``tail``.
    """
    return daily.orderBy(F.desc("observation_date")).limit(n).orderBy("observation_date")


# ---------------------------------------------------------------------------
# One-row summary
# ---------------------------------------------------------------------------
SUMMARY_COLUMNS = [
    ("raw_row_count", "bigint"),
    ("stg_row_count", "bigint"),
    ("mart_daily_rows", "bigint"),
    ("mart_species_rows", "bigint"),
    ("min_event_date", "date"),
    ("max_event_date", "date"),
]


def data_summary(
    spark: SparkSession,
    raw: DataFrame | None,
    stg: DataFrame | None,
    fct: DataFrame | None,
    dim: DataFrame | None,
) -> DataFrame:
    """Table row counts and the raw date range; NULL for a missing table.

    Each part is a one-row global aggregate; the parts are combined with a
    cross join of one-row inputs.
    """
    nulls = {n: F.lit(None).cast(t).alias(n) for n, t in SUMMARY_COLUMNS}

    def count_or_null(df: DataFrame | None, name: str) -> DataFrame:
        if df is None:
            return spark.range(1).select(nulls[name])
        return df.agg(F.count(F.lit(1)).alias(name))

    if raw is None:
        raw_part = spark.range(1).select(
            nulls["raw_row_count"], nulls["min_event_date"], nulls["max_event_date"]
        )
    else:
        raw_part = raw.agg(
            F.count(F.lit(1)).alias("raw_row_count"),
            F.min("event_date").alias("min_event_date"),
            F.max("event_date").alias("max_event_date"),
        )
    out = (
        raw_part.crossJoin(count_or_null(stg, "stg_row_count"))
        .crossJoin(count_or_null(fct, "mart_daily_rows"))
        .crossJoin(count_or_null(dim, "mart_species_rows"))
    )
    return out.select(*[n for n, _ in SUMMARY_COLUMNS])


def data_summary_from_catalog(
    spark: SparkSession,
    raw_table: str,
    stg_table: str,
    fct_table: str,
    dim_table: str,
) -> DataFrame:
    """A10 against catalog tables; a table that does not exist reads as NULL."""

    def table_or_none(name: str) -> DataFrame | None:
        return spark.table(name) if spark.catalog.tableExists(name) else None

    return data_summary(
        spark,
        table_or_none(raw_table),
        table_or_none(stg_table),
        table_or_none(fct_table),
        table_or_none(dim_table),
    )
