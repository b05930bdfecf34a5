"""Incremental / time-range logic: day series, raw watermark, start date,
range filters and run-request validation.

All values are computed on Spark as one-row aggregates; callers that need a
Python ``date`` (to build a read filter) take the single row.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from occurra.functions.expr import ident, lit_sql


def date_sql(value: dt.date | str) -> str:
    d = value if isinstance(value, dt.date) else dt.date.fromisoformat(value)
    return f"date {lit_sql(d.isoformat())}"


def calendar_days(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Every calendar day from ``start`` to ``end`` inclusive (empty if start > end)."""
    s, e = date_sql(start), date_sql(end)
    return spark.range(1).selectExpr(
        f"explode(case when {s} <= {e} then sequence({s}, {e}, interval 1 day) "
        "else cast(array() as array<date>) end) as day"
    )


def days_spanned(df: DataFrame, date_col: str = "event_date") -> DataFrame:
    """I1 over data: every day between the earliest and latest date in ``df``."""
    c = ident(date_col)
    return (
        df.selectExpr(f"min({c}) as lo", f"max({c}) as hi")
        .filter("lo is not null")
        .selectExpr("explode(sequence(lo, hi, interval 1 day)) as day")
    )


def max_event_date(raw: DataFrame) -> DataFrame:
    """The latest non-NULL event date (one row, NULL when empty)."""
    return raw.filter("event_date is not null").selectExpr("max(event_date) as max_event_date")


def incremental_start(
    raw: DataFrame, default_start: dt.date | str = "2025-01-01", lookback_days: int = 2
) -> DataFrame:
    """``max - lookback``, never before ``default_start``; the default
    when the table has no dated rows.  One row: (max_event_date, start_date)."""
    d = date_sql(default_start)
    return max_event_date(raw).selectExpr(
        "max_event_date",
        f"coalesce(greatest(date_sub(max_event_date, {int(lookback_days)}), {d}), {d}) as start_date",
    )


def start_after(
    latest: dt.date | None, default_start: dt.date | str = "2025-01-01", lookback_days: int = 2
) -> dt.date:
    """I2 / I3 from a known latest date: the same rule as :func:`incremental_start`."""
    default = default_start if isinstance(default_start, dt.date) else dt.date.fromisoformat(default_start)
    return default if latest is None else max(latest - dt.timedelta(days=lookback_days), default)


def first_value(df: DataFrame, column: str):
    """The single value of a one-row result (bounded: one row by construction)."""
    row = df.select(column).first()
    return None if row is None else row[0]


def in_date_range(df: DataFrame, column: str, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows whose ``column`` lies in [start, end] (NULL dates excluded)."""
    c = ident(column)
    return df.filter(f"{c} between {date_sql(start)} and {date_sql(end)}")


def historical_range(
    start_year: int | None = None, end_year: int | None = None, today: dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """[start_year-01-01, end_year-12-31], defaults 2020 .. this year.

    Years must lie in 1900..2100 and start <= end.
    """
    today = today or dt.date.today()
    sy = 2020 if start_year is None else int(start_year)
    ey = today.year if end_year is None else int(end_year)
    for y in (sy, ey):
        if not 1900 <= y <= 2100:
            raise ValueError(f"year {y} outside 1900..2100")
    if sy > ey:
        raise ValueError("start_year must be <= end_year")
    return dt.date(sy, 1, 1), dt.date(ey, 12, 31)
