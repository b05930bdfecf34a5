"""Parsing rules on a table of inputs and expected values, properties that need
no second implementation, and invariants of the marts."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from occurra.functions import expr as X
from occurra.plans.models import build_models
from occurra.sources.fixture import events_as_raw, read_events

from conftest import SF_SMALL

D = dt.date
# inputs and the values that the rules give by their description
DATES = [
    (None, None), ("", None), ("   ", None), ("2024-03-05", D(2024, 3, 5)), (" 2024-3-5 ", D(2024, 3, 5)),
    ("2024-03-05/2024-03-09", D(2024, 3, 5)), ("2024-03-05 23:59:59", D(2024, 3, 5)), ("2024-03", None), ("2024", None),
    ("2024-02-30", None), ("2023-02-29", None), ("2024-13-01", None), ("05/03/2024", None), ("soon", None),
    ("2024-03-05T10:00:00", D(2024, 3, 5)), ("2024-03-05T23:30:00Z", D(2024, 3, 5)),
    ("2024-03-05T23:30:00-05:00", D(2024, 3, 6)), ("2024-03-05T00:30:00+01:00", D(2024, 3, 4)),
    ("2024-03-05T23", D(2024, 3, 5)), ("2024-03-05T23:30", D(2024, 3, 5)), ("2024-03-05T23:30:00.123456789", D(2024, 3, 5)),
    ("2024-03-05T25:00:00", None), ("2024-03-05T10:00:00/2024-03-06T10:00:00", None), ("2024-02-30T10:00:00", None),
    ("2024-03-05T23:30:00,5Z", D(2024, 3, 5)), ("2024-03-05T00:30:00+0100", D(2024, 3, 4)),
]
# text, as a float, as a whole number (default 1), as a search count
NUMBERS = [
    (None, None, 1, 1), ("", None, 1, 1), ("7", 7.0, 7, 7), (" 7 ", 7.0, 7, 7), ("-3", -3.0, -3, -3), ("2.9", 2.9, 2, 1),
    ("-2.9", -2.9, -2, 1), ("3e2", 300.0, 300, 1), ("1_000", 1000.0, 1000, 1000), ("5d", None, 1, 1), ("0x10", None, 1, 1),
    ("many", None, 1, 1), ("inf", float("inf"), 1, 1), ("+4", 4.0, 4, 4), (".5", 0.5, 0, 1), ("1__0", None, 1, 1),
    ("99999999999", 99999999999.0, 1, 1),
]


def column(spark, values, *sqls):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [tuple(r)[1:] for r in df.selectExpr("i", *sqls).orderBy("i").collect()]


def test_event_dates(spark):
    got = column(spark, [t for t, _ in DATES], X.parse_event_date_sql("x"))
    assert [(t, g[0]) for (t, _), g in zip(DATES, got)] == DATES


def test_numbers(spark):
    got = column(
        spark, [n[0] for n in NUMBERS], X.coerce_float_sql("x"), X.coerce_int_sql("x", 1, "int"), X.count_from_search_sql("x")
    )
    assert [(n[0], *g) for n, g in zip(NUMBERS, got)] == NUMBERS


@pytest.mark.parametrize("text,kind,want", [
    ("2.9", "DECIMAL(2,1)", 2), ("3.0", "DECIMAL(2,1)", 3), ("3", "BIGINT", 3), ("-2.9", "DOUBLE", -2), ("2.9", "STRING", 1),
    ("2", "STRING", 2), ("true", "BOOLEAN", 1), ("false", "BOOLEAN", 0), (None, None, 1), (None, "VOID", 1), ("1e300", "DOUBLE", 1),
])
def test_search_counts_by_json_type(spark, text, kind, want):
    kind_sql = "cast(null as string)" if kind is None else f"'{kind}'"
    assert column(spark, [text], X.count_from_search_sql("x", kind_sql)) == [(want,)]


def test_dates_written_back_parse_to_themselves(spark):
    rnd = random.Random(4)
    days = [D(1900, 1, 1) + dt.timedelta(days=rnd.randrange(70_000)) for _ in range(200)]
    assert column(spark, [d.isoformat() for d in days], X.parse_event_date_sql("x")) == [(d,) for d in days]
    # an offset moves the day by one at most, and noon within half a day of UTC stays
    noon = [f"{d.isoformat()}T12:00:00{z}" for d in days for z in ("Z", "+11:00", "-11:00", "")]
    assert column(spark, noon, X.parse_event_date_sql("x")) == [(d,) for d in days for _ in range(4)]


def test_rules_do_not_depend_on_the_session_zone(spark):
    texts = [t for t, _ in DATES]
    was = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        got = column(spark, texts, X.parse_event_date_sql("x"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)
    assert [g[0] for g in got] == [d for _, d in DATES]


@pytest.fixture(scope="module")
def models(spark):
    return build_models(events_as_raw(read_events(spark, SF_SMALL)))


def test_marts_conserve_rows(models):
    valid = models.stg.filter("is_valid_observation and observation_date is not null").count()
    assert models.fct.selectExpr("sum(observation_records)").first()[0] == valid
    assert models.dim.selectExpr("sum(total_observation_records)").first()[0] == valid
    assert models.stg.count() == models.raw.count()


def test_partitioning_does_not_change_results(spark, models):
    shuffled = build_models(
        events_as_raw(read_events(spark, SF_SMALL).repartition(7, "user_id").sortWithinPartitions("value"))
    )
    # float sums depend on summation order: compare centroids to 9 decimals
    rounded = lambda df: df.selectExpr(*[
        f"round({c}, 9) as {c}" if c.startswith("centroid") else c for c in df.columns])
    for a, b in ((models.fct, shuffled.fct), (models.dim, shuffled.dim)):
        a, b = rounded(a), rounded(b)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
