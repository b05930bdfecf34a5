import datetime as dt

import pytest

from occurra.operators import incremental as INC
from occurra.schema import RAW_SCHEMA
from occurra.sources.predicate import predicate_to_sql, range_predicate

D = dt.date


def _raw_with_dates(spark, dates):
    rows = []
    for i, d in enumerate(dates):
        row = [None] * len(RAW_SCHEMA.fields)
        row[0], row[1] = str(i), d
        rows.append(tuple(row))
    return spark.createDataFrame(rows, RAW_SCHEMA)


@pytest.mark.parametrize(
    "default,dates,lookback,expected",
    [
        (D(2025, 1, 1), [], 2, D(2025, 1, 1)),
        (D(2025, 1, 1), [None], 2, D(2025, 1, 1)),
        (D(2025, 1, 1), [D(2026, 4, 10), D(2026, 1, 1), None], 2, D(2026, 4, 8)),
        (D(2025, 1, 1), [D(2025, 1, 2)], 7, D(2025, 1, 1)),
    ],
)
def test_incremental_start(spark, default, dates, lookback, expected):
    raw = _raw_with_dates(spark, dates)
    start = INC.first_value(INC.incremental_start(raw, default, lookback), "start_date")
    assert start == expected


def test_calendar_days(spark):
    days = [r[0] for r in INC.calendar_days(spark, "2024-02-27", "2024-03-01").collect()]
    assert days == [D(2024, 2, 27), D(2024, 2, 28), D(2024, 2, 29), D(2024, 3, 1)]
    assert INC.calendar_days(spark, "2024-03-02", "2024-03-01").count() == 0


def test_historical_range_validation():
    assert INC.historical_range(2020, 2021) == (D(2020, 1, 1), D(2021, 12, 31))
    with pytest.raises(ValueError):
        INC.historical_range(2022, 2021)
    with pytest.raises(ValueError):
        INC.historical_range(1800, 2021)


def test_predicate_shape_and_filter(spark):
    tree = range_predicate("BE", 212, D(2020, 1, 1), D(2020, 12, 31))
    assert tree["type"] == "and"
    inner = tree["predicates"]
    assert len(inner) == 4
    assert {p["key"] for p in inner if p["type"] == "equals"} == {"CLASS_KEY", "COUNTRY"}
    df = spark.createDataFrame(
        [("212", "BE", D(2020, 5, 1)), ("212", "NL", D(2020, 5, 1)), ("359", "BE", D(2020, 5, 1)),
         ("212", "BE", D(2021, 1, 1)), ("212", "BE", None)],
        "ck string, cc string, d date",
    )
    sql = predicate_to_sql(tree, {"CLASS_KEY": ("ck", "string"), "COUNTRY": ("cc", "string"),
                                  "EVENT_DATE": ("d", "date")})
    assert df.filter(sql).count() == 1


def test_serving_honours_its_arguments(spark):
    from occurra.operators import serving as SV

    fct = spark.createDataFrame(
        [(D(2024, 1, d), "s", 1, 2, 0.0, 0.0) for d in range(1, 31)],
        "observation_date date, species_id string, observation_records bigint, "
        "individuals_observed bigint, centroid_latitude double, centroid_longitude double",
    )
    win = SV.daily_trend(fct, days=1, as_of=D(2024, 1, 30)).collect()
    assert [r[0] for r in win] == [D(2024, 1, 29), D(2024, 1, 30)]
    dim = spark.range(700).selectExpr("cast(id as string) as species_id", "'n' as species_name", "1 as total_observation_records")
    many = dim.selectExpr(
        "date '2024-01-01' as observation_date", "species_id", "1L as observation_records", "2L as individuals_observed"
    )
    assert SV.top_species(many, dim, limit=500).count() == 500
    with pytest.raises(ValueError):
        SV.top_species(many, dim, limit=0)
    with pytest.raises(ValueError):
        SV.daily_trend(fct, days=0)
    tail = [r[0] for r in SV.last_n_days_rows(SV.daily_trend(fct), 5).collect()]
    assert tail == [D(2024, 1, d) for d in range(26, 31)]
