"""Scalar rules (X1-X5, X12) on inline DataFrames; golden rows from the
source system's unit tests plus the documented edge cases."""

import datetime as dt

import pytest

from occurra.functions import expr as X

D = dt.date

EVENT_DATES = [
    (None, None),
    ("", None),
    ("2024-03-15", D(2024, 3, 15)),
    ("2024-03-15T22:00:00Z", D(2024, 3, 15)),
    ("2024-03-15T23:30:00-05:00", D(2024, 3, 16)),
    ("2024-03-15/2024-03-20", D(2024, 3, 15)),
    ("2024-03-15T00:00/2024-03-16T00:00", None),
    ("2024-03-15 23:59:59-05:00", D(2024, 3, 15)),
    ("2024-3-5", D(2024, 3, 5)),
    ("2024-03", None),
    ("2024", None),
    ("2024-02-30", None),
    ("T10:00", None),
    ("  2024-03-15  ", D(2024, 3, 15)),
    ("2024-03-15T10", D(2024, 3, 15)),
    ("2024-03-15T22-05:00", D(2024, 3, 16)),
    ("2024-03-15T23:10+02:00", D(2024, 3, 15)),
    ("2024-03-15T10:00:00.123456", D(2024, 3, 15)),
    ("\t2024-03-15T01:00:00+02:00\n", D(2024, 3, 14)),
    ("Tuesday", None),
    ("2024-03-15T10:00:00.1234567", D(2024, 3, 15)),
    ("2024-03-15T23:59:59.9999999-00:30", D(2024, 3, 16)),
    ("2024-03-15T22:00:00-0500", D(2024, 3, 16)),
    ("2024-03-15T22-05", D(2024, 3, 16)),
    ("2024-03-15T22:00:00,5+0200", D(2024, 3, 15)),
]


def _eval(spark, col_type, values, fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {col_type}")
    return [r[0] for r in df.select(fn("x")).collect()]


def test_event_date_rules(spark):
    got = _eval(spark, "string", [i for i, _ in EVENT_DATES], X.parse_event_date)
    assert got == [o for _, o in EVENT_DATES]


NUMBERS = [
    # text, coerce_float, coerce_int(default 1), count_from_search
    ("1.5", 1.5, 1, 1),
    (" 2 ", 2.0, 2, 2),
    ("5d", None, 1, 1),
    ("1_000", 1000.0, 1000, 1000),
    ("abc", None, 1, 1),
    ("", None, 1, 1),
    (None, None, 1, 1),
    ("1e3", 1000.0, 1000, 1),
    (".5", 0.5, 0, 1),
    ("-2.9", -2.9, -2, 1),
    ("+3", 3.0, 3, 3),
    ("inf", float("inf"), 1, 1),
    ("2.9", 2.9, 2, 1),
]


def test_numeric_coercions(spark):
    vals = [n[0] for n in NUMBERS]
    assert _eval(spark, "string", vals, X.coerce_float) == [n[1] for n in NUMBERS]
    assert _eval(spark, "string", vals, lambda c: X.coerce_int(c, 1)) == [n[2] for n in NUMBERS]
    assert _eval(spark, "string", vals, X.count_from_search) == [n[3] for n in NUMBERS]


def test_nan_text_is_a_float_but_not_an_int(spark):
    f = _eval(spark, "string", ["nan"], X.coerce_float)[0]
    assert f != f
    assert _eval(spark, "string", ["nan"], lambda c: X.coerce_int(c, 7)) == [7]


def test_large_integral_ids_are_exact(spark):
    assert _eval(spark, "string", ["9007199254740993"], X.coerce_int) == [9007199254740993]


def test_issues_json(spark):
    text = _eval(spark, "string", ["A; B", "A;B", "", None, " ; ", 'Q"x'], X.issues_json_from_text)
    assert text == ['["A", "B"]', '["A", "B"]', None, None, None, '["Q\\"x"]']
    lists = _eval(spark, "array<string>", [["A", "B"], [], None], X.issues_json_from_list)
    assert lists == ['["A", "B"]', "[]", None]


@pytest.mark.parametrize(
    "x,expected", [(1.005, 1.0), (-1.005, -1.0), (2.675, 2.68), (0.125, 0.13), (None, None)]
)
def test_portable_round(spark, x, expected):
    assert _eval(spark, "double", [x], X.portable_round) == [expected]


def test_strip_matches_python(spark):
    samples = ["  a ", "\tb\n", " c ", "\x1cd\x1f", "e"]
    assert _eval(spark, "string", samples, X.strip_ws) == [s.strip() for s in samples]


def test_issues_json_matches_json_dumps(spark):
    import json

    lists = [['a",', "b"], [None, "A"], ["x\\", "y,z"], ["tab\there"], ["A"], []]
    got = _eval(spark, "array<string>", lists, X.issues_json_from_list)
    assert got == [json.dumps(v) for v in lists]
    texts = ["A ;; B;", ";A", "  ", "A B ; C", 'q"; r\\']
    want = ['["A", "B"]', '["A"]', None, '["A B", "C"]', '["q\\"", "r\\\\"]']
    assert _eval(spark, "string", texts, X.issues_json_from_text) == want
