"""Range predicates as trees (the shape sent to the occurrence service) and
their translation into a Spark filter.

On landed data the same tree becomes a ``Column`` over the export's own
columns; when those are stored columns, Catalyst pushes the comparisons into
the Parquet scan (``PushedFilters``) and prunes files / row groups.
"""

from __future__ import annotations

import datetime as dt
from typing import Any, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from occurra.functions.expr import lit_sql

# Predicate node types and keys.
AND, EQUALS, GTE, LTE = "and", "equals", "greaterThanOrEquals", "lessThanOrEquals"
CLASS_KEY, COUNTRY, EVENT_DATE = "CLASS_KEY", "COUNTRY", "EVENT_DATE"

_COMPARE = {EQUALS: "=", GTE: ">=", LTE: "<="}


def range_predicate(
    country: str, class_key: int | str, start: dt.date, end: dt.date
) -> dict[str, Any]:
    """Class AND country AND start <= event date <= end."""
    return {
        "type": AND,
        "predicates": [
            {"type": EQUALS, "key": CLASS_KEY, "value": str(class_key)},
            {"type": EQUALS, "key": COUNTRY, "value": country},
            {"type": GTE, "key": EVENT_DATE, "value": start.isoformat()},
            {"type": LTE, "key": EVENT_DATE, "value": end.isoformat()},
        ],
    }


def predicate_to_sql(tree: Mapping[str, Any], mapping: Mapping[str, tuple[str, str]]) -> str:
    """SQL text of a predicate tree.

    ``mapping``: predicate key -> (SQL expression over the input, SQL type of
    the value), e.g. ``{"EVENT_DATE": ("event_date", "date")}``.
    """
    kind = tree["type"]
    if kind == AND:
        parts = [predicate_to_sql(p, mapping) for p in tree["predicates"]]
        return "(" + " and ".join(parts) + ")" if parts else "true"
    if kind in _COMPARE:
        key = tree["key"]
        if key not in mapping:
            raise KeyError(f"no column mapped for predicate key {key!r}")
        expr, value_type = mapping[key]
        value = f"cast({lit_sql(str(tree['value']))} as {value_type})"
        return f"({expr} {_COMPARE[kind]} {value})"
    raise ValueError(f"unsupported predicate type {kind!r}")


def predicate_to_column(tree: Mapping[str, Any], mapping: Mapping[str, tuple[str, str]]) -> Column:
    """The predicate tree as a filter ``Column``."""
    return F.expr(predicate_to_sql(tree, mapping))
