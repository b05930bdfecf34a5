"""Normalisers: source records -> the 28-column raw shape (and the legacy shape).

Each normaliser is one projection (``selectExpr``) followed by the F1 id
filter, so a whole export is normalised in a single narrow stage with no
shuffle and no Python worker.  Source headers are dynamic: a field missing
from the input reads as NULL, and typed (Parquet) fields are handled by type
instead of through text.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from occurra.functions.expr import (
    coerce_float_sql,
    coerce_int_double_sql,
    coerce_int_sql,
    count_from_search_sql,
    ident,
    issues_json_from_list_sql,
    issues_json_from_text_sql,
    lit_sql,
    parse_event_date_sql,
    row_json_sql,
    strip_ws_sql,
)
from occurra.schema import RAW_COLUMNS


class _Fields:
    """SQL text and type of the input's fields; absent fields are NULL.

    Names match case-insensitively (Spark's default resolution), so an export
    with lower-case headers (``gbifid``, ``eventdate``) is read the same way.
    """

    def __init__(self, df: DataFrame):
        self.types = {f.name: f.dataType for f in df.schema.fields}
        self._actual = {n.lower(): n for n in self.types}

    def _name(self, name: str) -> str | None:
        return name if name in self.types else self._actual.get(name.lower())

    def __contains__(self, name: str) -> bool:
        return self._name(name) is not None

    def sql(self, name: str) -> str:
        actual = self._name(name)
        return ident(actual) if actual else "cast(null as string)"

    def text(self, name: str) -> str:
        return f"cast({self.sql(name)} as string)"

    def dtype(self, name: str) -> T.DataType:
        actual = self._name(name)
        return self.types[actual] if actual else T.StringType()

    def truthy(self, name: str) -> str:
        """The field, NULL when Python would treat it as false."""
        x, t = self.sql(name), self.dtype(name)
        if isinstance(t, T.StringType):
            return f"nullif({x}, '')"
        if isinstance(t, T.NumericType):
            return f"nullif({x}, 0)"
        if isinstance(t, T.BooleanType):
            return f"case when {x} then {x} end"
        if isinstance(t, (T.ArrayType, T.MapType)):
            return f"case when size({x}) > 0 then {x} end"
        return x

    def as_double(self, name: str) -> str:
        """X2 by type: numbers pass through, text is parsed."""
        if isinstance(self.dtype(name), T.NumericType):
            return f"cast({self.sql(name)} as double)"
        return coerce_float_sql(self.sql(name))

    def as_int(self, name: str, default: int | None, target: str) -> str:
        """X3 by type: integers pass through, floats truncate, text is parsed."""
        t = self.dtype(name)
        if isinstance(t, T.IntegralType):
            out = f"try_cast({self.sql(name)} as {target})"
            return out if default is None else f"coalesce({out}, cast({default} as {target}))"
        if isinstance(t, T.NumericType):
            return coerce_int_double_sql(self.sql(name), default, target)
        return coerce_int_sql(self.sql(name), default, target)

    def issues_json(self, name: str, truthy: str | None = None) -> str:
        """X5 by type: text lists split on ';', arrays serialised as is."""
        x = truthy or self.sql(name)
        if isinstance(self.dtype(name), T.ArrayType):
            return issues_json_from_list_sql(x)
        return issues_json_from_text_sql(f"cast({x} as string)")

    def payload(self, exclude: Sequence[str]) -> str:
        """JSON of the record's fields, NULL fields kept."""
        return row_json_sql([n for n in self.types if n not in exclude])


def _ingestion_ts_sql(ingestion_ts: dt.datetime | None) -> str:
    if ingestion_ts is None:
        return "cast(current_timestamp() as timestamp_ntz)"
    return f"timestamp_ntz {lit_sql(ingestion_ts.isoformat(sep=' '))}"


# Pass-through text fields: raw column <- source field (fixed names).
_PASS_THROUGH = {
    "scientific_name": "scientificName",
    "taxon_rank": "taxonRank",
    "basis_of_record": "basisOfRecord",
    "occurrence_status": "occurrenceStatus",
    "country_code": "countryCode",
    "state_province": "stateProvince",
    "dataset_key": "datasetKey",
    "publishing_org_key": "publishingOrgKey",
    "genus": "genus",
    "family": "family",
    "order": "order",
    "class_name": "class",
    "phylum": "phylum",
    "kingdom": "kingdom",
}


def _assemble(df: DataFrame, derived: dict[str, str], carry: Sequence[str]) -> DataFrame:
    """The 28 raw columns in storage order, plus carried columns; F1 filter."""
    exprs = [
        f"cast({derived[name]} as {dtype.simpleString()}) as {ident(name)}"
        for name, dtype in RAW_COLUMNS
    ]
    exprs += [ident(c) for c in carry]
    return df.selectExpr(*exprs).filter("gbif_id != ''")


def normalize_download(
    rows: DataFrame,
    carry: Sequence[str] = (),
    ingestion_ts: dt.datetime | None = None,
) -> DataFrame:
    """P2 + F1: download export rows (text or typed Parquet) -> raw rows.

    Rules: id = first truthy of gbifID / gbifKey, stripped (blank -> row
    dropped); species = first truthy of species / genus, stripped, else
    'Unknown'; counts via X3 with default 1; coordinates via X2; key = X3 of
    the id; issues = X5 of the first truthy of issues / issue; no media.
    """
    f = _Fields(rows)
    internal = set(carry) | {c for c in f.types if c.startswith("_")}
    gbif_id = strip_ws_sql(
        f"coalesce(cast({f.truthy('gbifID')} as string), "
        f"cast({f.truthy('gbifKey')} as string), '')"
    )
    first_name = f"coalesce({f.truthy('species')}, {f.truthy('genus')}, '')"
    species = f"coalesce(nullif({strip_ws_sql(first_name)}, ''), 'Unknown')"
    key_source = f"coalesce(cast({f.truthy('gbifID')} as string), {gbif_id})"
    issues = (
        f"case when {f.truthy('issues')} is not null then {f.issues_json('issues', f.truthy('issues'))} "
        f"when {f.truthy('issue')} is not null then {f.issues_json('issue', f.truthy('issue'))} end"
    )
    derived = {name: "null" for name, _ in RAW_COLUMNS}
    derived.update({src_to: f.text(src) for src_to, src in _PASS_THROUGH.items()})
    derived.update(
        {
            "gbif_id": gbif_id,
            "event_date": parse_event_date_sql(f.sql("eventDate")),
            "event_date_raw": f.text("eventDate"),
            "species": species,
            "individual_count": f.as_int("individualCount", 1, "int"),
            "latitude": f.as_double("decimalLatitude"),
            "longitude": f.as_double("decimalLongitude"),
            "coordinate_uncertainty_m": f.as_double("coordinateUncertaintyInMeters"),
            "key": coerce_int_sql(key_source, None, "bigint"),
            "taxon_key": f.as_int("taxonKey", None, "bigint"),
            "issues_json": issues,
            "media_count": "0",
            "ingestion_ts": _ingestion_ts_sql(ingestion_ts),
            "raw_payload": f.payload(sorted(internal)),
        }
    )
    return _assemble(rows, derived, carry)


def normalize_search(
    records: DataFrame,
    carry: Sequence[str] = (),
    ingestion_ts: dt.datetime | None = None,
) -> DataFrame:
    """P1 + F1: search-API records -> raw rows.

    Rules: id = first truthy of gbifID / key as text, not stripped (blank ->
    row dropped); species = first truthy of species / genus, else 'Unknown';
    count via X4; coordinates via X2; key / taxon key unchanged; issues list
    serialised as is; media_count = length of the media list (0 when absent);
    the payload is the whole record where its text is at hand (``_record``).
    """
    f = _Fields(records)
    internal = set(carry) | {c for c in f.types if c.startswith("_")}
    derived = {name: "null" for name, _ in RAW_COLUMNS}
    derived.update({src_to: f.text(src) for src_to, src in _PASS_THROUGH.items()})
    if "_count_type" in f.types:
        count = count_from_search_sql(f.sql("individualCount"), "_count_type")
    elif isinstance(f.dtype("individualCount"), T.IntegralType):
        count = f"coalesce(try_cast({f.sql('individualCount')} as int), 1)"
    elif isinstance(f.dtype("individualCount"), T.NumericType):
        count = coerce_int_double_sql(f.sql("individualCount"), 1, "int")
    else:
        count = count_from_search_sql(f.sql("individualCount"))
    media = f.sql("media")
    derived.update(
        {
            "gbif_id": (
                f"coalesce(cast({f.truthy('gbifID')} as string), "
                f"cast({f.truthy('key')} as string), '')"
            ),
            "event_date": parse_event_date_sql(f.sql("eventDate")),
            "event_date_raw": f.text("eventDate"),
            "species": f"coalesce({f.truthy('species')}, {f.truthy('genus')}, 'Unknown')",
            "individual_count": count,
            "latitude": f.as_double("decimalLatitude"),
            "longitude": f.as_double("decimalLongitude"),
            "coordinate_uncertainty_m": f.as_double("coordinateUncertaintyInMeters"),
            "key": f.sql("key"),
            "taxon_key": f.sql("taxonKey"),
            "issues_json": f.issues_json("issues"),
            "media_count": (
                f"case when {media} is null then 0 else size({media}) end"
                if "media" in f
                else "0"
            ),
            "ingestion_ts": _ingestion_ts_sql(ingestion_ts),
            "raw_payload": "_record" if "_record" in f.types else f.payload(sorted(internal)),
        }
    )
    return _assemble(records, derived, carry)


def legacy_projection(records: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """P4 + F5: search records -> the 6-column append-only legacy shape.

    Rows need both coordinates and a parseable date.  The id is the text of
    gbifID ('None' when absent); species falls back to genus, then 'Unknown'
    (an absent and a NULL genus are indistinguishable after a typed read).
    """
    f = _Fields(records)
    day = parse_event_date_sql(f.sql("eventDate"))
    lat, lon = f.as_double("decimalLatitude"), f.as_double("decimalLongitude")
    if "_count_type" in f.types:
        count = f"cast({count_from_search_sql(f.sql('individualCount'), '_count_type')} as bigint)"
    elif isinstance(f.dtype("individualCount"), T.NumericType):
        count = f"coalesce({f.as_int('individualCount', None, 'bigint')}, 1)"
    else:
        count = f"cast({count_from_search_sql(f.sql('individualCount'))} as bigint)"
    projected = records.selectExpr(
        f"coalesce(cast({f.sql('gbifID')} as string), 'None') as gbif_id",
        f"coalesce({f.truthy('species')}, {f.sql('genus')}, 'Unknown') as species",
        f"{day} as `date`",
        f"{lat} as latitude",
        f"{lon} as longitude",
        f"{count} as individual_count",
        *[ident(c) for c in carry],
    )
    return projected.filter("latitude is not null and longitude is not null and `date` is not null")
