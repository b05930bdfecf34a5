"""Scalar parse / coercion rules as native Spark SQL expressions.

Each rule is written once as SQL expression text (``*_sql`` builders taking
the SQL text of their input) and exposed as a ``Column`` through
``F.expr``.  The text form keeps plan construction to one JVM parse per
column; the expressions are built-ins (regex guards plus ``try_cast``) that
run on the JVM, with no Python worker.

Regexes guard every cast because Spark's casts accept text the source system
rejects (``'5d'`` as a double, ``'2024-03'`` as a date) and vice versa.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Accepted text shapes.
# ---------------------------------------------------------------------------
# Whitespace removed by str.strip(): every character for which Python's
# str.isspace() holds (all lie below U+3001).
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
# ISO date-time accepted by the 'T' branch: day, hour, optional minute, second
# and fraction (any length, after '.' or ','), optional Z or +hh[[:]mm] offset.
ISO_DATETIME_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2})T([01]\d|2[0-3])(?::([0-5]\d)(?::[0-5]\d(?:[.,]\d+)?)?)?"
    r"(?:(Z)|([+-])([01]\d|2[0-3])(?::?([0-5]\d))?)?$"
)
# Calendar date accepted by the %Y-%m-%d branch (month/day may be unpadded;
# a day may be written with a leading blank).
YMD_PATTERN = r"^(\d{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12]\d|0[1-9]|[1-9]| [1-9])$"
# Decimal text accepted by float(): sign, digits with single underscores,
# optional fraction and exponent, or nan / inf / infinity.
FLOAT_PATTERN = (
    r"^[+-]?(((\d(_?\d)*)(\.(\d(_?\d)*)?)?|\.\d(_?\d)*)([eE][+-]?\d(_?\d)*)?"
    r"|(?i:nan|inf|infinity))$"
)
# Integer text accepted by int(): sign, digits with single underscores.
INT_PATTERN = r"^[+-]?\d(_?\d)*$"


def lit_sql(text: str) -> str:
    """A SQL string literal for ``text`` (backslashes and quotes escaped,
    control and non-ASCII characters as \\uXXXX)."""
    body = text.replace("\\", "\\\\").replace("'", "\\'")
    return "'" + "".join(c if 32 <= ord(c) < 127 else f"\\u{ord(c):04x}" for c in body) + "'"


def ident(name: str) -> str:
    """A quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def _col(x: str) -> Column:
    return F.expr(x)


# ---------------------------------------------------------------------------
# Text helpers
# ---------------------------------------------------------------------------
def strip_ws_sql(x: str) -> str:
    """Remove leading / trailing whitespace of any kind (like ``str.strip``)."""
    return f"btrim({x}, {lit_sql(WHITESPACE)})"


# ---------------------------------------------------------------------------
# Event dates
# ---------------------------------------------------------------------------
def let_sql(name: str, value: str, body: str) -> str:
    """SQL of ``body`` with ``name`` standing for ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def parse_event_date_sql(x: str) -> str:
    """Event-date text -> DATE.

    * NULL / '' -> NULL; surrounding whitespace removed; trailing 'Z' = UTC.
    * Text containing 'T' must be an ISO date-time; zoned values are moved to
      UTC before the calendar day is taken, naive values keep their wall-clock
      day (independent of the session time zone).
    * Otherwise the first 10 characters must be a %Y-%m-%d calendar date.
    * Anything else, including impossible days, is NULL.

    One pattern takes a date-time apart: day, hour, minute, Z, and the offset's
    sign, hours and minutes.  The UTC day is the written one moved by whole days
    of the minutes since its midnight, less the offset.
    """
    minutes = "(cast(concat('0', p[1]) as int) * 60 + cast(concat('0', p[2]) as int))"
    offset = "(cast(concat('0', p[5]) as int) * 60 + cast(concat('0', p[6]) as int))"
    moved = f"cast(floor(({minutes} - if(p[4] = '-', -1, 1) * {offset}) / 1440) as int)"
    zoned = let_sql(
        "p", f"split(regexp_replace(s, {lit_sql(ISO_DATETIME_PATTERN)}, '$1|$2|$3|$4|$5|$6|$7'), '[|]')",
        f"case when size(p) = 7 then date_add(try_cast(p[0] as date), {moved}) end",
    )
    plain = let_sql(
        "h", "substring(s, 1, 10)",
        f"case when h rlike {lit_sql(YMD_PATTERN)} then try_cast(replace(h, ' ', '') as date) end",
    )
    body = f"case when s is null or s = '' then null when contains(s, 'T') then {zoned} else {plain} end"
    return let_sql("s", strip_ws_sql(f"cast({x} as string)"), body)


# ---------------------------------------------------------------------------
# numbers
# ---------------------------------------------------------------------------
def coerce_float_sql(x: str) -> str:
    """Text -> DOUBLE, NULL when it is not a float literal."""
    s = strip_ws_sql(f"cast({x} as string)")
    return (
        f"case when {s} rlike {lit_sql(FLOAT_PATTERN)} "
        f"then try_cast(replace({s}, '_', '') as double) end"
    )


def _trunc_double_sql(d: str, target: str) -> str:
    return (
        f"case when not isnan({d}) and abs({d}) < double('inf') "
        f"then try_cast(case when {d} < 0 then ceil({d}) else floor({d}) end as {target}) end"
    )


def coerce_int_sql(x: str, default: int | None = None, target: str = "bigint") -> str:
    """``int(float(x))`` with a default for missing / bad values.

    Integral text is cast straight to the integer type (exact above 2**53);
    decimal or exponent text goes through DOUBLE and truncates toward zero.
    NaN, infinities and out-of-range values give the default.
    """
    s = strip_ws_sql(f"cast({x} as string)")
    clean = f"replace({s}, '_', '')"
    dbl = f"try_cast({clean} as double)"
    out = (
        f"case when {s} rlike {lit_sql(INT_PATTERN)} then try_cast({clean} as {target}) "
        f"when {s} rlike {lit_sql(FLOAT_PATTERN)} then {_trunc_double_sql(dbl, target)} end"
    )
    return out if default is None else f"coalesce({out}, cast({int(default)} as {target}))"


def coerce_int_double_sql(x: str, default: int | None = None, target: str = "bigint") -> str:
    """X3 for a DOUBLE input: truncate toward zero; NaN / inf -> default."""
    out = _trunc_double_sql(f"cast({x} as double)", target)
    return out if default is None else f"coalesce({out}, cast({int(default)} as {target}))"


def count_from_search_sql(x: str, json_type: str | None = None) -> str:
    """``int(x)`` for the search path; missing or non-integer text -> 1.

    With ``json_type`` (SQL of the value's JSON type) a JSON number truncates
    toward zero and a boolean counts 1 or 0, however they are written.
    """
    if json_type is not None:
        whole = f"try_cast({x} as int)"
        number = _trunc_double_sql(f"try_cast({x} as double)", "int")
        return (
            f"case when {json_type} = 'BOOLEAN' then cast({x} = 'true' as int) "
            f"when {json_type} = 'STRING' or {json_type} is null then {count_from_search_sql(x)} "
            f"when {json_type} = 'VOID' then 1 else coalesce({whole}, {number}, 1) end"
        )
    s = strip_ws_sql(f"cast({x} as string)")
    return (
        f"coalesce(case when {s} rlike {lit_sql(INT_PATTERN)} "
        f"then try_cast(replace({s}, '_', '') as int) end, 1)"
    )


# ---------------------------------------------------------------------------
# JSON text
# ---------------------------------------------------------------------------
# Elements that need no JSON escaping: printable ASCII other than '"' and '\\'.
PLAIN_JSON_TEXT = r"^[ !#-\[\]-~]*$"


def json_list_sql(arr: str) -> str:
    """JSON text of a string list with ', ' separators (``json.dumps`` layout).

    Plain elements are quoted directly; others go through ``to_json``.
    """
    escaped = "substring(to_json(array(e)), 2, length(to_json(array(e))) - 2)"
    item = (
        f"case when e is null then 'null' when e rlike {lit_sql(PLAIN_JSON_TEXT)} "
        f"then concat('\"', e, '\"') else {escaped} end"
    )
    return f"concat('[', array_join(transform({arr}, e -> {item}), ', '), ']')"


def issues_json_from_text_sql(x: str) -> str:
    """X5 (text form): 'A; B' -> '["A", "B"]'; nothing left -> NULL."""
    parts = f"filter(transform(split({x}, ';'), p -> {strip_ws_sql('p')}), p -> p != '')"
    return f"case when {x} is not null and {x} != '' and size({parts}) > 0 then {json_list_sql(parts)} end"


def issues_json_from_list_sql(x: str) -> str:
    """X5 (list form): the list serialised as is; NULL list -> NULL."""
    return f"case when {x} is not null then {json_list_sql(x)} end"


def row_json_sql(fields: list[str]) -> str:
    """JSON object of the named fields, NULL fields kept."""
    inner = ", ".join(f"{lit_sql(n)}, {ident(n)}" for n in fields)
    return f"to_json(named_struct({inner}), map('ignoreNullFields', 'false'))"


# ---------------------------------------------------------------------------
# rounding
# ---------------------------------------------------------------------------
def portable_round_sql(x: str, digits: int = 2) -> str:
    """Half-away-from-zero rounding that agrees across engines.

    The value is first rounded to 9 places to drop last-bit noise of averages,
    then scaled, rounded on its magnitude and scaled back, all in DOUBLE.
    """
    scale = f"{float(10 ** digits)!r}D"
    return f"sign({x}) * floor(abs(round({x}, 9) * {scale}) + 0.5D) / {scale}"


# ---------------------------------------------------------------------------
# Column forms
# ---------------------------------------------------------------------------
def strip_ws(x: str) -> Column:
    return _col(strip_ws_sql(x))


def parse_event_date(x: str) -> Column:
    return _col(parse_event_date_sql(x))


def coerce_float(x: str) -> Column:
    return _col(coerce_float_sql(x))


def coerce_int(x: str, default: int | None = None, target: str = "bigint") -> Column:
    return _col(coerce_int_sql(x, default, target))


def count_from_search(x: str) -> Column:
    return _col(count_from_search_sql(x))


def issues_json_from_text(x: str) -> Column:
    return _col(issues_json_from_text_sql(x))


def issues_json_from_list(x: str) -> Column:
    return _col(issues_json_from_list_sql(x))


def portable_round(x: str, digits: int = 2) -> Column:
    return _col(portable_round_sql(x, digits))
