"""Data-quality checks as DataFrames of failing rows, plus a report and a gate.

A check passes when its failing-row DataFrame is empty.  The report counts
failing rows for many checks at once: all row-level predicates on one table
are counted in a single aggregate pass (``count_if`` per check), and each
grouped check (unique, unique combination, relationship) is one aggregate.
Only the report - one row per declared check - ever reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from occurra.functions.expr import lit_sql
from occurra.operators.staging import COORDS_IN_RANGE


# ---------------------------------------------------------------------------
# Individual checks -> failing rows
# ---------------------------------------------------------------------------
def check_not_null(df: DataFrame, column: str) -> DataFrame:
    """Q1: rows where ``column`` is NULL."""
    return df.filter(F.col(column).isNull())


def check_unique(df: DataFrame, column: str) -> DataFrame:
    """Q2: values of ``column`` present more than once (NULLs ignored)."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Q3: values outside the accepted set, with their counts (NULL is not flagged)."""
    return (
        df.filter(~F.col(column).isin(list(values)))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_records"))
    )


def check_expression(df: DataFrame, expression: str | Column, where: str | Column | None = None) -> DataFrame:
    """Q4-Q6: rows (optionally restricted by ``where``) where the expression is false."""
    expr = F.expr(expression) if isinstance(expression, str) else expression
    if where is not None:
        df = df.filter(F.expr(where) if isinstance(where, str) else where)
    return df.filter(~expr)


def check_unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Q7: combinations of ``columns`` present more than once."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def check_relationship(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row."""
    keys = parent.select(F.col(parent_column).alias(column))
    return child.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


# Q9 predicate: flagged valid yet coordinates missing or out of bounds.
VALID_LAT_LON_FAILS = f"is_valid_observation and not ({COORDS_IN_RANGE})"


def check_valid_lat_lon(df: DataFrame) -> DataFrame:
    """Q9: rows flagged valid whose coordinates are missing or out of bounds."""
    return df.filter(VALID_LAT_LON_FAILS)


# ---------------------------------------------------------------------------
# Declared checks and the report
# ---------------------------------------------------------------------------
@dataclass(eq=False)
class Check:
    """A declared check.

    ``kind``: ``row`` (``fails`` is SQL text of a per-row predicate; NULL
    passes), ``unique``, ``combination``, ``accepted`` or ``relationship``.
    """

    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    fails: str | None = None
    values: tuple = ()
    parent: str | None = None
    parent_column: str | None = None
    severity: str = "error"
    tags: tuple[str, ...] = field(default_factory=tuple)


def not_null(table: str, column: str, severity: str = "error") -> Check:
    return Check(
        f"not_null({column})", table, "row", (column,), f"`{column}` is null",
        severity=severity, tags=("not_null",),
    )


def expression_is_true(
    table: str, expression: str, where: str | None = None, severity: str = "error"
) -> Check:
    fails = f"not ({expression})" if where is None else f"({where}) and not ({expression})"
    label = f"expression_is_true({expression}{' where ' + where if where else ''})"
    return Check(label, table, "row", (), fails, severity=severity, tags=("expression",))


def declared_checks(gate_counts_on_staging: str = "error") -> list[Check]:
    """Q1-Q9 as declared for the raw, staging and mart models."""
    stg, dim = "stg_belgian_birds", "dim_species"
    fct, raw = "fct_daily_species_observations", "gbif_observations_raw"
    return [
        not_null(raw, "gbif_id"),
        not_null(stg, "gbif_id"),
        Check("unique(gbif_id)", stg, "unique", ("gbif_id",)),
        not_null(stg, "species_name"),
        not_null(stg, "individual_count"),
        expression_is_true(stg, "individual_count >= 0", severity=gate_counts_on_staging),
        Check(
            "accepted_values(is_valid_observation)", stg, "accepted",
            ("is_valid_observation",), values=(True, False),
        ),
        expression_is_true(stg, COORDS_IN_RANGE, where="is_valid_observation"),
        Check("valid_lat_lon", stg, "row", (), VALID_LAT_LON_FAILS, tags=("valid_lat_lon",)),
        not_null(dim, "species_id"),
        Check("unique(species_id)", dim, "unique", ("species_id",)),
        not_null(dim, "species_name"),
        not_null(dim, "first_observed_date"),
        not_null(dim, "last_observed_date"),
        not_null(dim, "total_observation_records"),
        expression_is_true(dim, "total_observation_records > 0"),
        Check(
            "unique_combination(observation_date, species_id)", fct, "combination",
            ("observation_date", "species_id"),
        ),
        not_null(fct, "observation_date"),
        not_null(fct, "species_id"),
        Check(
            "relationships(species_id -> dim_species.species_id)", fct, "relationship",
            ("species_id",), parent=dim, parent_column="species_id",
        ),
        not_null(fct, "observation_records"),
        expression_is_true(fct, "observation_records > 0"),
        not_null(fct, "individuals_observed"),
        expression_is_true(fct, "individuals_observed >= 0"),
    ]


REPORT_COLUMNS = ["check_name", "table_name", "severity", "failing_rows"]


def _sql_value(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return lit_sql(str(v))


def _row_sql(chk: Check, count_sql: str) -> str:
    return (
        f"named_struct('check_name', {lit_sql(chk.name)}, 'table_name', {lit_sql(chk.table)}, "
        f"'severity', {lit_sql(chk.severity)}, 'failing_rows', cast({count_sql} as bigint))"
    )


def _as_row_check(chk: Check) -> Check:
    """An accepted-values check as a test of each row (NULL is not flagged)."""
    values = ", ".join(_sql_value(v) for v in chk.values)
    return Check(chk.name, chk.table, "row", chk.columns, f"not (`{chk.columns[0]}` in ({values}))", severity=chk.severity)


def _one_pass(df: DataFrame, rows: list[Check], keyed: list[Check]) -> DataFrame:
    """Counts of the row checks and of one key check over a single scan.

    With a key check the row checks are counted per key first, so the table is
    read and shuffled once, by partial aggregation.
    """
    counts = [f"count_if({c.fails}) as c{i}" for i, c in enumerate(rows)]
    if keyed:
        (key,) = keyed
        # a single unique column ignores NULL, a combination doesn't
        real = f"`{key.columns[0]}` is not null" if key.kind == "unique" else "true"
        per_key = df.groupBy(*[F.col(c) for c in key.columns]).agg(
            *[F.expr(c) for c in counts], F.expr("count(1) as n")
        ).selectExpr(*[f"c{i}" for i in range(len(rows))], f"n > 1 and {real} as again")
        total = per_key.selectExpr(*[f"sum(c{i}) as c{i}" for i in range(len(rows))], "count_if(again) as k")
    else:
        total = df.selectExpr(*counts)
    made = [_row_sql(c, f"coalesce(c{i}, 0)") for i, c in enumerate(rows)] + [_row_sql(c, "k") for c in keyed]
    return total.selectExpr(f"inline(array({', '.join(made)}))")


def dq_report(tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Q10: one row per check with its failing-row count.

    A table's row checks and its first key check share one pass.
    """
    parts: list[DataFrame] = []
    checks = [_as_row_check(c) if c.kind == "accepted" else c for c in checks]
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        rows = [c for c in own if c.kind == "row"]
        keyed = [c for c in own if c.kind in ("unique", "combination")]
        if rows or keyed:
            parts.append(_one_pass(tables[table], rows, keyed[:1]))
        parts += [_one_pass(tables[table], [], [c]) for c in keyed[1:]]
        for chk in own:
            if chk.kind == "relationship":
                failing = check_relationship(
                    tables[table], chk.columns[0], tables[chk.parent], chk.parent_column
                )
                parts.append(failing.selectExpr(f"inline(array({_row_sql(chk, 'count(1)')}))"))
            elif chk not in rows and chk not in keyed:
                raise ValueError(f"unknown check kind {chk.kind!r}")
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame, fail_on: Sequence[str] = ("error",)) -> list[dict]:
    """Raise when any check of a gating severity has failing rows.

    The report holds one row per declared check, so collecting it is bounded
    by the number of checks, not by the data.
    """
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if r["failing_rows"] and r["severity"] in fail_on]
    if failed:
        detail = ", ".join(f"{r['table_name']}.{r['check_name']}={r['failing_rows']}" for r in failed)
        raise QualityGateError(f"{len(failed)} data-quality check(s) failed: {detail}")
    return rows
