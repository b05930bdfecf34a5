"""Driver contract: entry smoke, oracle coverage, Spark vs DuckDB at sf0.001,
and plan properties (no Python UDF anywhere)."""

import pytest

import __spark_entry__ as E
from scripts.check_oracle import compare, duck_connection

from conftest import SF_SMALL

# tests of the optional training-data queries are kept with them
NAMES = sorted(n for n in E.queries() if n != "pipeline" and not n.startswith("op"))


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["species_id", "species_name", "individuals_observed", "observation_records"]
    assert 0 < df.count() <= 20


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    res = compare(spark, name, E.queries()[name], E.oracle_sql().get(name), SF_SMALL, duck)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("name", NAMES)
def test_no_python_udf_in_plan(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan
