"""Every registered query against its reference SQL (DuckDB) on the smallest
tables; the driver repeats this at sf0.01."""

import pytest

import __spark_entry__ as E
from citystream.plans import catalog
from oracle_util import SF_SMALL, compare, duck

QUERIES = catalog.QUERIES
ORACLE = catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_reference(spark, con, name):
    problems, n_spark, n_ref = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["ward_id", "window_start", "window_end", "total_kwh_consumed",
                          "avg_power_factor", "peak_voltage"]
    assert df.count() > 0
