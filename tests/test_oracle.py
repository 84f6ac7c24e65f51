"""Every registered query against its DuckDB SQL (sf0.001), as the driver
compares them."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from sigflow.plans.compare import compare, duckdb_connection

ORACLE = E.oracle_sql()
QUERIES = E.queries()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF001)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    out = compare(spark, SF001, name, QUERIES[name], ORACLE[name], con)
    assert out.ok, out.detail


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, name):
    assert QUERIES[name](spark, SF001).count() >= 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["signal_date", "hour_of_day", "generation_indicator", "sig_name", "sig_mapping_name", "value"]
    assert df.count() > 0
