"""Every registered query runs on the smoke data and matches its DuckDB oracle."""

import pytest

import __spark_entry__ as entry
from plume.plans.registry import oracle_statements, registered_queries
from plume.plans.verify import compare, duck

from conftest import SF_SMALL

QUERIES = registered_queries()  # the document operators have tests of their own
ORACLE = oracle_statements()
# every registered query has an oracle statement
ROWS_ONLY: set = set()


def test_oracle_coverage():
    assert set(QUERIES) - set(ORACLE) == ROWS_ONLY
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    if name in ROWS_ONLY:
        assert QUERIES[name](spark, SF_SMALL).count() >= 0
        return
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_SMALL, con)
    assert r["match"], r
