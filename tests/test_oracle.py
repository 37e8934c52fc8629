"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry_module
from tests.oracle_check import compare, duck
from workload import oracle
from workload import queries as workload_queries

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLE = workload_queries.QUERIES, oracle.ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem = compare(spark, con, name, QUERIES[name], ORACLE.get(name), SF_DIR)
    assert problem is None, problem


def test_every_oracle_has_a_query():
    assert set(ORACLE) == set(QUERIES)


def test_entry_registers_all():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLE) <= set(entry_module.oracle_sql())


def test_entry_runs(spark):
    assert entry_module.entry(spark).count() > 0
