"""Every query with a SQL counterpart gives the same rows as that SQL in another engine."""

import pytest

import __spark_entry__ as contract
from civiclens.plans.catalog import QUERIES
from civiclens.plans.oracle_sql import ORACLE
from oracle_check import compare, connect

NO_COUNTERPART = {"model_benchmark", "closure_regression"}


@pytest.fixture(scope="module")
def connection(folder):
    return connect(folder)


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == NO_COUNTERPART
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows(name, spark, folder, connection):
    assert compare(contract.queries()[name](spark, folder), ORACLE[name], connection) == []


def test_entry_is_the_flagship(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["service_name", "department_name", "cnt"]
    assert 0 < frame.count() <= 10
