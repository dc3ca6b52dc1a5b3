"""Every registered query against its SQL counterpart, on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from clickloom.plans import oracle, queries as plans
from oracle_check import differences, views

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables")


@pytest.fixture(scope="module")
def sql():
    return views(SF_DIR)


def test_every_query_has_a_counterpart():
    assert set(plans.registered()) == set(oracle.registered())
    assert set(plans.registered()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(plans.registered()))
def test_query_equals_its_counterpart(spark, sql, name):
    result = plans.registered()[name](spark, SF_DIR).toPandas()
    assert differences(result, sql.sql(oracle.registered()[name]).df()) is None


def test_entry(spark):
    assert not contract.entry(spark).isEmpty()
