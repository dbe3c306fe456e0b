"""Every registered query against its SQL in a second engine."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from postgrain.plans.oracle import ORACLE_SQL as SQL
from postgrain.plans.queries import QUERIES
from tests.compare import difference, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return oracle_connection(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    assert difference(spark, oracle, QUERIES[name], SQL[name], SF_DIR) == ""


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() == 1
