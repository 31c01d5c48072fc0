"""Every registered query against its SQL, row by row, over the whole test tables."""

from __future__ import annotations

import pytest
from compare import differences, sql_engine

import __spark_entry__ as driver

from parity.oracle import ORACLE
from parity.queries import QUERIES


@pytest.fixture(scope="module")
def engine(sf_dir):
    with sql_engine(sf_dir) as engine:
        yield engine


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, sf_dir, engine, name):
    assert differences(QUERIES[name](spark, sf_dir), engine, ORACLE[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert driver.entry(spark).count() == 3
