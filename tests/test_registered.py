"""Every registered query against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as registered
from tests import oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF_DIR)


#: Those of the engine itself; the training-data operators, some without SQL, have tests of their own.
NAMES = [name for module in registered.MODULES for name in module.QUERIES]


def test_every_query_has_sql():
    assert set(NAMES) <= set(registered.queries()) and set(NAMES) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, duck, name):
    assert oracle.difference(spark, duck, name, SF_DIR) is None


def test_entry(spark):
    assert registered.entry(spark).count() > 0
