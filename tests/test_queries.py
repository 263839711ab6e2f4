"""Every registered query against its SQL twin."""

from __future__ import annotations

import pytest

import __spark_entry__ as contract
from tallyloom.plans import all_oracles, all_queries
from tests.compare import connect, mismatch

QUERIES = {name: contract.queries()[name] for name in all_queries()}
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["word", "lang", "n"] and frame.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, sf_dir, connection, name):
    assert mismatch(QUERIES[name](spark, sf_dir), connection, ORACLES[name]) is None
