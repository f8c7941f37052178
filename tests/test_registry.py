"""Every registered query against its oracle on the smallest test tables."""

import os

import pytest
from check import compare, connect

from resight.registry import ORACLES, QUERIES

FOLDER = os.environ.get("RESIGHT_TEST_SF", "/root/testdata/sf0.001")
NO_ORACLE: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = compare(spark, con, name, QUERIES[name], ORACLES.get(name), FOLDER)
    assert result.startswith(("ok", "no oracle")), result


def test_only_known_queries_lack_an_oracle():
    assert set(QUERIES) - set(ORACLES) == NO_ORACLE


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).limit(1).count() == 1
    assert set(contract.oracle_sql()) <= set(contract.queries())
