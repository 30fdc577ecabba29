"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import connect, differences
from checks.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    found = differences(spark, con, sf_dir, QUERIES[name], ORACLES[name])
    assert [f for f in found if not f.startswith("no rows")] == []


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0
