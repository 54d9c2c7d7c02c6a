"""Every registered query of the reference's operators against its SQL, on the smallest given tables."""

import pytest

from __spark_entry__ import SMALL, entry
from check_oracle import compare, database
from registry.oracle import ORACLE
from registry.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    same, detail, *_ = compare(spark, con, SMALL, name)
    assert same, detail
