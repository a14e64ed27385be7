"""Every registered query against its oracle on the smallest tables."""

import pytest

from claimloom.plans.registry import ORACLE_SQL, QUERIES
from tests.oracle import connect, same

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    same(QUERIES[name](spark, SF), con, ORACLE_SQL[name])


def test_entry(spark):
    import __spark_entry__

    assert "bidder_rows" in __spark_entry__.queries()
    assert __spark_entry__.entry(spark).count() > 0
