"""Every registered query against its SQL, on all rows of the smallest tables."""

import pytest

import __spark_entry__ as entry
import check_oracle
from gaugeline.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert name in entry.oracle_sql()
    ok, note = check_oracle.compare(spark, con, name, SF)
    assert ok, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0
