"""Every catalogued query runs, and equals its SQL oracle where there is one."""

import os

import pytest

import __spark_entry__ as entry_points
from tests import oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_oracle(spark, con, name):
    df = entry_points.queries()[name](spark, SF)
    assert oracle.compare(df, con, entry_points.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(entry_points.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    assert entry_points.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
