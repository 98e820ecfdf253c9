"""Every registered query against its SQL on the smallest tables."""

import os

import pytest
from oracle_check import connect, differences

import __spark_entry__ as entry_points

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query(spark, connection, name):
    assert differences(spark, connection, name, SF_DIR) is None


def test_entry(spark):
    answers = entry_points.entry(spark)
    assert {"qid", "prediction", "conf", "low_conf"} <= set(answers.columns)
    assert answers.count() > 0
