import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracles import difference, duck
from labelmill.catalogue import QUERIES
from labelmill.oracles import ORACLES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def con():
    return duck(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() == 4


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert difference(spark, con, QUERIES[name], ORACLES[name], SF_DIR) is None
