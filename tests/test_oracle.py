"""Every query with SQL, on the given tables, against that SQL."""
import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, differences

SF = os.environ.get("TEST_SF", "/root/testdata/sf0.001")
ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(ORACLE) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(queries()[name](spark, SF), con, ORACLE[name]) is None


def test_entry(spark):
    assert entry(spark).count() > 0
