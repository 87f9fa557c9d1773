"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference

SF_DIR = os.environ.get("SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", queries())
def test_query(spark, duck, name):
    got = queries()[name](spark, SF_DIR).toPandas()
    sql = oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
    else:
        assert difference(got, duck.sql(sql).df()) is None
