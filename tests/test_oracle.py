"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry
from paperloom.registry.catalogue import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def conn():
    return connect(FOLDER)


def test_every_sql_has_a_query():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, conn, name):
    assert compare(spark, conn, QUERIES[name], ORACLE[name], FOLDER) is None


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["year", "topic_name", "num_papers"]
    assert result.count() > 0
