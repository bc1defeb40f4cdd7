"""Every registered query against its SQL counterpart, and the shape of the entry points."""

import pytest

import __spark_entry__ as entry
from clickfacts.queries import registry
from tests import oracle

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SMALL)


def test_every_query_has_sql():
    assert set(registry.ORACLES) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SMALL)
    result = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert oracle.spark_rows(df) == oracle.rows(columns, result.fetchall())
