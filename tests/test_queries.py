import pytest

import __spark_entry__ as entry
from warpline.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(same, name):
    assert same(QUERIES[name], ORACLES[name]) > 0


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert len(set(rows.select("verdict").distinct().collect())) > 1


def test_registered():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
