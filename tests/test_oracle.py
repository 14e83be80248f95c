"""Every registered query with SQL beside it gives the same rows in DuckDB."""

import pytest

from serieskit.catalog import ORACLES, QUERIES
from tools.compare import compare, connect

SCALE = "/root/testdata/sf0.01"
CON = connect(SCALE)


def test_registry():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    fine, text = compare(spark, CON, name, QUERIES[name], ORACLES[name], SCALE)
    assert fine, text


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
