"""Queries without an oracle (models, seeded samples) run and give rows."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
NO_ORACLE = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.mark.parametrize("name", NO_ORACLE)
def test_runs(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() >= 1
