"""Every registered query with an oracle must equal its DuckDB SQL at sf0.001."""

import pytest

from scripts.check_oracle import key, rows_of

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    srows, scols = [tuple(r) for r in df.collect()], df.columns
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    a, ac = rows_of(scols, srows)
    b, bc = rows_of(dcols, res.fetchall())
    assert ac == bc
    a.sort(key=key)
    b.sort(key=key)
    assert a == b


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "customer_id"
    assert df.count() > 0


def test_every_query_has_a_callable():
    qs = entry.queries()
    assert set(ORACLE) <= set(qs)
    assert len(qs) >= 150
