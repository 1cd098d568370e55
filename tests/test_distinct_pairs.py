import pytest

from cartograph.operators.temporal import final_week_summary
from cartograph.operators.transactions import transaction_summary
from cartograph.sources import adapters as ad

ROWS = [("a", 1), ("a", 1), ("b", 1), (None, 2), ("c", None), (None, None)]


@pytest.mark.parametrize("rows", [ROWS, ROWS[:1], ROWS[-1:], []])
def test_distinct_counts_of_shared_pairs(spark, rows):
    got = transaction_summary(spark.createDataFrame(rows, "customer_id string, article_id int")).collect()
    want = (len(rows), len({c for c, _ in rows} - {None}), len({a for _, a in rows} - {None}))
    assert [tuple(r) for r in got] == [want]


def test_facts_are_shuffled_once_and_not_expanded(spark):
    tx = ad.transactions(spark, "/root/testdata/sf0.001")
    for df in (transaction_summary(tx), final_week_summary(tx, "1998-01-01", "1998-01-07")):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "Expand" not in plan and "ReusedExchange" in plan
