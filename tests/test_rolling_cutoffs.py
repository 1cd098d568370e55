"""Rows at several cutoffs from one scan: equal to the flagship row at each, with gaps that span periods."""

import random

import pytest

from cartograph.functions.dates import add_days
from cartograph.operators import features, store

CUTOFFS = ["2020-01-10", "2020-01-20", "2020-02-15", "2020-06-01"]


def facts(spark, seed, n=400):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = add_days("2020-01-01", rng.choice([0, 3, 9, 10, 19, 20, 45, 46, rng.randint(0, 250)]))
        rows.append((day, rng.choice("abcdefgh"), rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, 0.5, 1.25]), rng.choice([1, 2])))
    rows += [("2020-02-15", "only on a cutoff", 1, 1.0, 2), ("2021-01-01", "too late", 1, 1.0, 2), (None, "a", 9, 1.0, 1)]
    return spark.createDataFrame(rows, "t_dat string, customer_id string, article_id long, price double, sales_channel_id int").selectExpr(
        "cast(t_dat as date) t_dat", "customer_id", "article_id", "price", "sales_channel_id")


def customers(spark):
    return spark.createDataFrame([("a", 30.0, "ACTIVE", None), ("b", None, None, "NONE")],
                                 "customer_id string, age double, club_member_status string, fashion_news_frequency string")


def rows_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed, horizon", [(1, 90), (2, 5)])
def test_equal_to_the_row_at_each_cutoff(spark, seed, horizon):
    tx, cu = facts(spark, seed), customers(spark)
    got = store.rolling_cutoff_features(tx, cu, CUTOFFS, horizon)
    assert got.columns[0] == "cutoff"
    for c in CUTOFFS:
        want = features.churn_features(tx, cu, cutoff=c, horizon_days=horizon)
        assert rows_of(got.where(f"cutoff = date'{c}'").drop("cutoff")) == rows_of(want), c


def test_one_cutoff_and_empty(spark):
    tx, cu = facts(spark, 3), customers(spark)
    assert rows_of(store.rolling_cutoff_features(tx, cu, CUTOFFS[1:2]).drop("cutoff")) == rows_of(
        features.churn_features(tx, cu, cutoff=CUTOFFS[1]))
    assert store.rolling_cutoff_features(tx.limit(0), cu, CUTOFFS).collect() == []


def test_stacked_sets(spark):
    tx, cu = facts(spark, 4), customers(spark)
    parts = [store.rolling_cutoff_features(tx, cu, some) for some in (CUTOFFS[:1], CUTOFFS[1:])]
    assert rows_of(store.stack_cutoffs(parts)) == rows_of(store.rolling_cutoff_features(tx, cu, CUTOFFS))


def test_facts_are_scanned_once(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    plans, checkpoint = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: (
        plans.append(self._jdf.queryExecution().executedPlan().toString()), checkpoint(self, *a, **k))[1])
    from cartograph.sources import adapters as ad
    sf = "/root/testdata/sf0.001"
    out = store.rolling_cutoff_features(ad.transactions(spark, sf), ad.customers(spark, sf), ad.ROLLING_CUTOFFS)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert "".join(plans).count("lineitem.parquet") == 1 and "Expand" not in "".join(plans)
