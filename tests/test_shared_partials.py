"""The feature store, concentration and customer stats from one scan: equal to the measures taken one by one."""

import datetime
import random
import statistics

import pytest

from cartograph.operators import customers, store
from cartograph.sources import adapters as ad

CUT = "2020-06-01"
SF = "/root/testdata/sf0.001"


def facts(spark, seed, n=300):
    rng = random.Random(seed)
    rows = [(str(datetime.date(2020, 1, 1) + datetime.timedelta(days=rng.randint(0, 220))), rng.choice(["a", "b", "c", "d", None]),
             rng.choice([None, 1, 2, 3, 4, 5, 99]), rng.choice([None, 0.25, 1.0, 3.75]), rng.choice([1, 2, 3, None])) for _ in range(n)]
    rows += [("2020-02-01", "one item", None, None, 1), ("2020-12-01", "too late", 1, 1.0, 2), (None, "undated", 2, 1.0, 1)]
    return spark.createDataFrame(rows, "t_dat string, customer_id string, article_id long, price double, sales_channel_id int").selectExpr(
        "cast(t_dat as date) t_dat", "customer_id", "article_id", "price", "sales_channel_id"), rows


def articles(spark):
    return spark.createDataFrame([(1, "top", "red", "x"), (2, "top", "blue", None), (3, "shoe", None, "x"), (4, None, "red", "y"), (5, "hat", "blue", "y")],
                                 "article_id long, product_group_name string, colour_group_name string, garment_group_name string")


def people(spark):
    return spark.createDataFrame([("a", 130.0, "ACTIVE", None), ("b", None, None, "NONE")],
                                 "customer_id string, age double, club_member_status string, fashion_news_frequency string")


def by_customer(df):
    rows = [r.asDict() for r in df.collect()]
    assert len({r["customer_id"] for r in rows}) == len(rows)
    return {r["customer_id"]: r for r in rows}


@pytest.mark.parametrize("seed, scale", [(1, 2), (2, None)])
def test_store_equals_its_parts(spark, seed, scale):
    tx, _ = facts(spark, seed)
    got = by_customer(store.feature_store_40(tx, people(spark), articles(spark), CUT, money_scale=scale))
    assert set(got) == {"a", "b", "c", "d", "one item"}
    known = tx.where("customer_id is not null")
    parts = [store.rfm_extended(known, CUT, scale), store.channel_counts(known, CUT), store.temporal_features(known, CUT),
             store.interval_extended(known, CUT), store.category_diversity(known, articles(spark), CUT),
             store.top_category(known, articles(spark), CUT), store.top_color(known, articles(spark), CUT), store.recency(known, CUT)]
    for part in map(by_customer, parts):
        for customer, want in part.items():
            for c, v in want.items():
                assert got[customer][c] == (pytest.approx(v, rel=1e-9, abs=1e-7) if isinstance(v, float) else v), (customer, c)
    assert got["a"]["age"] == 100.0 and got["c"]["age"] is None
    one = got["one item"]
    assert (one["unique_products_bought"], one["unique_categories"], one["preferred_category"]) == (0, 0, None)
    assert one["total_spend"] is None and one["std_days_between_purchases"] == -1.0


@pytest.mark.parametrize("seed", [3, 4])
def test_customer_stats(spark, seed):
    tx, rows = facts(spark, seed)
    got = by_customer(customers.customer_stats(tx, money_scale=2))
    assert set(got) == {r[1] for r in rows if r[1] is not None}
    for customer, r in got.items():
        own = [x for x in rows if x[1] == customer]
        prices = [x[3] for x in own if x[3] is not None]
        assert r["total_purchases"] == len(own) and r["shopping_days"] == len({x[0] for x in own})
        assert r["unique_products_bought"] == len({x[2] for x in own} - {None})
        assert r["total_spend"] == (sum(prices) if prices else None)
        assert r["avg_order_value"] == (pytest.approx(statistics.mean(prices)) if prices else None)


def test_concentration(spark):
    tx, rows = facts(spark, 5)
    group = {r["article_id"]: r["product_group_name"] for r in articles(spark).collect()}
    got = by_customer(store.category_concentration(tx, articles(spark), CUT))
    own = {}
    for day, customer, article, _, _ in rows:
        if customer is not None and day is not None and day < CUT:
            own.setdefault(customer, []).append(group.get(article))
    assert set(got) == set(own)
    for customer, groups in own.items():
        named = [g for g in groups if g is not None]
        assert got[customer]["top_category_share"] == pytest.approx(max((named.count(g) for g in named), default=0) / len(groups))
        assert got[customer]["browsing_diversity"] == pytest.approx(len(set(named)) / len(groups))


def test_empty(spark):
    tx = facts(spark, 6)[0].limit(0)
    for out in (store.feature_store_40(tx, people(spark), articles(spark), CUT), store.category_concentration(tx, articles(spark), CUT),
                store.category_diversity(tx, articles(spark), CUT), customers.customer_stats(tx)):
        assert out.collect() == []


@pytest.mark.parametrize("make", [
    lambda tx, cu, ar: store.feature_store_40(tx, cu, ar, money_scale=2), lambda tx, cu, ar: store.category_concentration(tx, ar),
    lambda tx, cu, ar: customers.customer_stats(tx, money_scale=2)])
def test_facts_are_scanned_once(spark, monkeypatch, make):
    from pyspark.sql.classic.dataframe import DataFrame
    plans, checkpoint = [], DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: (
        plans.append(self._jdf.queryExecution().executedPlan().toString()), checkpoint(self, *a, **k))[1])
    out = make(ad.transactions(spark, SF), ad.customers(spark, SF), ad.articles(spark, SF))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert "".join(plans).count("lineitem.parquet") == 1 and "Expand" not in "".join(plans)


def test_channels(spark):
    from cartograph.operators import transactions
    tx, rows = facts(spark, 7)
    out = transactions.channel_analysis(tx, money_scale=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    got = {r["sales_channel_id"]: r for r in out.collect()}
    assert set(got) == {1, 2, 3, None}
    for channel, r in got.items():
        own = [x for x in rows if x[4] == channel]
        prices = [x[3] for x in own if x[3] is not None]
        assert r["transaction_count"] == len(own)
        assert r["unique_customers"] == len({x[1] for x in own} - {None}) and r["unique_products"] == len({x[2] for x in own} - {None})
        assert r["avg_price"] == pytest.approx(statistics.mean(prices))
    assert transactions.channel_analysis(tx.limit(0)).collect() == []
