"""Plan shape of every registered query of the retail library: no cartesian or
nested-loop joins and no Python evaluation, in the returned plan and in every
plan that the query materialises or writes on the way."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
SLOW = {"cv_grid_search", "best_params", "churn_boosted_wide"}  # searches: their inputs are those of churn_gbt
NAMES = sorted(set(entry.queries()) - set(entry._corpus()[0]) - SLOW)


@pytest.fixture
def plans(monkeypatch):
    """The executed plans of all checkpoints and Parquet writes."""
    from pyspark.sql.classic.dataframe import DataFrame
    from pyspark.sql.readwriter import DataFrameWriter

    seen = []
    checkpoint, parquet = DataFrame.checkpoint, DataFrameWriter.parquet

    def noted_checkpoint(self, *a, **k):
        seen.append(plan_of(self))
        return checkpoint(self, *a, **k)

    def noted_parquet(self, *a, **k):
        seen.append(plan_of(self._df))
        return parquet(self, *a, **k)

    monkeypatch.setattr(DataFrame, "checkpoint", noted_checkpoint)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted_parquet)
    return seen


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_plans_have_no_pair_explosion_or_python(spark, plans, name):
    plans.append(plan_of(entry.queries()[name](spark, SF)))
    for plan in plans:
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                    "FlatMapGroupsInPandas", "MapInPandas", "MapInArrow"):
            assert bad not in plan, f"{name}: {bad}"


def test_hot_article_and_category_stay_exact(spark):
    """An article, and with it a category and a customer, that holds a third of all rows."""
    from pyspark.sql import functions as F

    from cartograph.operators import products, recommend, store

    rows = spark.range(30_000).select(
        F.expr("date_add(date'2020-01-01', cast(id % 90 as int))").alias("t_dat"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 500)).alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 97 + 2).cast("long").alias("article_id"),
        (F.col("id") % 7).cast("double").alias("price"), (F.col("id") % 2 + 1).cast("int").alias("sales_channel_id"))
    articles = spark.range(1, 100).select(
        F.col("id").alias("article_id"), F.concat(F.lit("g"), F.col("id") % 5).alias("product_group_name"),
        F.concat(F.lit("k"), F.col("id") % 11).alias("colour_group_name"), F.lit("x").alias("garment_group_name"))
    revenue = {r.product_group_name: r.transaction_count for r in products.category_revenue(rows, articles).collect()}
    assert sum(revenue.values()) == 30_000 and max(revenue.values()) >= 10_000
    top = {r.customer_id: r.preferred_category for r in store.top_category(rows, articles, "2021-01-01").collect()}
    assert top["hot"] == "g1" and len(top) == rows.select("customer_id").distinct().count()
    lists = recommend.content_recommender(rows, articles, "2021-01-01").where("customer_id = 'hot'").orderBy("rank").collect()
    assert lists[0].article_id == 1 and [r["rank"] for r in lists] == list(range(1, len(lists) + 1))
