"""Checked queries: CSV sources (round trip of the given tables), prediction
sink, and the join / share / cumulative helpers the inventory names."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cartograph.functions.ranking import global_running_sum
from cartograph.functions.scalars import money_sum
from cartograph.operators import customers as cu
from cartograph.operators import ml, products
from cartograph.plans.oracle import M, R, churn_feature_ctes, with_
from cartograph.plans.queries_core import CUT, END, churn_features_df
from cartograph.plans.queries_quality import _store_dir
from cartograph.plans.registry import register
from cartograph.sources import adapters as ad
from cartograph.sources import readers, writers

def _raw(spark, sf, *tables):
    """The named tables exported as header CSV files (Spark-derived input for the readers)."""
    base = _store_dir(spark, f"raw-csv-{os.path.basename(sf)}")
    make = {"transactions_train": ad.transactions, "customers": ad.customers, "articles": ad.articles}
    for name in tables:
        make[name](spark, sf).write.option("header", "true").option("escape", '"').csv(os.path.join(base, f"{name}.csv"))
    return base


@register("read_transactions", with_() + """
SELECT t_dat, CAST(customer_id AS VARCHAR) AS customer_id, article_id, price, sales_channel_id FROM tx""")
def q_read_tx(spark, sf):
    return readers.read_transactions(spark, os.path.join(_raw(spark, sf, "transactions_train"), "transactions_train.csv"))


@register("read_customers", with_() + """
SELECT CAST(customer_id AS VARCHAR) AS customer_id, "FN", "Active", club_member_status, fashion_news_frequency,
       age, postal_code FROM cust""")
def q_read_cust(spark, sf):
    return readers.read_customers(spark, os.path.join(_raw(spark, sf, "customers"), "customers.csv"))


@register("read_articles", with_() + "SELECT * FROM art")
def q_read_art(spark, sf):
    return readers.read_articles(spark, os.path.join(_raw(spark, sf, "articles"), "articles.csv"))


@register("load_all", with_() + """
SELECT 'articles' AS table_name, count(*) AS row_count, 6 AS column_count FROM art
UNION ALL SELECT 'customers', count(*), 7 FROM cust
UNION ALL SELECT 'transactions', count(*), 5 FROM tx""")
def q_load_all(spark, sf):
    a, c, t = readers.load_all(spark, _raw(spark, sf, "articles", "customers", "transactions_train"))
    return readers.dataset_profile({"articles": a, "customers": c, "transactions": t})


SCORED = """sc AS (SELECT customer_id, is_churned,
  CASE WHEN CAST(days_since_last_purchase AS DOUBLE) / 180.0 > 1.0 THEN 1.0
       ELSE CAST(days_since_last_purchase AS DOUBLE) / 180.0 END AS probability_churn,
  CAST(CASE WHEN days_since_last_purchase > 60 THEN 1 ELSE 0 END AS DOUBLE) AS prediction FROM feat)"""


@register("write_predictions", with_(*churn_feature_ctes(CUT, END), SCORED) + f"""
SELECT customer_id, is_churned, {R('probability_churn')} AS probability_churn, prediction FROM sc""")
def q_write_predictions(spark, sf):
    scored = ml.rule_scores(churn_features_df(spark, sf))
    path = _store_dir(spark, f"rule-predictions-{os.path.basename(sf)}")
    writers.write_predictions(scored, path)
    return spark.read.parquet(path)


@register("impute_join", with_(*churn_feature_ctes(CUT, END)) + f"""
, med AS (SELECT club_member_status, median(age) AS m FROM feat
          WHERE age IS NOT NULL AND club_member_status IS NOT NULL GROUP BY 1)
SELECT f.customer_id, f.club_member_status, {R('f.age')} AS age, {R('med.m')} AS group_median_age
FROM feat f LEFT JOIN med ON f.club_member_status = med.club_member_status""")
def q_impute_join(spark, sf):
    from cartograph.functions.joins import join_small
    f = churn_features_df(spark, sf)
    med = (f.filter(F.col("age").isNotNull() & F.col("club_member_status").isNotNull())
            .groupBy("club_member_status").agg(F.median("age").alias("group_median_age")))
    return join_small(f.select("customer_id", "club_member_status", "age"), med, "club_member_status", "left")


@register("topk_detail_join", with_() + """
, top AS (SELECT article_id, count(*) AS transaction_count FROM tx GROUP BY article_id
          ORDER BY transaction_count DESC, article_id LIMIT 20)
SELECT top.article_id, art.prod_name, art.product_type_name, art.colour_group_name, art.product_group_name,
       top.transaction_count FROM top LEFT JOIN art ON top.article_id = art.article_id""")
def q_topk_detail(spark, sf):
    return products.product_popularity(ad.transactions(spark, sf), ad.articles(spark, sf), 20).drop(
        "unique_customers", "avg_purchases_per_customer")


@register("share_of_total", with_() + f"""
SELECT sales_channel_id, {R(M('price'))} AS revenue, {R(M('price') + ' * 100.0 / sum(' + M('price') + ') OVER ()')} AS pct
FROM tx GROUP BY sales_channel_id""")
def q_share(spark, sf):
    rev = ad.transactions(spark, sf).groupBy("sales_channel_id").agg(money_sum("price", 2).alias("revenue"))
    return cu.share_of_total(rev, "revenue")


@register("cumulative_share", with_() + f"""
, v AS (SELECT age, count(*) AS customers FROM cust WHERE age IS NOT NULL GROUP BY age)
SELECT age, customers, CAST(sum(customers) OVER (ORDER BY age) AS BIGINT) AS cumulative_customers,
       {R('sum(customers) OVER (ORDER BY age) * 100.0 / sum(customers) OVER ()')} AS cumulative_pct FROM v""")
def q_cumulative(spark, sf):
    v = ad.customers(spark, sf).filter(F.col("age").isNotNull()).groupBy("age").agg(
        F.count(F.lit(1)).alias("customers"))
    total = v.agg(F.sum("customers")).scalar()
    run = global_running_sum(v, [F.col("age").asc()], "customers", "cumulative_customers")
    return run.withColumn("cumulative_pct", F.col("cumulative_customers") * 100.0 / total)
