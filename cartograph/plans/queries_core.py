"""Checked queries: sources, filters, joins and the churn feature family."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartograph.functions.dates import add_days
from cartograph.operators import features as feat
from cartograph.plans.oracle import D, FEATURE_DOUBLES, R, churn_feature_ctes, rounded_select, with_
from cartograph.plans.registry import register
from cartograph.sources import adapters as ad
from cartograph.sources.schemas import CHURN_FEATURE_COLUMNS

CUT = ad.CUTOFF
MS = 2  # fixture prices are cents: monetary sums are exact
END = add_days(ad.CUTOFF, ad.HORIZON_DAYS)


def _tx(spark, sf):
    return ad.transactions(spark, sf)


def churn_features_df(spark, sf):
    return feat.churn_features(_tx(spark, sf), ad.customers(spark, sf), cutoff=CUT,
                               horizon_days=ad.HORIZON_DAYS, money_scale=MS)


@register("churn_features", with_(*churn_feature_ctes(CUT, END))
          + rounded_select("feat", CHURN_FEATURE_COLUMNS, FEATURE_DOUBLES))
def q_churn_features(spark, sf):
    return churn_features_df(spark, sf)


@register("features_join", with_(*churn_feature_ctes(CUT, END))
          + rounded_select("feat", CHURN_FEATURE_COLUMNS, FEATURE_DOUBLES))
def q_features_join(spark, sf):
    tx = _tx(spark, sf)
    train, _ = feat.temporal_split(tx, CUT, ad.HORIZON_DAYS)
    return feat.features_join(
        feat.rfm_features(train, CUT, money_scale=MS), feat.interval_features(train),
        feat.channel_preference(train), feat.weekend_preference(train),
        feat.churn_labels(tx, CUT, ad.HORIZON_DAYS), ad.customers(spark, sf))


@register("rfm_features", with_(*churn_feature_ctes(CUT, END)) + f"""
SELECT customer_id, last_purchase_date, first_purchase_date, total_purchases, unique_shopping_days,
       unique_products, {R('total_spend')} AS total_spend, {R('avg_order_value')} AS avg_order_value,
       days_since_last_purchase, customer_tenure_days, {R('purchase_frequency')} AS purchase_frequency
FROM feat""")
def q_rfm(spark, sf):
    train, _ = feat.temporal_split(_tx(spark, sf), CUT, ad.HORIZON_DAYS)
    return feat.rfm_features(train, CUT, money_scale=MS)


@register("interval_features", with_(*churn_feature_ctes(CUT, END)) + f"""
SELECT customer_id, {R('a')} AS avg_days_between_purchases, {R('s')} AS std_days_between_purchases
FROM iv""")
def q_intervals(spark, sf):
    train, _ = feat.temporal_split(_tx(spark, sf), CUT, ad.HORIZON_DAYS)
    return feat.interval_features(train)


@register("purchase_gaps", with_(*churn_feature_ctes(CUT, END)) + f"""
SELECT customer_id, t_dat, prev_date, CAST(days_between AS INTEGER) AS days_between FROM (
  SELECT customer_id, t_dat, lag(t_dat) OVER (PARTITION BY customer_id ORDER BY t_dat) AS prev_date,
         date_diff('day', lag(t_dat) OVER (PARTITION BY customer_id ORDER BY t_dat), t_dat) AS days_between
  FROM (SELECT DISTINCT customer_id, t_dat FROM train) d) g
WHERE days_between IS NOT NULL""")
def q_gaps(spark, sf):
    train, _ = feat.temporal_split(_tx(spark, sf), CUT, ad.HORIZON_DAYS)
    return feat.purchase_gaps(train)


@register("channel_preference", with_(*churn_feature_ctes(CUT, END)) + f"""
SELECT customer_id, {R('online_ratio')} AS online_ratio FROM beh""")
def q_channel_pref(spark, sf):
    train, _ = feat.temporal_split(_tx(spark, sf), CUT, ad.HORIZON_DAYS)
    return feat.channel_preference(train)


@register("weekend_preference", with_(*churn_feature_ctes(CUT, END)) + f"""
SELECT customer_id, {R('weekend_ratio')} AS weekend_ratio FROM beh""")
def q_weekend_pref(spark, sf):
    train, _ = feat.temporal_split(_tx(spark, sf), CUT, ad.HORIZON_DAYS)
    return feat.weekend_preference(train)


@register("churn_labels", with_(*churn_feature_ctes(CUT, END)) + """
SELECT customer_id, is_churned FROM feat""")
def q_labels(spark, sf):
    return feat.churn_labels(_tx(spark, sf), CUT, ad.HORIZON_DAYS)


@register("label_join", with_(*churn_feature_ctes(CUT, END)) + """
SELECT customer_id, is_churned FROM feat""")
def q_label_join(spark, sf):
    train, label = feat.temporal_split(_tx(spark, sf), CUT, ad.HORIZON_DAYS)
    return feat.labels_by_presence(train, label)


@register("churn_distribution", with_(*churn_feature_ctes(CUT, END)) + f"""
SELECT is_churned, count(*) AS customers, {R('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct
FROM feat GROUP BY is_churned""")
def q_churn_dist(spark, sf):
    return feat.churn_distribution(churn_features_df(spark, sf))


@register("temporal_split", with_() + f"""
SELECT CASE WHEN t_dat < {D(CUT)} THEN 'train' ELSE 'label' END AS window_name,
       count(*) AS row_count, count(DISTINCT customer_id) AS customers,
       min(t_dat) AS first_day, max(t_dat) AS last_day
FROM tx WHERE t_dat < {D(END)} GROUP BY 1""")
def q_temporal_split(spark, sf):
    train, label = feat.temporal_split(_tx(spark, sf), CUT, ad.HORIZON_DAYS)

    def summ(df, name):
        return df.agg(F.lit(name).alias("window_name"), F.count(F.lit(1)).alias("row_count"),
                      F.count_distinct("customer_id").alias("customers"),
                      F.min("t_dat").alias("first_day"), F.max("t_dat").alias("last_day"))
    return summ(train, "train").unionByName(summ(label, "label"))
