"""Checked queries: documented feature-store features and their extensions."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from cartograph.functions.dates import add_days
from cartograph.operators import features as feat
from cartograph.operators import store
from cartograph.plans.oracle import D, FEATURE_DOUBLES, M, R, S, churn_feature_ctes, with_
from cartograph.plans.queries_core import CUT, END, MS, churn_features_df
from cartograph.plans.registry import register
from cartograph.sources import adapters as ad
from cartograph.sources.schemas import CHURN_FEATURE_COLUMNS

TR = f"tr AS (SELECT * FROM tx WHERE t_dat < {D(CUT)})"
TRA = "tra AS (SELECT t.*, a.product_group_name, a.colour_group_name, a.garment_group_name FROM tr t LEFT JOIN art a ON t.article_id = a.article_id)"
REC = f"""rec AS (SELECT customer_id, count(*) AS total_purchases,
  CAST(date_diff('day', max(t_dat), {D(CUT)}) AS INTEGER) AS days_since_last_purchase,
  CAST(date_diff('day', min(t_dat), {D(CUT)}) AS INTEGER) AS days_since_first_purchase FROM tr GROUP BY customer_id)"""


def _tx(spark, sf):
    return ad.transactions(spark, sf)


def _pref_sql(attr: str, name: str) -> str:
    return f"""SELECT customer_id, v AS {name}, cnt AS {name}_count FROM (
  SELECT customer_id, {attr} AS v, count(*) AS cnt,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, {attr}) AS rn
  FROM tra WHERE {attr} IS NOT NULL GROUP BY customer_id, {attr}) x WHERE rn = 1"""


@register("rfm_extended", with_(TR) + f"""
SELECT customer_id, max(price) AS max_single_purchase, min(price) AS min_single_purchase,
       {R(S('price'))} AS price_std_dev,
       CAST(date_diff('day', min(t_dat), {D(CUT)}) AS INTEGER) AS days_since_first_purchase,
       {R(f"count(*) / (date_diff('day', min(t_dat), {D(CUT)}) + 1)")} AS purchases_per_day,
       {R(M('price') + ' / count(price)')} AS spend_per_purchase,
       {R('count(DISTINCT article_id) / count(*)')} AS products_per_purchase
FROM tr GROUP BY customer_id""")
def q_rfm_ext(spark, sf):
    return store.rfm_extended(_tx(spark, sf), CUT, money_scale=MS)


@register("category_diversity", with_(TR, TRA) + """
SELECT customer_id, count(DISTINCT product_group_name) AS unique_categories,
       count(DISTINCT colour_group_name) AS unique_colors, count(DISTINCT garment_group_name) AS unique_garment_groups
FROM tra GROUP BY customer_id""")
def q_cat_div(spark, sf):
    return store.category_diversity(_tx(spark, sf), ad.articles(spark, sf), CUT)


@register("top_category", with_(TR, TRA) + _pref_sql("product_group_name", "preferred_category"))
def q_top_cat(spark, sf):
    return store.top_category(_tx(spark, sf), ad.articles(spark, sf), CUT)


@register("top_color", with_(TR, TRA) + _pref_sql("colour_group_name", "preferred_color"))
def q_top_color(spark, sf):
    return store.top_color(_tx(spark, sf), ad.articles(spark, sf), CUT)


@register("top3_categories", with_(TR, TRA) + """
SELECT customer_id, list_slice(list(product_group_name ORDER BY cnt DESC, product_group_name), 1, 3)
         AS top_categories FROM (
  SELECT customer_id, product_group_name, count(*) AS cnt FROM tra WHERE product_group_name IS NOT NULL
  GROUP BY 1, 2) x GROUP BY customer_id""")
def q_top3(spark, sf):
    return store.top3_categories(_tx(spark, sf), ad.articles(spark, sf), CUT)


@register("channel_counts", with_(TR) + f"""
SELECT customer_id, CAST(count_if(sales_channel_id = 1) AS BIGINT) AS store_purchases,
       CAST(count_if(sales_channel_id = 2) AS BIGINT) AS online_purchases,
       count(*) AS total_channel_purchases, {R('count_if(sales_channel_id = 2) / count(*)')} AS online_preference_ratio
FROM tr GROUP BY customer_id""")
def q_channel_counts(spark, sf):
    return store.channel_counts(_tx(spark, sf), CUT)


@register("preferred_channel", with_(TR) + """
SELECT customer_id, sales_channel_id AS preferred_channel FROM (
  SELECT customer_id, sales_channel_id,
         row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, sales_channel_id) AS rn
  FROM tr GROUP BY customer_id, sales_channel_id) x WHERE rn = 1""")
def q_pref_channel(spark, sf):
    return store.preferred_channel(_tx(spark, sf), CUT)


@register("temporal_features", with_(TR) + f"""
SELECT customer_id, CAST(count_if(dayofweek(t_dat) IN (0, 6)) AS BIGINT) AS weekend_purchases,
       CAST(month(max(t_dat)) AS INTEGER) AS last_purchase_month,
       {R('count_if(dayofweek(t_dat) IN (0, 6)) / count(*)')} AS weekend_purchase_ratio
FROM tr GROUP BY customer_id""")
def q_temporal_feat(spark, sf):
    return store.temporal_features(_tx(spark, sf), CUT)


IVX = """ivx AS (SELECT c.customer_id, avg(g) AS a, min(g) AS mn, max(g) AS mx, stddev_samp(g) AS s,
  count(g) AS ng FROM (SELECT DISTINCT customer_id FROM tr) c LEFT JOIN (
    SELECT customer_id, date_diff('day', lag(t_dat) OVER (PARTITION BY customer_id ORDER BY t_dat), t_dat) AS g
    FROM (SELECT DISTINCT customer_id, t_dat FROM tr) d) x ON c.customer_id = x.customer_id GROUP BY c.customer_id)"""
IVX_COLS = (f"{R('coalesce(a, -1.0)')} AS avg_days_between_purchases, "
            "CAST(coalesce(mn, -1) AS DOUBLE) AS min_days_between_purchases, "
            "CAST(coalesce(mx, -1) AS DOUBLE) AS max_days_between_purchases, "
            f"{R('CASE WHEN ng = 0 THEN -1.0 ELSE coalesce(s, 0.0) END')} AS std_days_between_purchases")


@register("interval_extended", with_(TR, IVX) + f"SELECT customer_id, {IVX_COLS} FROM ivx")
def q_iv_ext(spark, sf):
    return store.interval_extended(_tx(spark, sf), CUT)


@register("recency_churn_label", with_(TR, REC) + """
SELECT customer_id, days_since_last_purchase, CAST(days_since_last_purchase > 90 AS INTEGER) AS is_churned,
       CASE WHEN days_since_last_purchase <= 30 THEN 'Active' WHEN days_since_last_purchase <= 60 THEN 'Moderate'
            WHEN days_since_last_purchase <= 90 THEN 'High' ELSE 'Churned' END AS churn_risk_level FROM rec""")
def q_recency_label(spark, sf):
    r = store.recency(_tx(spark, sf), CUT)
    return r.select("customer_id", "days_since_last_purchase",
                    store.recency_churn_label("days_since_last_purchase").alias("is_churned"),
                    store.churn_risk_level().alias("churn_risk_level"))


@register("churn_risk_level", with_(TR, REC) + """
SELECT CASE WHEN days_since_last_purchase <= 30 THEN 'Active' WHEN days_since_last_purchase <= 60 THEN 'Moderate'
            WHEN days_since_last_purchase <= 90 THEN 'High' ELSE 'Churned' END AS churn_risk_level,
       count(*) AS customers FROM rec GROUP BY 1""")
def q_risk(spark, sf):
    r = store.recency(_tx(spark, sf), CUT)
    return r.groupBy(store.churn_risk_level().alias("churn_risk_level")).agg(F.count(F.lit(1)).alias("customers"))


@register("lifecycle_flags", with_(TR, REC) + f"""
SELECT customer_id, CAST(days_since_first_purchase < 30 AS INTEGER) AS is_new_customer,
       {R('total_purchases / greatest(days_since_first_purchase, 1)')} AS purchase_velocity,
       CAST(days_since_last_purchase > 60 AS INTEGER) AS is_at_risk,
       CAST(days_since_last_purchase > 90 AS INTEGER) AS is_churned_recency,
       CAST(days_since_last_purchase > 180 AS INTEGER) AS reactivation_needed FROM rec""")
def q_lifecycle_flags(spark, sf):
    r = store.recency(_tx(spark, sf), CUT).join(
        _tx(spark, sf).filter(F.col("t_dat") < F.lit(CUT).cast("date")).groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("total_purchases")), "customer_id")
    return store.lifecycle_flags(r)


@register("lifecycle_segment", with_(TR, REC) + """
SELECT customer_id, CASE WHEN days_since_last_purchase > 180 THEN 'dormant'
                         WHEN days_since_last_purchase > 60 THEN 'at_risk'
                         WHEN days_since_first_purchase < 90 THEN 'new' ELSE 'loyal' END AS lifecycle_segment FROM rec""")
def q_lifecycle_segment(spark, sf):
    return store.lifecycle_segment(store.recency(_tx(spark, sf), CUT))


RECENT = M(f"CASE WHEN t_dat >= {D(add_days(CUT, -90))} THEN price END")
PREVIOUS = M(f"CASE WHEN t_dat >= {D(add_days(CUT, -180))} AND t_dat < {D(add_days(CUT, -90))} THEN price END")


@register("spending_trend", with_(TR) + f"""
SELECT customer_id, {R(f'coalesce({RECENT}, 0.0)')} AS recent_spend, {R(f'coalesce({PREVIOUS}, 0.0)')} AS previous_spend,
       {R(f'coalesce({RECENT}, 0.0) - coalesce({PREVIOUS}, 0.0)')} AS spending_trend FROM tr GROUP BY customer_id""")
def q_spending_trend(spark, sf):
    return store.spending_trend(_tx(spark, sf), CUT, money_scale=MS)


@register("purchases_per_month", with_(TR) + f"""
SELECT customer_id, count(*) AS total_purchases, count(DISTINCT year(t_dat) * 100 + month(t_dat)) AS months_active,
       {R('count(*) / count(DISTINCT year(t_dat) * 100 + month(t_dat))')} AS purchases_per_month
FROM tr GROUP BY customer_id""")
def q_ppm(spark, sf):
    return store.purchases_per_month(_tx(spark, sf), CUT)


@register("basket_features", with_(TR) + f"""
SELECT customer_id, {R('avg(b)')} AS avg_basket_size, max(b) AS max_basket_size,
       CAST(max(b) > 5 AS INTEGER) AS is_bulk_buyer
FROM (SELECT customer_id, t_dat, count(*) AS b FROM tr GROUP BY 1, 2) x GROUP BY customer_id""")
def q_basket(spark, sf):
    return store.basket_features(_tx(spark, sf), CUT)


@register("engagement_flags", with_() + """
SELECT customer_id, coalesce(CAST(club_member_status = 'ACTIVE' AS INTEGER), 0) AS is_active_member,
       coalesce(CAST(fashion_news_frequency <> 'NONE' AS INTEGER), 0) AS subscribes_to_news FROM cust""")
def q_engagement_flags(spark, sf):
    return store.engagement_flags(ad.customers(spark, sf))


@register("category_concentration", with_(TR, TRA) + f"""
, pc AS ({_pref_sql("product_group_name", "preferred_category")})
SELECT t.customer_id, {R('coalesce(pc.preferred_category_count, 0) / count(*)')} AS top_category_share,
       {R('count(DISTINCT t.product_group_name) / count(*)')} AS browsing_diversity
FROM tra t LEFT JOIN pc ON t.customer_id = pc.customer_id GROUP BY t.customer_id, pc.preferred_category_count""")
def q_cat_conc(spark, sf):
    return store.category_concentration(_tx(spark, sf), ad.articles(spark, sf), CUT)


@register("category_recency", with_(TR, TRA) + f"""
SELECT customer_id, product_group_name,
       CAST(date_diff('day', max(t_dat), {D(CUT)}) AS INTEGER) AS days_since_last_in_category
FROM tra GROUP BY customer_id, product_group_name""")
def q_cat_recency(spark, sf):
    return store.category_recency(_tx(spark, sf), ad.articles(spark, sf), CUT)


MAJOR = ["PROMO", "STANDARD", "ECONOMY"]  # first words of the product groups


@register("category_recency_wide", with_(TR, TRA) + "SELECT customer_id, " + ", ".join(
    f"CAST(min(date_diff('day', t_dat, {D(CUT)})) FILTER (split_part(product_group_name, ' ', 1) = '{c}') AS INTEGER) AS \"{c}\""
    for c in MAJOR) + " FROM tra GROUP BY customer_id")
def q_cat_recency_wide(spark, sf):
    """Product groups taken together by their first word, then one column for each major one."""
    major = ad.articles(spark, sf).withColumn("product_group_name", F.split_part("product_group_name", F.lit(" "), F.lit(1)))
    return store.category_recency_wide(store.category_recency(_tx(spark, sf), major, CUT), MAJOR)


@register("peak_month_flag", with_(TR) + """
, pk AS (SELECT month FROM (SELECT month(t_dat) AS month, year(t_dat) AS y, count(*) AS n FROM tx GROUP BY 1, 2) m
         GROUP BY month ORDER BY avg(n) DESC, month LIMIT 3)
SELECT customer_id, CAST(CASE WHEN month(max(t_dat)) IN (SELECT month FROM pk) THEN 1 ELSE 0 END AS INTEGER)
         AS is_peak_month FROM tr GROUP BY customer_id""")
def q_peak(spark, sf):
    return store.peak_month_flag(_tx(spark, sf), CUT)


@register("multi_horizon_labels", with_() + f"""
SELECT customer_id, """ + ", ".join(
    f"CAST(1 - max(CASE WHEN t_dat >= {D(CUT)} AND t_dat < {D(add_days(CUT, h))} THEN 1 ELSE 0 END) AS INTEGER)"
    f" AS churn_{h}_days" for h in (30, 60, 90)) + f"""
FROM tx WHERE t_dat < {D(add_days(CUT, 90))} GROUP BY customer_id
HAVING max(CASE WHEN t_dat < {D(CUT)} THEN 1 ELSE 0 END) = 1""")
def q_multi_horizon(spark, sf):
    return store.multi_horizon_labels(_tx(spark, sf), CUT)


_CUTS_SQL = "(VALUES " + ", ".join(f"({D(c)})" for c in ad.ROLLING_CUTOFFS) + ") v(cutoff)"


@register("cutoff_expand", with_() + f"""
SELECT v.cutoff, count(*) AS row_count, count(DISTINCT t.customer_id) AS customers, max(t.t_dat) AS last_day
FROM tx t JOIN {_CUTS_SQL} ON t.t_dat < v.cutoff GROUP BY v.cutoff""")
def q_cutoff_expand(spark, sf):
    x = store.cutoff_expand(_tx(spark, sf), ad.ROLLING_CUTOFFS)
    return x.groupBy("cutoff").agg(F.count(F.lit(1)).alias("row_count"),
                                   F.count_distinct("customer_id").alias("customers"), F.max("t_dat").alias("last_day"))


def _stack_sql() -> str:
    parts = []
    for c in ad.ROLLING_CUTOFFS:
        cols = ", ".join(R(x) + f" AS {x}" if x in FEATURE_DOUBLES else x for x in CHURN_FEATURE_COLUMNS)
        parts.append(f"SELECT {D(c)} AS cutoff, * FROM ({with_(*churn_feature_ctes(c, add_days(c, 90)))}"
                     f" SELECT {cols} FROM feat)")
    return "\nUNION ALL\n".join(parts)


@register("rolling_cutoff_features", _stack_sql())
def q_rolling_cutoffs(spark, sf):
    return store.rolling_cutoff_features(_tx(spark, sf), ad.customers(spark, sf), ad.ROLLING_CUTOFFS, 90, money_scale=MS)


@register("stack_cutoffs", _stack_sql())
def q_stack(spark, sf):
    """The earlier cutoffs' set with the later ones' set under it."""
    tx, cu = _tx(spark, sf), ad.customers(spark, sf)
    half = len(ad.ROLLING_CUTOFFS) // 2
    return store.stack_cutoffs([store.rolling_cutoff_features(tx, cu, some, 90, money_scale=MS)
                                for some in (ad.ROLLING_CUTOFFS[:half], ad.ROLLING_CUTOFFS[half:])])


_K = repr(-math.log(2.0) / store.HALF_LIFE_DAYS)


@register("time_decayed_features", with_(TR) + f"""
SELECT customer_id, {R(f"sum(exp({_K} * date_diff('day', t_dat, {D(CUT)})))")} AS decayed_purchases,
       {R(f"sum(exp({_K} * date_diff('day', t_dat, {D(CUT)})) * price)")} AS decayed_spend
FROM tr GROUP BY customer_id""")
def q_decay(spark, sf):
    return store.time_decayed_features(_tx(spark, sf), CUT)


SCORES = """scores AS (SELECT customer_id,
  CAST(ntile(5) OVER (ORDER BY days_since_last_purchase DESC, customer_id) AS INTEGER) AS r_score,
  CAST(ntile(5) OVER (ORDER BY total_purchases, customer_id) AS INTEGER) AS f_score,
  CAST(ntile(5) OVER (ORDER BY total_spend, customer_id) AS INTEGER) AS m_score FROM feat)"""


@register("ntile_rfm_scores", with_(*churn_feature_ctes(CUT, END), SCORES) + "SELECT * FROM scores")
def q_ntile(spark, sf):
    return store.ntile_rfm_scores(churn_features_df(spark, sf))


@register("rfm_named_segments", with_(*churn_feature_ctes(CUT, END), SCORES) + """
SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
               WHEN f_score >= 4 THEN 'Loyal Customers'
               WHEN m_score >= 4 AND f_score <= 2 THEN 'Big Spenders'
               WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
               WHEN r_score <= 2 AND f_score >= 3 THEN 'At-Risk'
               WHEN r_score <= 2 AND f_score <= 2 AND m_score <= 2 THEN 'Lost'
               ELSE 'Others' END AS segment FROM scores""")
def q_named_segments(spark, sf):
    return store.rfm_named_segments(store.ntile_rfm_scores(churn_features_df(spark, sf)))


def _store40_sql() -> str:
    return with_(TR, TRA, IVX,
                 f"pcat AS ({_pref_sql('product_group_name', 'preferred_category')})",
                 f"pcol AS ({_pref_sql('colour_group_name', 'preferred_color')})") + f"""
, core AS (SELECT customer_id, max(t_dat) AS last_purchase_date, min(t_dat) AS first_purchase_date,
  count(*) AS total_purchases, count(DISTINCT t_dat) AS unique_shopping_days,
  count(DISTINCT article_id) AS unique_products_bought, {M('price')} AS total_spend,
  max(price) AS max_single_purchase, min(price) AS min_single_purchase, {S('price')} AS price_std_dev,
  CAST(count_if(sales_channel_id = 1) AS BIGINT) AS store_purchases, count(price) AS priced,
  CAST(count_if(sales_channel_id = 2) AS BIGINT) AS online_purchases,
  CAST(count_if(dayofweek(t_dat) IN (0, 6)) AS BIGINT) AS weekend_purchases,
  count(DISTINCT product_group_name) AS unique_categories, count(DISTINCT colour_group_name) AS unique_colors,
  count(DISTINCT garment_group_name) AS unique_garment_groups FROM tra GROUP BY customer_id)
SELECT c.club_member_status, k.customer_id, k.last_purchase_date, k.first_purchase_date, k.total_purchases,
  k.unique_shopping_days, k.unique_products_bought, {R('k.total_spend')} AS total_spend,
  {R('k.total_spend / k.priced')} AS avg_order_value, k.max_single_purchase, k.min_single_purchase,
  {R('k.price_std_dev')} AS price_std_dev,
  CAST(date_diff('day', k.last_purchase_date, {D(CUT)}) AS INTEGER) AS days_since_last_purchase,
  CAST(date_diff('day', k.first_purchase_date, {D(CUT)}) AS INTEGER) AS days_since_first_purchase,
  CAST(date_diff('day', k.first_purchase_date, k.last_purchase_date) AS INTEGER) AS customer_tenure_days,
  {R(f"k.total_purchases / (date_diff('day', k.first_purchase_date, {D(CUT)}) + 1)")} AS purchases_per_day,
  {R('k.total_spend / k.priced')} AS spend_per_purchase,
  {R('k.unique_products_bought / k.total_purchases')} AS products_per_purchase,
  pcat.preferred_category, pcat.preferred_category_count, pcol.preferred_color, pcol.preferred_color_count,
  k.store_purchases, k.online_purchases, k.total_purchases AS total_channel_purchases,
  {R('k.online_purchases / k.total_purchases')} AS online_preference_ratio,
  k.unique_categories, k.unique_colors, k.unique_garment_groups, k.weekend_purchases,
  CAST(month(k.last_purchase_date) AS INTEGER) AS last_purchase_month,
  {R('k.weekend_purchases / k.total_purchases')} AS weekend_purchase_ratio,
  {IVX_COLS},
  CAST(date_diff('day', k.last_purchase_date, {D(CUT)}) > 90 AS INTEGER) AS is_churned,
  CASE WHEN date_diff('day', k.last_purchase_date, {D(CUT)}) <= 30 THEN 'Active'
       WHEN date_diff('day', k.last_purchase_date, {D(CUT)}) <= 60 THEN 'Moderate'
       WHEN date_diff('day', k.last_purchase_date, {D(CUT)}) <= 90 THEN 'High' ELSE 'Churned' END AS churn_risk_level,
  CASE WHEN c.age > 100 THEN 100.0 ELSE c.age END AS age, c.fashion_news_frequency
FROM core k LEFT JOIN pcat ON k.customer_id = pcat.customer_id LEFT JOIN pcol ON k.customer_id = pcol.customer_id
LEFT JOIN ivx ON k.customer_id = ivx.customer_id LEFT JOIN cust c ON k.customer_id = c.customer_id"""


@register("feature_store_40", _store40_sql())
def q_store40(spark, sf):
    return store.feature_store_40(_tx(spark, sf), ad.customers(spark, sf), ad.articles(spark, sf), CUT,
                                  money_scale=MS)
