"""Checked queries: exploratory analytics over customers, products, transactions,
time series and cohorts (all on the full tables)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cartograph.functions import dates as fd
from cartograph.functions import scalars as fs
from cartograph.functions.joins import materialize
from cartograph.operators import cohort, customers, products, temporal
from cartograph.operators import transactions as txo
from cartograph.operators.features import purchase_gaps
from cartograph.plans.oracle import D, M, R, S, with_
from cartograph.plans.queries_core import MS
from cartograph.plans.registry import register
from cartograph.sources import adapters as ad

STATS = f"""stats AS (SELECT customer_id, count(*) AS total_purchases,
  count(DISTINCT article_id) AS unique_products_bought, {M('price')} AS total_spend,
  {M('price')} / count(price) AS avg_order_value, min(t_dat) AS first_purchase_date,
  max(t_dat) AS last_purchase_date, count(DISTINCT t_dat) AS shopping_days FROM tx GROUP BY customer_id)"""
BEH = """beh AS (SELECT s.*, c.age, c.club_member_status, c.fashion_news_frequency FROM stats s
  JOIN cust c ON s.customer_id = c.customer_id
  WHERE c.age IS NOT NULL AND c.club_member_status IS NOT NULL)"""
STATS_COLS = ("customer_id, total_purchases, unique_products_bought, "
              f"{R('total_spend')} AS total_spend, {R('avg_order_value')} AS avg_order_value, "
              "first_purchase_date, last_purchase_date, shopping_days")
GAPS = """gaps AS (SELECT customer_id, t_dat,
  date_diff('day', lag(t_dat) OVER (PARTITION BY customer_id ORDER BY t_dat), t_dat) AS days_between
  FROM (SELECT DISTINCT customer_id, t_dat FROM tx) d)"""
DAILY = """daily AS (SELECT t_dat, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
  count(*) / count(DISTINCT customer_id) AS trans_per_customer FROM tx GROUP BY t_dat)"""
FW = f"t_dat BETWEEN {D(ad.FINAL_WEEK_START)} AND {D(ad.FINAL_WEEK_END)}"


def _tx(spark, sf):
    return ad.transactions(spark, sf)


def _stats(spark, sf):
    return customers.customer_stats(_tx(spark, sf), money_scale=MS)


def _beh(spark, sf):
    return customers.behavior_join(_stats(spark, sf), ad.customers(spark, sf))


def _bins_sql(col: str, edges, labels, right: bool) -> str:
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = f"{col} > {lo} AND {col} <= {hi}" if right else f"{col} >= {lo} AND {col} < {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


def _r2(expr: str) -> str:
    return f"(round(({expr}) * 100.0) / 100.0)"


# ---------------------------------------------------------------- customers

@register("customer_stats", with_(STATS) + f"SELECT {STATS_COLS} FROM stats")
def q_customer_stats(spark, sf):
    return _stats(spark, sf)


@register("customer_stats_summary", with_(STATS) + f"""
SELECT min(total_purchases) AS min_purchases, max(total_purchases) AS max_purchases,
       {R('avg(total_purchases)')} AS avg_purchases, {R('min(total_spend)')} AS min_spend,
       {R('max(total_spend)')} AS max_spend, {R(M('total_spend') + ' / count(total_spend)')} AS avg_spend
FROM stats""")
def q_stats_summary(spark, sf):
    return customers.customer_stats_summary(_stats(spark, sf), money_scale=MS)


@register("loyalty_tiers", with_(STATS) + f"""
SELECT tier, count(*) AS customers, {R('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM (
  SELECT CASE WHEN total_purchases = 1 THEN 'one-time' WHEN total_purchases < 10 THEN 'occasional (2-9)'
              WHEN total_purchases < 50 THEN 'loyal (10-49)' ELSE 'vip (50+)' END AS tier FROM stats) t
GROUP BY tier""")
def q_loyalty(spark, sf):
    return customers.loyalty_tiers(_stats(spark, sf))


for _name, _measure in (("top_spenders", "total_spend"), ("top_frequent", "total_purchases"),
                        ("top_diverse", "unique_products_bought")):
    def _mk(measure):
        def q(spark, sf):
            return customers.top_customers(_stats(spark, sf), measure, 10)
        return q
    register(_name, with_(STATS) + f"SELECT {STATS_COLS} FROM stats ORDER BY {_measure} DESC, customer_id LIMIT 10")(
        _mk(_measure))


@register("pareto_share", with_(STATS) + f"""
, rk AS (SELECT total_spend, row_number() OVER (ORDER BY total_spend DESC, customer_id) AS rank FROM stats),
n AS (SELECT count(*) AS n FROM stats),
fr AS (SELECT CAST(p AS DOUBLE) AS p FROM (VALUES (0.1), (0.2)) v(p))
SELECT fr.p AS top_fraction, CAST(floor(n.n * fr.p) AS BIGINT) AS top_customers,
       {R("coalesce(" + M("CASE WHEN rk.rank <= floor(n.n * fr.p) THEN rk.total_spend END") + ", 0.0)")} AS top_revenue,
       {R(M('rk.total_spend'))} AS total_revenue,
       {R("coalesce(" + M("CASE WHEN rk.rank <= floor(n.n * fr.p) THEN rk.total_spend END") + ", 0.0) * 100.0 / "
          + M('rk.total_spend'))} AS revenue_share_pct
FROM rk, n, fr GROUP BY fr.p, n.n""")
def q_pareto(spark, sf):
    return customers.pareto_share(_stats(spark, sf), (0.1, 0.2), money_scale=MS)


@register("top_n_pct", with_(STATS) + f"""
SELECT * FROM (SELECT {STATS_COLS},
  row_number() OVER (ORDER BY total_spend DESC, customer_id) AS rank FROM stats) r
WHERE rank <= floor((SELECT count(*) FROM stats) * CAST(0.1 AS DOUBLE))""")
def q_top_n_pct(spark, sf):
    return customers.top_n_pct(_stats(spark, sf), 0.1)


@register("behavior_join", with_(STATS, BEH) + f"""
SELECT {STATS_COLS}, age, club_member_status, fashion_news_frequency FROM beh""")
def q_behavior(spark, sf):
    return _beh(spark, sf)


@register("club_behavior", with_(STATS, BEH) + f"""
SELECT club_member_status, {R(_r2('avg(total_purchases)'))} AS total_purchases,
       {R(_r2(M('total_spend') + ' / count(total_spend)'))} AS total_spend,
       {R(_r2('avg(unique_products_bought)'))} AS unique_products_bought,
       {R(_r2('avg(shopping_days)'))} AS shopping_days
FROM beh GROUP BY club_member_status""")
def q_club(spark, sf):
    return customers.club_behavior(_beh(spark, sf), money_scale=MS)


@register("news_behavior", with_(STATS, BEH) + f"""
SELECT fashion_news_frequency, {R(_r2('avg(total_purchases)'))} AS total_purchases,
       {R(_r2(M('total_spend') + ' / count(total_spend)'))} AS total_spend
FROM beh GROUP BY fashion_news_frequency""")
def q_news(spark, sf):
    return customers.news_behavior(_beh(spark, sf), money_scale=MS)


@register("age_band_behavior", with_(STATS, BEH) + f"""
SELECT age_band, {R('avg(total_purchases)')} AS total_purchases,
       {R(M('total_spend') + ' / count(total_spend)')} AS total_spend FROM (
  SELECT *, {_bins_sql('age', customers.AGE_EDGES_RIGHT_CLOSED, customers.AGE_LABELS_BEHAVIOR, True)} AS age_band
  FROM beh) b WHERE age_band IS NOT NULL GROUP BY age_band""")
def q_age_band(spark, sf):
    return customers.age_band_behavior(_beh(spark, sf), money_scale=MS)


_CORR_COLS = ["total_purchases", "total_spend", "unique_products_bought", "shopping_days", "age"]


@register("correlation_matrix", with_(STATS, BEH) + "\nUNION ALL\n".join(
    f"SELECT '{a}' AS var_x, '{b}' AS var_y, {R(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))')} AS corr FROM beh"
    for a in _CORR_COLS for b in _CORR_COLS))
def q_corr(spark, sf):
    return customers.correlation_matrix(_beh(spark, sf), _CORR_COLS)


def _vcs_sql(attr: str, src: str) -> str:
    return (f"SELECT '{attr}' AS attribute, CAST({attr} AS VARCHAR) AS value, count(*) AS count, "
            f"{R('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM {src} GROUP BY {attr}")


@register("value_counts_share", with_() + "\nUNION ALL\n".join([
    _vcs_sql("club_member_status", "cust"), _vcs_sql("fashion_news_frequency", "cust"),
    _vcs_sql("product_group_name", "art"), _vcs_sql("colour_group_name", "art")]))
def q_vcs(spark, sf):
    c, a = ad.customers(spark, sf), ad.articles(spark, sf)
    return (customers.value_counts_share(c, "club_member_status")
            .unionByName(customers.value_counts_share(c, "fashion_news_frequency"))
            .unionByName(customers.value_counts_share(a, "product_group_name"))
            .unionByName(customers.value_counts_share(a, "colour_group_name")))


@register("engagement_metrics", with_() + f"""
SELECT count(*) AS customers, CAST(count_if(club_member_status = 'ACTIVE') AS BIGINT) AS active_members,
       {R("count_if(club_member_status = 'ACTIVE') * 100.0 / count(*)")} AS active_pct,
       CAST(count_if(fashion_news_frequency IN ('Regularly', 'Monthly')) AS BIGINT) AS news_subscribers,
       {R("count_if(fashion_news_frequency IN ('Regularly', 'Monthly')) * 100.0 / count(*)")} AS news_pct
FROM cust""")
def q_engagement(spark, sf):
    return customers.engagement_metrics(ad.customers(spark, sf))


@register("age_describe", with_() + f"""
SELECT count(age) AS count, {R('avg(age)')} AS mean, {R('stddev_samp(age)')} AS std, min(age) AS min,
       {R('quantile_cont(age, 0.25)')} AS p25, {R('quantile_cont(age, 0.5)')} AS p50,
       {R('quantile_cont(age, 0.75)')} AS p75, max(age) AS max FROM cust""")
def q_age_describe(spark, sf):
    return customers.age_describe(ad.customers(spark, sf))


@register("age_percentiles", with_() + f"""
SELECT {R('quantile_cont(age, 0.25)')} AS p25, {R('quantile_cont(age, 0.5)')} AS p50,
       {R('quantile_cont(age, 0.75)')} AS p75 FROM cust""")
def q_age_pct(spark, sf):
    return customers.age_percentiles(ad.customers(spark, sf))


@register("age_outliers_iqr", with_() + f"""
, q AS (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.75) AS q3 FROM cust)
SELECT {R('q1')} AS q1, {R('q3')} AS q3, {R('q3 - q1')} AS iqr, {R('q1 - 1.5 * (q3 - q1)')} AS lower_bound,
       {R('q3 + 1.5 * (q3 - q1)')} AS upper_bound,
       CAST(count_if(age < q1 - 1.5 * (q3 - q1) OR age > q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
FROM cust, q WHERE age IS NOT NULL GROUP BY q1, q3""")
def q_age_outliers(spark, sf):
    return customers.age_outliers_iqr(ad.customers(spark, sf))


@register("age_group_distribution", with_() + f"""
SELECT age_group, count(*) AS customers,
       {R('count(*) * 100.0 / (SELECT count(age) FROM cust)')} AS pct FROM (
  SELECT {_bins_sql('age', customers.AGE_EDGES_LEFT_CLOSED, customers.AGE_LABELS_LEFT_CLOSED, False)} AS age_group
  FROM cust WHERE age IS NOT NULL) g WHERE age_group IS NOT NULL GROUP BY age_group""")
def q_age_groups(spark, sf):
    return customers.age_group_distribution(ad.customers(spark, sf))


@register("crosstab_share", with_() + f"""
SELECT age_group, club_member_status, count(*) AS customers,
       {R('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY age_group)')} AS row_pct FROM (
  SELECT {_bins_sql('age', customers.AGE_EDGES_RIGHT_CLOSED, customers.AGE_LABELS_CROSSTAB, True)} AS age_group,
         club_member_status FROM cust WHERE age IS NOT NULL AND club_member_status IS NOT NULL) x
WHERE age_group IS NOT NULL GROUP BY age_group, club_member_status""")
def q_crosstab(spark, sf):
    return customers.crosstab_share(ad.customers(spark, sf))


# ---------------------------------------------------------------- products

@register("product_popularity", with_() + f"""
, top AS (SELECT article_id, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers
          FROM tx GROUP BY article_id ORDER BY transaction_count DESC, article_id LIMIT 20)
SELECT top.article_id, art.prod_name, art.product_type_name, art.colour_group_name, art.product_group_name,
       top.transaction_count, top.unique_customers,
       {R('top.transaction_count / top.unique_customers')} AS avg_purchases_per_customer
FROM top LEFT JOIN art ON top.article_id = art.article_id""")
def q_popularity(spark, sf):
    return products.product_popularity(_tx(spark, sf), ad.articles(spark, sf), 20)


_CATALOG = ["prod_name", "product_type_name", "product_group_name", "colour_group_name", "garment_group_name"]


@register("catalog_cardinality", with_() + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS attribute, count(DISTINCT {c}) AS distinct_values FROM art" for c in _CATALOG))
def q_catalog(spark, sf):
    return products.catalog_cardinality(ad.articles(spark, sf), _CATALOG)


CATREV = f"""catrev AS (SELECT a.product_group_name, count(*) AS transaction_count,
  {M('t.price')} AS total_revenue, count(DISTINCT t.customer_id) AS unique_customers,
  {M('t.price')} / count(t.price) AS avg_price FROM tx t LEFT JOIN art a ON t.article_id = a.article_id
  GROUP BY a.product_group_name)"""


@register("category_revenue", with_(CATREV) + f"""
SELECT product_group_name, transaction_count, {R('total_revenue')} AS total_revenue, unique_customers,
       {R('avg_price')} AS avg_price FROM catrev""")
def q_catrev(spark, sf):
    return products.category_revenue(_tx(spark, sf), ad.articles(spark, sf), money_scale=MS)


@register("category_share_top5_others", with_(CATREV) + f"""
, rk AS (SELECT *, row_number() OVER (ORDER BY total_revenue DESC, product_group_name NULLS LAST) AS r FROM catrev)
SELECT category, {R('revenue')} AS revenue, {R('revenue * 100.0 / sum(revenue) OVER ()')} AS pct FROM (
  SELECT CASE WHEN r <= 5 THEN product_group_name ELSE 'Others' END AS category,
         {M('total_revenue')} AS revenue FROM rk GROUP BY 1) x""")
def q_top5(spark, sf):
    rev = products.category_revenue(_tx(spark, sf), ad.articles(spark, sf), money_scale=MS)
    return products.category_share_top5_others(rev, money_scale=MS)


@register("top12_articles", with_() + f"""
SELECT article_id, count(*) AS train_count FROM tx WHERE t_dat < {D(ad.HISTORY_BEFORE)}
GROUP BY article_id ORDER BY train_count DESC, article_id LIMIT 12""")
def q_top12(spark, sf):
    return products.top_articles(_tx(spark, sf), 12, before=ad.HISTORY_BEFORE)


@register("fact_dim_join", with_() + """
SELECT t.*, a.product_group_name, a.garment_group_name FROM tx t LEFT JOIN art a ON t.article_id = a.article_id""")
def q_fact_dim(spark, sf):
    return _tx(spark, sf).join(ad.articles(spark, sf).select("article_id", "product_group_name", "garment_group_name"),
                               "article_id", "left")


# ---------------------------------------------------------------- transactions

@register("transaction_summary", with_() + """
SELECT count(*) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT article_id) AS unique_products FROM tx""")
def q_tx_summary(spark, sf):
    return txo.transaction_summary(_tx(spark, sf))


@register("price_stats", with_() + f"""
SELECT min(price) AS min_price, max(price) AS max_price, {R(M('price') + ' / count(price)')} AS avg_price,
       {R(S('price'))} AS std_price FROM tx""")
def q_price(spark, sf):
    return txo.price_stats(_tx(spark, sf), money_scale=MS)


@register("channel_breakdown", with_() + f"""
SELECT sales_channel_id, CASE sales_channel_id WHEN 1 THEN 'Store' WHEN 2 THEN 'Online' END AS channel_name,
       count(*) AS count, {R('count(*) * 100.0 / sum(count(*)) OVER ()')} AS pct FROM tx GROUP BY sales_channel_id""")
def q_channel_breakdown(spark, sf):
    return txo.channel_breakdown(_tx(spark, sf))


@register("channel_analysis", with_() + f"""
SELECT sales_channel_id, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT article_id) AS unique_products, {R(M('price') + ' / count(price)')} AS avg_price,
       CASE sales_channel_id WHEN 1 THEN 'Store' WHEN 2 THEN 'Online' END AS channel_name
FROM tx GROUP BY sales_channel_id""")
def q_channel_analysis(spark, sf):
    return txo.channel_analysis(_tx(spark, sf), money_scale=MS)


@register("purchase_frequency_stats", with_() + f"""
SELECT min(c) AS min_purchases, max(c) AS max_purchases, {R('avg(c)')} AS avg_purchases
FROM (SELECT count(*) AS c FROM tx GROUP BY customer_id) x""")
def q_freq_stats(spark, sf):
    return txo.purchase_frequency_stats(_tx(spark, sf))


@register("histogram", with_() + f"""
, b AS (SELECT min(price) AS lo, max(price) AS hi FROM tx)
SELECT sales_channel_id, bin, {R('lo + bin * ((hi - lo) / 50)')} AS bin_start,
       {R('lo + (bin + 1) * ((hi - lo) / 50)')} AS bin_end, count(*) AS count FROM (
  SELECT t.sales_channel_id, b.lo, b.hi,
         CAST(CASE WHEN (b.hi - b.lo) / 50 = 0 THEN 0
                   WHEN floor((t.price - b.lo) / ((b.hi - b.lo) / 50)) >= 50 THEN 49
                   ELSE floor((t.price - b.lo) / ((b.hi - b.lo) / 50)) END AS INTEGER) AS bin
  FROM tx t, b) x GROUP BY sales_channel_id, bin, lo, hi""")
def q_histogram(spark, sf):
    return txo.histogram(_tx(spark, sf), "price", bins=50, by="sales_channel_id")


@register("histogram_purchases_capped", with_() + f"""
, c AS (SELECT CAST(CASE WHEN count(*) > 100 THEN 100 ELSE count(*) END AS DOUBLE) AS x FROM tx GROUP BY customer_id),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM c)
SELECT bin, {R('lo + bin * ((hi - lo) / 50)')} AS bin_start, {R('lo + (bin + 1) * ((hi - lo) / 50)')} AS bin_end,
       count(*) AS count FROM (
  SELECT b.lo, b.hi, CAST(CASE WHEN (b.hi - b.lo) / 50 = 0 THEN 0
                              WHEN floor((c.x - b.lo) / ((b.hi - b.lo) / 50)) >= 50 THEN 49
                              ELSE floor((c.x - b.lo) / ((b.hi - b.lo) / 50)) END AS INTEGER) AS bin
  FROM c, b) y GROUP BY bin, lo, hi""")
def q_histogram_capped(spark, sf):
    per = _tx(spark, sf).groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_purchases"))
    return txo.histogram(per, "total_purchases", bins=50, cap=100)


@register("empirical_cdf", with_(GAPS) + f"""
, v AS (SELECT CASE WHEN days_between > 365 THEN 365 ELSE days_between END AS value, count(*) AS count
        FROM gaps WHERE days_between IS NOT NULL GROUP BY 1)
SELECT CAST(value AS INTEGER) AS value, count, CAST(sum(count) OVER (ORDER BY value) AS BIGINT) AS cumulative_count,
       {R('sum(count) OVER (ORDER BY value) * 100.0 / sum(count) OVER ()')} AS cumulative_pct FROM v""")
def q_ecdf(spark, sf):
    return txo.empirical_cdf(purchase_gaps(_tx(spark, sf)), "days_between", cap=365)


@register("sample_rows", with_() + """
SELECT count(*) AS rows, true AS share_in_bounds, true AS repeatable, CAST(0 AS BIGINT) AS foreign_rows FROM tx""")
def q_sample(spark, sf):
    """What holds of any seeded 2 % sample: its size is within five standard deviations, the seed repeats it,
    and it has no row that the table lacks."""
    tx = materialize(_tx(spark, sf).select("price", "sales_channel_id"))
    one, two = txo.sample_rows(tx, 0.02, 42), txo.sample_rows(tx, 0.02, 42)
    digest = F.sum(F.xxhash64("price", "sales_channel_id").cast("decimal(38,0)"))
    foreign = one.join(tx.distinct(), ["price", "sales_channel_id"], "left_anti").agg(F.count(F.lit(1)))
    n, sampled = F.col("rows"), one.agg(F.count(F.lit(1))).scalar()
    return tx.agg(F.count(F.lit(1)).alias("rows")).select(
        "rows", (F.abs(sampled - n * 0.02) <= 5 * F.sqrt(n * 0.02 * 0.98)).alias("share_in_bounds"),
        one.agg(digest).scalar().eqNullSafe(two.agg(digest).scalar()).alias("repeatable"),
        foreign.scalar().alias("foreign_rows"))


@register("hash_sample", with_() + """
SELECT * FROM tx WHERE (CAST(('0x' || substr(md5(concat_ws(':', '42', CAST(customer_id AS VARCHAR),
  CAST(t_dat AS VARCHAR), CAST(article_id AS VARCHAR))), 1, 8)) AS UBIGINT) % 10000) < 500""")
def q_hash_sample(spark, sf):
    return txo.hash_sample(_tx(spark, sf), 0.05, ["customer_id", "t_dat", "article_id"])


# ---------------------------------------------------------------- time series

@register("daily_activity", with_(DAILY) + f"""
SELECT t_dat, transaction_count, unique_customers, {R('trans_per_customer')} AS trans_per_customer FROM daily""")
def q_daily(spark, sf):
    return temporal.daily_activity(_tx(spark, sf))


@register("rolling_mean_7", with_(DAILY) + f"""
SELECT t_dat, transaction_count, unique_customers, {R('trans_per_customer')} AS trans_per_customer,
       {R('CASE WHEN count(*) OVER w = 7 THEN avg(transaction_count) OVER w END')} AS transaction_count_ma7,
       {R('CASE WHEN count(*) OVER w = 7 THEN avg(unique_customers) OVER w END')} AS unique_customers_ma7,
       {R('CASE WHEN count(*) OVER w = 7 THEN avg(trans_per_customer) OVER w END')} AS trans_per_customer_ma7
FROM daily WINDOW w AS (ORDER BY t_dat ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def q_rolling(spark, sf):
    return temporal.rolling_mean(temporal.daily_activity(_tx(spark, sf)),
                                 ["transaction_count", "unique_customers", "trans_per_customer"])


@register("daily_summary", with_(DAILY) + f"""
SELECT {R('avg(transaction_count)')} AS mean_daily_transactions, max(transaction_count) AS max_daily_transactions,
       min(transaction_count) AS min_daily_transactions, {R('avg(unique_customers)')} AS mean_daily_customers
FROM daily""")
def q_daily_summary(spark, sf):
    return temporal.daily_summary(temporal.daily_activity(_tx(spark, sf)))


@register("monthly_rollup", with_(DAILY) + """
SELECT CAST(year(t_dat) AS INTEGER) AS year, CAST(month(t_dat) AS INTEGER) AS month,
       CAST(sum(transaction_count) AS BIGINT) AS transaction_count,
       CAST(sum(unique_customers) AS BIGINT) AS unique_customers_summed,
       CAST(year(t_dat) AS VARCHAR) || '-' || lpad(CAST(month(t_dat) AS VARCHAR), 2, '0') AS year_month,
       strftime(min(t_dat), '%b') AS month_name
FROM daily GROUP BY 1, 2, 5""")
def q_monthly_rollup(spark, sf):
    return temporal.monthly_rollup(temporal.daily_activity(_tx(spark, sf)))


@register("dow_pattern", with_(DAILY) + f"""
, g AS (SELECT strftime(t_dat, '%a') AS day_name, CAST(isodow(t_dat) - 1 AS INTEGER) AS day_index,
        avg(transaction_count) AS avg_transactions, avg(unique_customers) AS avg_customers FROM daily GROUP BY 1, 2)
SELECT day_name, day_index, {R('avg_transactions')} AS avg_transactions, {R('avg_customers')} AS avg_customers,
       CAST(avg_transactions = max(avg_transactions) OVER () AS INTEGER) AS is_busiest,
       CAST(avg_transactions = min(avg_transactions) OVER () AS INTEGER) AS is_slowest FROM g""")
def q_dow(spark, sf):
    return temporal.dow_pattern(temporal.daily_activity(_tx(spark, sf)))


SEAS = """seas AS (SELECT CAST(year(t_dat) AS INTEGER) AS year, CAST(month(t_dat) AS INTEGER) AS month,
  count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers FROM tx GROUP BY 1, 2)"""


@register("monthly_seasonality", with_(SEAS) + """
SELECT year, month, transaction_count, unique_customers, strftime(make_date(year, month, 1), '%b') AS month_name
FROM seas""")
def q_seasonality(spark, sf):
    return temporal.monthly_seasonality(_tx(spark, sf))


@register("month_of_year_average", with_(SEAS) + f"""
, g AS (SELECT month, avg(transaction_count) AS avg_transactions, avg(unique_customers) AS avg_customers
        FROM seas GROUP BY month)
SELECT month, strftime(make_date(2000, month, 1), '%b') AS month_name, {R('avg_transactions')} AS avg_transactions,
       {R('avg_customers')} AS avg_customers,
       CAST(avg_transactions = max(avg_transactions) OVER () AS INTEGER) AS is_peak,
       CAST(avg_transactions = min(avg_transactions) OVER () AS INTEGER) AS is_low FROM g""")
def q_month_avg(spark, sf):
    return temporal.month_of_year_average(temporal.monthly_seasonality(_tx(spark, sf)))


@register("interval_stats", with_(GAPS) + f"""
SELECT CAST(min(days_between) AS INTEGER) AS min_days, CAST(max(days_between) AS INTEGER) AS max_days,
       {R('avg(days_between)')} AS avg_days, {R('stddev_samp(days_between)')} AS std_days
FROM gaps WHERE days_between IS NOT NULL""")
def q_interval_stats(spark, sf):
    return temporal.interval_stats(_tx(spark, sf))


@register("interval_within_days", with_(GAPS) + "SELECT count(*) AS gaps, " + ", ".join(
    f"{R(f'avg(CAST(days_between <= {d} AS DOUBLE)) * 100.0')} AS pct_within_{d}" for d in temporal.WITHIN_DAYS)
    + f", {R('median(days_between)')} AS median_days FROM gaps WHERE days_between IS NOT NULL")
def q_within(spark, sf):
    return temporal.interval_within_days(_tx(spark, sf))


@register("final_week_summary", with_() + f"""
SELECT count(*) AS total_transactions, count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT article_id) AS unique_products FROM tx WHERE {FW}""")
def q_final_week(spark, sf):
    return temporal.final_week_summary(_tx(spark, sf), ad.FINAL_WEEK_START, ad.FINAL_WEEK_END)


@register("final_week_vs_history", with_() + f"""
, h AS (SELECT avg(c) AS hist FROM (SELECT count(*) AS c FROM tx WHERE t_dat < {D(ad.HISTORY_BEFORE)} GROUP BY t_dat) x)
SELECT count(*) AS final_transactions, {R('(SELECT hist FROM h)')} AS historical_daily_avg,
       {R('count(*) / 7.0')} AS final_daily_avg,
       {R('(count(*) / 7.0 / (SELECT hist FROM h) - 1) * 100.0')} AS diff_pct FROM tx WHERE {FW}""")
def q_final_vs_hist(spark, sf):
    return temporal.final_week_vs_history(_tx(spark, sf), ad.FINAL_WEEK_START, ad.FINAL_WEEK_END, ad.HISTORY_BEFORE)


@register("popularity_coverage", with_() + f"""
, top AS (SELECT article_id FROM tx WHERE t_dat < {D(ad.HISTORY_BEFORE)} GROUP BY article_id
          ORDER BY count(*) DESC, article_id LIMIT 12),
fw AS (SELECT * FROM tx WHERE {FW}),
hits AS (SELECT count(DISTINCT customer_id) AS h FROM fw WHERE article_id IN (SELECT article_id FROM top))
SELECT count(DISTINCT customer_id) AS final_customers, (SELECT h FROM hits) AS customers_hit,
       {R('(SELECT h FROM hits) * 100.0 / count(DISTINCT customer_id)')} AS coverage_pct FROM fw""")
def q_coverage(spark, sf):
    return temporal.popularity_coverage(_tx(spark, sf), ad.FINAL_WEEK_START, ad.FINAL_WEEK_END, ad.HISTORY_BEFORE)


# ---------------------------------------------------------------- cohorts

COHORT = """cm AS (SELECT DISTINCT customer_id, CAST(year(t_dat) * 100 + month(t_dat) AS INTEGER) AS ym FROM tx),
fc AS (SELECT customer_id, min(ym) AS cohort_month FROM cm GROUP BY customer_id),
cc AS (SELECT fc.cohort_month, CAST((cm.ym // 100 - fc.cohort_month // 100) * 12
                                  + (cm.ym % 100 - fc.cohort_month % 100) AS INTEGER) AS periods_since_cohort,
              count(*) AS customer_count FROM cm JOIN fc ON cm.customer_id = fc.customer_id GROUP BY 1, 2),
sz AS (SELECT cohort_month, customer_count AS cohort_size FROM cc WHERE periods_since_cohort = 0
       ORDER BY cohort_month LIMIT 15),
ret AS (SELECT cc.cohort_month, cc.periods_since_cohort, cc.customer_count, sz.cohort_size,
               cc.customer_count * 100.0 / sz.cohort_size AS retention_pct
        FROM cc JOIN sz ON cc.cohort_month = sz.cohort_month WHERE cc.periods_since_cohort BETWEEN 0 AND 11)"""


@register("cohort_month", with_(COHORT) + "SELECT customer_id, cohort_month FROM fc")
def q_cohort_month(spark, sf):
    return cohort.cohort_month(_tx(spark, sf))


@register("cohort_counts", with_(COHORT) + "SELECT * FROM cc")
def q_cohort_counts(spark, sf):
    return cohort.cohort_counts(_tx(spark, sf))


@register("cohort_retention", with_(COHORT) + f"""
SELECT cohort_month, periods_since_cohort, customer_count, cohort_size, {R('retention_pct')} AS retention_pct
FROM ret""")
def q_retention(spark, sf):
    return cohort.cohort_retention(cohort.cohort_counts(_tx(spark, sf)))


@register("retention_matrix", with_(COHORT) + "SELECT cohort_month, " + ", ".join(
    f"""{R(f'max(CASE WHEN periods_since_cohort = {i} THEN retention_pct END)')} AS "{i}\"""" for i in range(12))
    + " FROM ret GROUP BY cohort_month")
def q_retention_matrix(spark, sf):
    return cohort.retention_matrix(cohort.cohort_retention(cohort.cohort_counts(_tx(spark, sf))))


@register("age_outlier_rows", with_() + """
, q AS (SELECT quantile_cont(age, 0.25) AS q1, quantile_cont(age, 0.75) AS q3 FROM cust)
SELECT customer_id, age FROM cust, q WHERE age < q1 - 0.4 * (q3 - q1) OR age > q3 + 0.4 * (q3 - q1)""")
def q_age_outlier_rows(spark, sf):
    return customers.age_outlier_rows(ad.customers(spark, sf), k=0.4)


@register("avg_retention_m1_m3", with_(COHORT) + f"""
SELECT {R('avg(CASE WHEN periods_since_cohort = 1 THEN retention_pct END)')} AS avg_month1_retention,
       {R('avg(CASE WHEN periods_since_cohort = 3 THEN retention_pct END)')} AS avg_month3_retention FROM ret""")
def q_avg_retention(spark, sf):
    return cohort.avg_retention(cohort.cohort_retention(cohort.cohort_counts(_tx(spark, sf))))


@register("cohort_join", with_(COHORT) + """
SELECT t.*, fc.cohort_month FROM tx t LEFT JOIN fc ON t.customer_id = fc.customer_id""")
def q_cohort_join(spark, sf):
    tx = _tx(spark, sf)
    return tx.join(cohort.cohort_month(tx), "customer_id", "left")


# ---------------------------------------------------------------- scalar functions

@register("scalar_date_parts", with_() + """
SELECT DISTINCT t_dat, CAST(year(t_dat) AS INTEGER) AS year, CAST(month(t_dat) AS INTEGER) AS month,
       CAST(day(t_dat) AS INTEGER) AS day, CAST(dayofweek(t_dat) + 1 AS INTEGER) AS day_of_week_sun1,
       CAST(isodow(t_dat) - 1 AS INTEGER) AS day_of_week_mon0, CAST(weekofyear(t_dat) AS INTEGER) AS iso_week,
       strftime(t_dat, '%a') AS day_name, strftime(t_dat, '%b') AS month_name FROM tx""")
def q_date_parts(spark, sf):
    return _tx(spark, sf).select("t_dat", *fd.date_parts("t_dat")).distinct()


@register("scalar_year_month_code", with_() + """
SELECT DISTINCT t_dat, CAST(year(t_dat) * 100 + month(t_dat) AS INTEGER) AS ym_code,
       CAST((year(t_dat) * 100 + month(t_dat)) // 100 AS INTEGER) AS code_year,
       CAST((year(t_dat) * 100 + month(t_dat)) % 100 AS INTEGER) AS code_month,
       CAST(((year(t_dat) * 100 + month(t_dat)) // 100 - 1995) * 12 + ((year(t_dat) * 100 + month(t_dat)) % 100 - 1)
            AS INTEGER) AS months_since_199501,
       CAST(year(t_dat) AS VARCHAR) || '-' || lpad(CAST(month(t_dat) AS VARCHAR), 2, '0') AS year_month,
       CAST(date_add(t_dat, INTERVAL 90 DAY) AS DATE) AS plus_90_days FROM tx""")
def q_ym_code(spark, sf):
    code = fd.year_month_code("t_dat")
    return _tx(spark, sf).select(
        "t_dat", code.alias("ym_code"), fd.code_year(code).alias("code_year"), fd.code_month(code).alias("code_month"),
        fd.months_between_codes(code, F.lit(199501)).alias("months_since_199501"),
        fd.year_month_label(F.year("t_dat"), F.month("t_dat")).alias("year_month"),
        F.date_add("t_dat", 90).alias("plus_90_days")).distinct()


@register("scalar_null_fill", with_() + f"""
SELECT customer_id, coalesce(age, -1.0) AS age_filled, coalesce(club_member_status, 'UNKNOWN') AS status_filled,
       CASE WHEN age > 60 THEN 60.0 ELSE age END AS age_capped_60,
       age IS NULL AS age_missing, {R('round(coalesce(age, 0) / 7.0 * 100.0) / 100.0')} AS age_weeks_r2,
       CASE WHEN postal_code = '1' THEN 'Store' WHEN postal_code = '2' THEN 'Online' END AS code_label
FROM cust""")
def q_null_fill(spark, sf):
    c = ad.customers(spark, sf)
    return c.select(
        "customer_id", fs.null_fill("age", -1.0).alias("age_filled"),
        fs.null_fill("club_member_status", "UNKNOWN").alias("status_filled"),
        fs.clip_upper("age", 60.0).alias("age_capped_60"), F.col("age").isNull().alias("age_missing"),
        fs.round_to(fs.null_fill("age", 0) / 7.0, 2).alias("age_weeks_r2"),
        fs.label_map(F.col("postal_code").cast("int"), fs.CHANNEL_LABELS).alias("code_label"))


@register("daily_activity_events", """
SELECT CAST(ts AS DATE) AS t_dat, count(*) AS transaction_count, count(DISTINCT user_id) AS unique_customers,
       round((count(*) / count(DISTINCT user_id)) * 1e6) / 1e6 AS trans_per_customer
FROM events GROUP BY 1""")
def q_daily_events(spark, sf):
    """The same daily roll-up over the second series (events)."""
    return temporal.daily_activity(ad.events_daily_source(spark, sf))
