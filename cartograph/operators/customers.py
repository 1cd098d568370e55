"""Customer analytics: demographics, per-customer statistics, loyalty, concentration.

The reference computed most of these in pandas on samples; here they run on
the full tables.  Shares divide by a scalar-subquery total (not a global
window) unless the aggregated frame is bounded by a small code domain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.joins import materialize
from cartograph.functions.ranking import global_row_number
from cartograph.functions.scalars import bin_label, money_avg, money_sum, money_unscale, pct, round_to, safe_ratio
from cartograph.operators.partials import ARTICLE, DAY, partial_sums

# Bins and labels of the two age binnings, loyalty tier bounds.
AGE_EDGES_LEFT_CLOSED = [0, 18, 25, 35, 45, 55, 65, 100]
AGE_LABELS_LEFT_CLOSED = ["<18", "18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
AGE_EDGES_RIGHT_CLOSED = [0, 25, 35, 45, 55, 65, 100]
AGE_LABELS_CROSSTAB = ["18-24", "25-34", "35-44", "45-54", "55-64", "65+"]
AGE_LABELS_BEHAVIOR = ["<25", "25-34", "35-44", "45-54", "55-64", "65+"]
ENGAGED_NEWS = ["Regularly", "Monthly"]


def share_of_total(df: DataFrame, measure: str, name: str = "pct") -> DataFrame:
    """measure × 100 / sum(measure), the total as a scalar subquery."""
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(name, F.col(measure) * 100.0 / total)


def value_counts_share(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Counts per value including null, with % of all rows."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    out = share_of_total(counts, "count")
    return out.select(F.lit(name or column).alias("attribute"), F.col(column).cast("string").alias("value"),
                      "count", "pct")


def engagement_metrics(customers: DataFrame, status_col: str = "club_member_status",
                       news_col: str = "fashion_news_frequency") -> DataFrame:
    n = F.count(F.lit(1))
    active = F.count_if(F.col(status_col) == "ACTIVE")
    engaged = F.count_if(F.col(news_col).isin(ENGAGED_NEWS))
    return customers.agg(n.alias("customers"), active.alias("active_members"),
                         pct(active, n).alias("active_pct"),
                         engaged.alias("news_subscribers"), pct(engaged, n).alias("news_pct"))


def age_describe(customers: DataFrame, age_col: str = "age") -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max."""
    a = F.col(age_col)
    q = F.percentile(a, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    return customers.agg(F.count(a).alias("count"), F.avg(a).alias("mean"), F.stddev_samp(a).alias("std"),
                         F.min(a).alias("min"), q.alias("_q"), F.max(a).alias("max")).select(
        "count", "mean", "std", "min", F.col("_q")[0].alias("p25"), F.col("_q")[1].alias("p50"),
        F.col("_q")[2].alias("p75"), "max")


def age_percentiles(customers: DataFrame, age_col: str = "age", ps: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    q = F.percentile(F.col(age_col), F.array(*[F.lit(p) for p in ps]))
    row = customers.agg(q.alias("_q"))
    return row.select(*[F.col("_q")[i].alias(f"p{int(round(p * 100))}") for i, p in enumerate(ps)])


def age_outliers_iqr(customers: DataFrame, age_col: str = "age", k: float = 1.5) -> DataFrame:
    """Tukey fences from exact quartiles; one summary row with the outlier count."""
    a = F.col(age_col)
    qs = customers.agg(F.percentile(a, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    q1 = qs.select(F.col("_q")[0]).scalar()
    q3 = qs.select(F.col("_q")[1]).scalar()
    lo = q1 - F.lit(k) * (q3 - q1)
    hi = q3 + F.lit(k) * (q3 - q1)
    return customers.filter(a.isNotNull()).agg(
        q1.alias("q1"), q3.alias("q3"), (q3 - q1).alias("iqr"), lo.alias("lower_bound"),
        hi.alias("upper_bound"), F.count_if((a < lo) | (a > hi)).alias("outliers"))


def age_outlier_rows(customers: DataFrame, age_col: str = "age", k: float = 1.5,
                     key: str = "customer_id") -> DataFrame:
    a = F.col(age_col)
    qs = customers.agg(F.percentile(a, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    q1 = qs.select(F.col("_q")[0]).scalar()
    q3 = qs.select(F.col("_q")[1]).scalar()
    return customers.filter((a < q1 - F.lit(k) * (q3 - q1)) | (a > q3 + F.lit(k) * (q3 - q1))).select(key, age_col)


def age_group_distribution(customers: DataFrame, age_col: str = "age", edges=AGE_EDGES_LEFT_CLOSED,
                           labels=AGE_LABELS_LEFT_CLOSED, right: bool = False) -> DataFrame:
    """Counts per age bin and % of customers with a known age."""
    with_age = customers.filter(F.col(age_col).isNotNull())
    total = with_age.agg(F.count(F.lit(1))).scalar()
    binned = with_age.select(bin_label(age_col, edges, labels, right).alias("age_group"))
    return (binned.filter(F.col("age_group").isNotNull()).groupBy("age_group")
                  .agg(F.count(F.lit(1)).alias("customers"))
                  .withColumn("pct", F.col("customers") * 100.0 / total))


def crosstab_share(customers: DataFrame, age_col: str = "age", status_col: str = "club_member_status") -> DataFrame:
    """Age group (right-closed) × status, row-normalised % (long form)."""
    df = customers.filter(F.col(age_col).isNotNull() & F.col(status_col).isNotNull()).select(
        bin_label(age_col, AGE_EDGES_RIGHT_CLOSED, AGE_LABELS_CROSSTAB, right=True).alias("age_group"),
        F.col(status_col))
    cells = df.filter(F.col("age_group").isNotNull()).groupBy("age_group", status_col).agg(
        F.count(F.lit(1)).alias("customers"))
    # row totals: one row per age group (6 rows), joined back by key
    rows = cells.groupBy("age_group").agg(F.sum("customers").alias("_row_total"))
    return cells.join(F.broadcast(rows), "age_group").select(
        "age_group", status_col, "customers", (F.col("customers") * 100.0 / F.col("_row_total")).alias("row_pct"))


def customer_stats(tx: DataFrame, customer_col: str = "customer_id", date_col: str = "t_dat",
                   article_col: str = "article_id", price_col: str = "price",
                   money_scale: int | None = None) -> DataFrame:
    """Seven measures per customer over the whole history, from one scan; a null customer has no row.

    Rows without a date count as items, and as one more shopping day.
    """
    facts = tx.where(F.col(customer_col).isNotNull()).select(
        F.col(customer_col).alias("customer_id"), F.col(date_col).alias("t_dat"), F.col(article_col).alias("article_id"),
        F.col(price_col).alias("price"), F.lit(None).cast("int").alias("sales_channel_id"))
    day = F.col("kind") == DAY
    per = partial_sums(facts, money_scale, undated=True).groupBy(F.col("customer_id").alias(customer_col)).agg(
        F.sum(F.when(day, F.col("items"))).alias("total_purchases"),
        money_unscale(F.sum(F.when(day, F.col("spend"))), money_scale).alias("total_spend"),
        F.sum(F.when(day, F.col("priced"))).alias("n_priced"),
        F.min("t_dat").alias("first_purchase_date"), F.max("t_dat").alias("last_purchase_date"),
        F.count_if(day).alias("shopping_days"), F.count_if(F.col("kind") == ARTICLE).alias("unique_products_bought"))
    return per.select(
        customer_col, "total_purchases", "unique_products_bought", "total_spend",
        safe_ratio("total_spend", "n_priced").alias("avg_order_value"),
        "first_purchase_date", "last_purchase_date", "shopping_days")


def customer_stats_summary(stats: DataFrame, money_scale: int | None = None) -> DataFrame:
    return stats.agg(
        F.min("total_purchases").alias("min_purchases"), F.max("total_purchases").alias("max_purchases"),
        F.avg("total_purchases").alias("avg_purchases"), F.min("total_spend").alias("min_spend"),
        F.max("total_spend").alias("max_spend"), money_avg("total_spend", money_scale).alias("avg_spend"))


def loyalty_tier(purchases_col: str = "total_purchases"):
    p = F.col(purchases_col)
    return (F.when(p == 1, "one-time").when(p < 10, "occasional (2-9)")
             .when(p < 50, "loyal (10-49)").otherwise("vip (50+)"))


def loyalty_tiers(stats: DataFrame) -> DataFrame:
    """Counts and shares of the four tiers in one grouping (tiers are a 4-value domain)."""
    counts = stats.groupBy(loyalty_tier().alias("tier")).agg(F.count(F.lit(1)).alias("customers"))
    return counts.withColumn("pct", F.col("customers") * 100.0 / F.sum("customers").over(Window.partitionBy()))


def top_customers(stats: DataFrame, measure: str, k: int = 10, key: str = "customer_id") -> DataFrame:
    """Top-k by a measure, ties broken by key (TakeOrderedAndProject)."""
    return stats.orderBy(F.col(measure).desc(), F.col(key).asc()).limit(k)


def pareto_share(stats: DataFrame, fractions: Sequence[float] = (0.1, 0.2), measure: str = "total_spend",
                 key: str = "customer_id", money_scale: int | None = None) -> DataFrame:
    """Revenue of the top ⌊n·p⌋ customers by spend, for each fraction p.

    The global rank comes from ``global_row_number`` (range shuffle + partition
    offsets), so no single task sorts all customers.
    """
    stats = materialize(stats.select(key, measure))  # read by the rank, the count and the sums
    ranked = global_row_number(stats, [F.col(measure).desc(), F.col(key).asc()], "rank")
    n = stats.agg(F.count(F.lit(1))).scalar()
    aggs = [money_sum(measure, money_scale).alias("total_revenue"), F.count(F.lit(1)).alias("customers")]
    for p in fractions:
        k = F.floor(n * F.lit(p))
        aggs.append(money_sum(F.when(F.col("rank") <= k, F.col(measure)), money_scale).alias(f"top_{p}"))
    row = ranked.agg(*aggs)
    parts = []
    for p in fractions:
        parts.append(row.select(
            F.lit(p).alias("top_fraction"), F.floor(F.col("customers") * F.lit(p)).cast("long").alias("top_customers"),
            F.coalesce(F.col(f"`top_{p}`"), F.lit(0.0)).alias("top_revenue"), "total_revenue",
            (F.coalesce(F.col(f"`top_{p}`"), F.lit(0.0)) * 100.0 / F.col("total_revenue")).alias("revenue_share_pct")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def top_n_pct(stats: DataFrame, p: float = 0.1, measure: str = "total_spend",
              key: str = "customer_id") -> DataFrame:
    """The top ⌊n·p⌋ customers themselves, with their global rank."""
    stats = materialize(stats)
    ranked = global_row_number(stats, [F.col(measure).desc(), F.col(key).asc()], "rank")
    n = stats.agg(F.count(F.lit(1))).scalar()
    return ranked.filter(F.col("rank") <= F.floor(n * F.lit(p)))


def behavior_join(stats: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Customer stats ⋈ demographics, customers with age and status only."""
    demo = customers.select(key, "age", "club_member_status", "fashion_news_frequency")
    return stats.join(demo, key, "inner").filter(
        F.col("age").isNotNull() & F.col("club_member_status").isNotNull())


def group_means(behavior: DataFrame, group_col, measures: Sequence[str], digits: int | None = 2,
                money_cols: Sequence[str] = (), money_scale: int | None = None) -> DataFrame:
    aggs = []
    for m in measures:
        v = money_avg(m, money_scale) if m in money_cols else F.avg(m)
        aggs.append((round_to(v, digits) if digits is not None else v).alias(m))
    return behavior.groupBy(group_col).agg(*aggs)


def club_behavior(behavior: DataFrame, money_scale: int | None = None) -> DataFrame:
    return group_means(behavior, "club_member_status",
                       ["total_purchases", "total_spend", "unique_products_bought", "shopping_days"],
                       money_cols=["total_spend"], money_scale=money_scale)


def news_behavior(behavior: DataFrame, money_scale: int | None = None) -> DataFrame:
    return group_means(behavior, "fashion_news_frequency", ["total_purchases", "total_spend"],
                       money_cols=["total_spend"], money_scale=money_scale).orderBy("total_purchases")


def age_band_behavior(behavior: DataFrame, money_scale: int | None = None) -> DataFrame:
    banded = behavior.withColumn(
        "age_band", bin_label("age", AGE_EDGES_RIGHT_CLOSED, AGE_LABELS_BEHAVIOR, right=True))
    return group_means(banded.filter(F.col("age_band").isNotNull()), "age_band",
                       ["total_purchases", "total_spend"], digits=None,
                       money_cols=["total_spend"], money_scale=money_scale)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair (long form), all pairs in one aggregate."""
    aggs = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            if j >= i:
                aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c_{i}_{j}"))
    row = df.agg(*aggs)
    parts = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            src = f"c_{min(i, j)}_{max(i, j)}"
            parts.append(F.struct(F.lit(a).alias("var_x"), F.lit(b).alias("var_y"), F.col(src).alias("corr")))
    return row.select(F.explode(F.array(*parts)).alias("c")).select("c.*")
