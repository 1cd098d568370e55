"""Product analytics: popularity, catalogue cardinality, category revenue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.joins import broadcast_bounded, materialize
from cartograph.functions.scalars import money, money_sum, money_unscale, safe_ratio

DETAIL_COLUMNS = ["article_id", "prod_name", "product_type_name", "colour_group_name", "product_group_name"]


def article_popularity(tx: DataFrame, article_col: str = "article_id",
                       customer_col: str = "customer_id") -> DataFrame:
    """Item rows and distinct buyers per article (partial aggregation before the shuffle)."""
    return tx.groupBy(article_col).agg(F.count(F.lit(1)).alias("transaction_count"),
                                       F.count_distinct(customer_col).alias("unique_customers"))


def product_popularity(tx: DataFrame, articles: DataFrame, k: int = 20,
                       detail_columns: Sequence[str] = DETAIL_COLUMNS) -> DataFrame:
    """Top-k articles by item rows (ties by id) with details and purchases per buyer.

    The top-k side has at most k rows: broadcast, it first reduces the catalogue
    to those articles, without shuffling it; the k rows are then joined.
    """
    top = materialize(article_popularity(tx).orderBy(F.col("transaction_count").desc(), F.col("article_id").asc()).limit(k))
    details = articles.select(*detail_columns).join(broadcast_bounded(top.select("article_id")), "article_id", "left_semi")
    return top.join(details, "article_id", "left").select(
        "article_id", *[c for c in detail_columns if c != "article_id"], "transaction_count", "unique_customers",
        (F.col("transaction_count") / F.col("unique_customers")).alias("avg_purchases_per_customer"))


def catalog_cardinality(articles: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per attribute (long form)."""
    row = articles.agg(*[F.count_distinct(c).alias(f"_d{i}") for i, c in enumerate(columns)])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("attribute"), F.col(f"_d{i}").alias("distinct_values"))
        for i, c in enumerate(columns)])).alias("s")).select("s.*")


def category_revenue(tx: DataFrame, articles: DataFrame, group_col: str = "product_group_name",
                     money_scale: int | None = None) -> DataFrame:
    """Items, revenue, buyers and mean price per product group, by revenue desc.

    The fact table is first reduced to (article, customer) — partial
    aggregation before any join — then joined to the article attributes and
    rolled up to the group.  Distinct buyers per group is exact.
    """
    ac = tx.groupBy("article_id", "customer_id").agg(F.count(F.lit(1)).alias("n"),
                                                     F.count("price").alias("priced"),
                                                     F.sum(money("price", money_scale)).alias("spend"))
    j = ac.join(articles.select("article_id", group_col), "article_id", "left")
    out = j.groupBy(group_col).agg(
        F.sum("n").alias("transaction_count"),
        F.sum("priced").alias("priced"),
        money_unscale(F.sum("spend"), money_scale).alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"))
    return (out.withColumn("avg_price", safe_ratio("total_revenue", "priced")).drop("priced")
               .orderBy(F.col("total_revenue").desc(), F.col(group_col).asc_nulls_last()))


def category_share_top5_others(revenue: DataFrame, group_col: str = "product_group_name", k: int = 5,
                               money_scale: int | None = None) -> DataFrame:
    """Top-k groups by revenue plus one 'Others' bucket, with % of the total.

    ``revenue`` has one row per product group (a small attribute domain), so
    the ranking window spans that aggregated frame only.
    """
    w = Window.orderBy(F.col("total_revenue").desc(), F.col(group_col).asc_nulls_last())
    ranked = revenue.withColumn("_rk", F.row_number().over(w))
    bucket = F.when(F.col("_rk") <= k, F.col(group_col)).otherwise(F.lit("Others"))
    out = ranked.groupBy(bucket.alias("category")).agg(
        money_sum("total_revenue", money_scale).alias("revenue"))
    return out.withColumn("pct", F.col("revenue") * 100.0 / F.sum("revenue").over(Window.partitionBy()))


def top_articles(tx: DataFrame, k: int = 12, before: str | None = None, date_col: str = "t_dat") -> DataFrame:
    """Top-k articles by item rows, optionally before a date (ties by id)."""
    src = tx if before is None else tx.filter(F.col(date_col) < F.lit(before).cast("date"))
    return (src.groupBy("article_id").agg(F.count(F.lit(1)).alias("train_count"))
               .orderBy(F.col("train_count").desc(), F.col("article_id").asc()).limit(k))
