"""Transaction-level analytics: summaries, channels, distributions, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.ranking import global_running_sum
from cartograph.functions.scalars import channel_name, clip_upper, money, money_avg, money_stddev, money_unscale, safe_ratio


def _distinct(c: str, approx: bool):
    """Exact distinct count, or the HyperLogLog++ estimate (rsd 5 %) when ``approx``."""
    return F.approx_count_distinct(c) if approx else F.count_distinct(c)


def transaction_summary(tx: DataFrame, approx_distinct: bool = False) -> DataFrame:
    """Rows, distinct customers and distinct articles (nulls not counted), in one row; zeros for an empty table.

    Exact counts come from two levels: the rows are combined by (customer, article)
    in each task, shuffled once, and both counts are taken from those pairs, so no
    row of the facts is repeated for each measure.
    """
    if approx_distinct:
        return tx.agg(F.count(F.lit(1)).alias("total_transactions"),
                      _distinct("customer_id", True).alias("unique_customers"),
                      _distinct("article_id", True).alias("unique_products"))
    pairs = tx.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("items"))

    def distinct(key: str, name: str, other: str) -> DataFrame:
        # Both sides sum the items, so that they need the same columns and share the shuffle of the pairs.
        return (pairs.groupBy(key).agg(F.sum("items").alias("items"))
                .agg(F.sum("items").alias("items"), F.count(key).alias(name)).withColumn(other, F.lit(0).cast("long")))

    sides = distinct("customer_id", "unique_customers", "unique_products").unionByName(
        distinct("article_id", "unique_products", "unique_customers"))
    return sides.agg(F.coalesce(F.max("items"), F.lit(0)).alias("total_transactions"),
                     F.max("unique_customers").alias("unique_customers"),
                     F.max("unique_products").alias("unique_products"))


def price_stats(tx: DataFrame, price_col: str = "price", money_scale: int | None = None) -> DataFrame:
    p = F.col(price_col)
    return tx.agg(F.min(p).alias("min_price"), F.max(p).alias("max_price"),
                  money_avg(price_col, money_scale).alias("avg_price"),
                  money_stddev(price_col, money_scale).alias("std_price"))


def channel_breakdown(tx: DataFrame, channel_col: str = "sales_channel_id") -> DataFrame:
    """Rows per channel with share and label (two-row frame; the window is tiny)."""
    c = tx.groupBy(channel_col).agg(F.count(F.lit(1)).alias("count"))
    return c.select(channel_col, channel_name(channel_col).alias("channel_name"), "count",
                    (F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())).alias("pct"))


def channel_analysis(tx: DataFrame, channel_col: str = "sales_channel_id",
                     money_scale: int | None = None, approx_distinct: bool = False) -> DataFrame:
    """Rows, distinct customers and articles, and mean price of each channel; null is a channel.

    Exact counts come from two levels, as in ``transaction_summary``: the rows are
    combined by (channel, customer, article) and shuffled once; customers and
    articles are counted among those rows.
    """
    if approx_distinct:
        out = tx.groupBy(channel_col).agg(
            F.count(F.lit(1)).alias("transaction_count"), _distinct("customer_id", True).alias("unique_customers"),
            _distinct("article_id", True).alias("unique_products"), money_avg("price", money_scale).alias("avg_price"))
        return out.withColumn("channel_name", channel_name(channel_col))
    triples = tx.groupBy(F.col(channel_col).alias("channel"), "customer_id", "article_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum(money("price", money_scale)).alias("spend"), F.count("price").alias("priced"))

    def distinct(key: str, name: str, other: str) -> DataFrame:
        # Both sides have the same columns, so that they share the shuffle of the triples.
        sums = [F.sum(c).alias(c) for c in ("items", "spend", "priced")]
        return (triples.groupBy("channel", key).agg(*sums)
                .groupBy("channel").agg(*sums, F.count(key).alias(name)).withColumn(other, F.lit(0).cast("long")))

    sides = distinct("customer_id", "unique_customers", "unique_products").unionByName(
        distinct("article_id", "unique_products", "unique_customers"))
    out = sides.groupBy(F.col("channel").alias(channel_col)).agg(
        F.max("items").alias("transaction_count"), F.max("unique_customers").alias("unique_customers"),
        F.max("unique_products").alias("unique_products"), F.max("spend").alias("_spend"), F.max("priced").alias("_priced"))
    return out.select(channel_col, "transaction_count", "unique_customers", "unique_products",
                      safe_ratio(money_unscale(F.col("_spend"), money_scale), "_priced").alias("avg_price"),
                      channel_name(channel_col).alias("channel_name"))


def purchase_frequency_stats(tx: DataFrame, customer_col: str = "customer_id") -> DataFrame:
    per = tx.groupBy(customer_col).agg(F.count(F.lit(1)).alias("purchase_count"))
    return per.agg(F.min("purchase_count").alias("min_purchases"), F.max("purchase_count").alias("max_purchases"),
                   F.avg("purchase_count").alias("avg_purchases"))


def histogram(df: DataFrame, column: str, bins: int = 50, cap=None, lo=None, hi=None,
              by: str | None = None) -> DataFrame:
    """Fixed-width bin counts over [lo, hi] (data min/max by default); the top edge
    belongs to the last bin, as in numpy/matplotlib.  Optional cap first, optional
    grouping column (e.g. per channel)."""
    x = clip_upper(column, cap) if cap is not None else F.col(column)
    src = df.select(x.cast("double").alias("_x"), *([F.col(by)] if by else [])).filter(F.col("_x").isNotNull())
    ends = None if lo is not None and hi is not None else src.agg(F.struct(F.min("_x").alias("lo"), F.max("_x").alias("hi"))).scalar()
    lo_c = F.lit(float(lo)) if lo is not None else ends["lo"]
    hi_c = F.lit(float(hi)) if hi is not None else ends["hi"]
    width = (hi_c - lo_c) / F.lit(bins)
    raw = F.floor(safe_ratio(F.col("_x") - lo_c, width)).cast("int")
    b = F.when(width == 0, F.lit(0)).when(raw >= bins, F.lit(bins - 1)).otherwise(raw)
    keys = ([by] if by else []) + ["bin"]
    out = (src.filter((F.col("_x") >= lo_c) & (F.col("_x") <= hi_c)).withColumn("bin", b)
              .groupBy(*keys).agg(F.count(F.lit(1)).alias("count")))
    return out.select(*keys, (lo_c + F.col("bin") * width).alias("bin_start"),
                      (lo_c + (F.col("bin") + 1) * width).alias("bin_end"), "count")


def empirical_cdf(df: DataFrame, column: str, cap=None) -> DataFrame:
    """Per distinct value: count, cumulative count and cumulative % (sorted ascending).

    Distinct values are unbounded, so the running sum is distributed
    (``global_running_sum``) rather than a single-task window.
    """
    x = clip_upper(column, cap) if cap is not None else F.col(column)
    counts = df.select(x.alias("value")).filter(F.col("value").isNotNull()).groupBy("value").agg(
        F.count(F.lit(1)).alias("count"))
    run = global_running_sum(counts, [F.col("value").asc()], "count", "cumulative_count")
    total = run.agg(F.max("cumulative_count")).scalar()  # the last running sum: the counts are not taken again
    return run.withColumn("cumulative_pct", F.col("cumulative_count") * 100.0 / total)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Seeded Bernoulli sample (result depends on the input partitioning)."""
    return df.sample(fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, fraction: float, key_cols, seed: int = 42) -> DataFrame:
    """Deterministic sample: keep rows whose md5('<seed>:<key>') bucket falls below the fraction."""
    cols = [F.col(c).cast("string") for c in key_cols]
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *cols)), 1, 8), 16, 10).cast("long")
    return df.filter(F.pmod(h, F.lit(10000)) < F.lit(int(round(fraction * 10000))))
