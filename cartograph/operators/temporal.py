"""Time-series analytics on the daily / monthly roll-ups.

The roll-ups have one row per calendar day or month, so their windows
(rolling means, peaks) run on at most a few thousand rows — bounded by the
calendar, not by the data volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.dates import as_date, year_month_label
from cartograph.functions.joins import broadcast_bounded, materialize
from cartograph.functions.scalars import pct, safe_ratio
from cartograph.operators.features import purchase_gaps
from cartograph.operators.transactions import transaction_summary

# The repurchase thresholds reported, in days.
WITHIN_DAYS = [7, 14, 30, 60, 90]


def daily_activity(tx: DataFrame, date_col: str = "t_dat", customer_col: str = "customer_id",
                   approx_distinct: bool = False) -> DataFrame:
    """Per day: item rows, distinct customers (exact, or HLL++ if ``approx_distinct``), rows per customer."""
    uc = F.approx_count_distinct(customer_col) if approx_distinct else F.count_distinct(customer_col)
    d = tx.groupBy(date_col).agg(F.count(F.lit(1)).alias("transaction_count"), uc.alias("unique_customers"))
    return d.withColumn("trans_per_customer", F.col("transaction_count") / F.col("unique_customers"))


def rolling_mean(daily: DataFrame, measures: Sequence[str], rows: int = 7, date_col: str = "t_dat",
                 suffix: str = "_ma7") -> DataFrame:
    """Mean over the last ``rows`` rows (not calendar days); null until the window is full."""
    w = Window.orderBy(date_col).rowsBetween(-(rows - 1), 0)
    out = daily
    for m in measures:
        out = out.withColumn(m + suffix, F.when(F.count(F.lit(1)).over(w) == rows, F.avg(m).over(w)))
    return out


def daily_summary(daily: DataFrame) -> DataFrame:
    return daily.agg(F.avg("transaction_count").alias("mean_daily_transactions"),
                     F.max("transaction_count").alias("max_daily_transactions"),
                     F.min("transaction_count").alias("min_daily_transactions"),
                     F.avg("unique_customers").alias("mean_daily_customers"))


def monthly_rollup(daily: DataFrame, date_col: str = "t_dat") -> DataFrame:
    """Sums of the daily measures per year-month (daily unique customers are *summed*)."""
    m = daily.groupBy(F.year(date_col).alias("year"), F.month(date_col).alias("month")).agg(
        F.sum("transaction_count").alias("transaction_count"),
        F.sum("unique_customers").alias("unique_customers_summed"))
    return m.withColumn("year_month", year_month_label("year", "month")).withColumn(
        "month_name", F.date_format(F.make_date("year", "month", F.lit(1)), "MMM"))


def dow_pattern(daily: DataFrame, date_col: str = "t_dat") -> DataFrame:
    """Mean daily rows and customers per weekday, with busiest / slowest flags (7 rows)."""
    g = daily.groupBy(F.date_format(date_col, "E").alias("day_name"),
                      F.weekday(date_col).alias("day_index")).agg(
        F.avg("transaction_count").alias("avg_transactions"),
        F.avg("unique_customers").alias("avg_customers"))
    w = Window.partitionBy()
    return g.select("day_name", "day_index", "avg_transactions", "avg_customers",
                    (F.col("avg_transactions") == F.max("avg_transactions").over(w)).cast("int").alias("is_busiest"),
                    (F.col("avg_transactions") == F.min("avg_transactions").over(w)).cast("int").alias("is_slowest"))


def monthly_seasonality(tx: DataFrame, date_col: str = "t_dat", customer_col: str = "customer_id") -> DataFrame:
    """Per (year, month): item rows and customers counted distinct within the month."""
    return tx.groupBy(F.year(date_col).alias("year"), F.month(date_col).alias("month")).agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_distinct(customer_col).alias("unique_customers")).withColumn(
        "month_name", F.date_format(F.make_date("year", "month", F.lit(1)), "MMM"))


def month_of_year_average(seasonality: DataFrame) -> DataFrame:
    """Mean across years per calendar month, with peak / low flags (12 rows)."""
    g = seasonality.groupBy("month").agg(F.avg("transaction_count").alias("avg_transactions"),
                                         F.avg("unique_customers").alias("avg_customers"))
    w = Window.partitionBy()
    return g.select("month", F.date_format(F.make_date(F.lit(2000), "month", F.lit(1)), "MMM").alias("month_name"),
                    "avg_transactions", "avg_customers",
                    (F.col("avg_transactions") == F.max("avg_transactions").over(w)).cast("int").alias("is_peak"),
                    (F.col("avg_transactions") == F.min("avg_transactions").over(w)).cast("int").alias("is_low"))


def interval_stats(tx: DataFrame) -> DataFrame:
    """min / max / mean / sample std of all repurchase gaps (distinct days per customer)."""
    g = purchase_gaps(tx)
    return g.agg(F.min("days_between").alias("min_days"), F.max("days_between").alias("max_days"),
                 F.avg("days_between").alias("avg_days"), F.stddev_samp("days_between").alias("std_days"))


def interval_within_days(tx: DataFrame, thresholds: Sequence[int] = WITHIN_DAYS) -> DataFrame:
    """Share of gaps ≤ d for each threshold, plus the exact (interpolated) median gap.

    The median's buffer holds one entry per distinct gap length (≤ days in the
    calendar), so it stays small at any volume.
    """
    g = purchase_gaps(tx)
    aggs = [(F.avg((F.col("days_between") <= d).cast("double")) * 100.0).alias(f"pct_within_{d}")
            for d in thresholds]
    return g.agg(F.count(F.lit(1)).alias("gaps"), *aggs, F.median("days_between").alias("median_days"))


def final_week_summary(tx: DataFrame, start: str, end: str, date_col: str = "t_dat") -> DataFrame:
    """``transaction_summary`` of the rows from ``start`` to ``end``, both included."""
    return transaction_summary(tx.filter(F.col(date_col).between(as_date(start), as_date(end))))


def final_week_vs_history(tx: DataFrame, start: str, end: str, history_before: str,
                          days: int = 7, date_col: str = "t_dat") -> DataFrame:
    """Final-window daily average vs the historical daily average, % difference."""
    hist = (tx.filter(F.col(date_col) < as_date(history_before)).groupBy(date_col)
              .agg(F.count(F.lit(1)).alias("daily_count")).agg(F.avg("daily_count")).scalar())
    fw = tx.filter(F.col(date_col).between(as_date(start), as_date(end)))
    return fw.agg(F.count(F.lit(1)).alias("final_transactions")).select(
        "final_transactions", hist.alias("historical_daily_avg"),
        (F.col("final_transactions") / F.lit(float(days))).alias("final_daily_avg"),
        ((safe_ratio(F.col("final_transactions") / F.lit(float(days)), hist) - 1) * 100.0).alias("diff_pct"))


def popularity_coverage(tx: DataFrame, start: str, end: str, history_before: str, k: int = 12,
                        date_col: str = "t_dat") -> DataFrame:
    """% of final-window customers who bought any of the k most bought articles before it.

    The top-k list is data-derived but has at most k rows: it is the broadcast
    side of a left join, and the final window is read once.
    """
    top = (tx.filter(F.col(date_col) < as_date(history_before)).groupBy("article_id")
             .agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("article_id").asc())
             .limit(k).select("article_id"))
    top = materialize(top)  # k rows
    fw = tx.filter(F.col(date_col).between(as_date(start), as_date(end)))
    bought = fw.join(broadcast_bounded(top.withColumn("_top", F.lit(1))), "article_id", "left")
    per = bought.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.max(F.coalesce("_top", F.lit(0))).alias("hit"))
    return per.agg(F.count(F.lit(1)).alias("final_customers"), F.coalesce(F.sum("hit"), F.lit(0)).alias("customers_hit")).select(
        "final_customers", "customers_hit",
        pct("customers_hit", "final_customers").alias("coverage_pct"))
