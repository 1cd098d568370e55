"""Monthly acquisition cohorts and retention.

Plan: (customer, year-month) distinct rows first (partial aggregation, so a
hot customer is reduced to ≤ one row per month before any shuffle), then each
customer's first month by a window over those few rows, then distinct
customers per (cohort, period) — a count of rows, since the input is already
distinct per customer and month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.dates import months_between_codes, year_month_code


def customer_months(tx: DataFrame, customer_col: str = "customer_id", date_col: str = "t_dat") -> DataFrame:
    return tx.select(customer_col, year_month_code(date_col).alias("purchase_year_month")).distinct()


def cohort_month(tx: DataFrame, customer_col: str = "customer_id", date_col: str = "t_dat") -> DataFrame:
    """First purchase year-month (yyyymm) per customer."""
    return customer_months(tx, customer_col, date_col).groupBy(customer_col).agg(
        F.min("purchase_year_month").alias("cohort_month"))


def cohort_counts(tx: DataFrame, customer_col: str = "customer_id", date_col: str = "t_dat") -> DataFrame:
    """Distinct customers per (cohort month, months since cohort)."""
    cm = customer_months(tx, customer_col, date_col)
    w = Window.partitionBy(customer_col)
    cm = cm.withColumn("cohort_month", F.min("purchase_year_month").over(w))
    cm = cm.withColumn("periods_since_cohort", months_between_codes("purchase_year_month", "cohort_month"))
    return cm.groupBy("cohort_month", "periods_since_cohort").agg(F.count(F.lit(1)).alias("customer_count"))


def cohort_retention(counts: DataFrame, max_period: int | None = 11, n_cohorts: int | None = 15) -> DataFrame:
    """% of the period-0 size for periods 0..max_period, first ``n_cohorts`` cohorts; None: all.

    ``counts`` has one row per (cohort month, period): bounded by the calendar.
    """
    c = counts if max_period is None else counts.filter(F.col("periods_since_cohort").between(0, max_period))
    size = c.filter(F.col("periods_since_cohort") == 0).select(
        "cohort_month", F.col("customer_count").alias("cohort_size"))
    first = size if n_cohorts is None else size.withColumn(
        "_rk", F.dense_rank().over(Window.orderBy("cohort_month"))).filter(F.col("_rk") <= n_cohorts).drop("_rk")
    return c.join(F.broadcast(first), "cohort_month").select(
        "cohort_month", "periods_since_cohort", "customer_count", "cohort_size",
        (F.col("customer_count") * 100.0 / F.col("cohort_size")).alias("retention_pct"))


def retention_matrix(retention: DataFrame, max_period: int = 11) -> DataFrame:
    """Wide form: one row per cohort, one column per period (missing cells null)."""
    return (retention.groupBy("cohort_month").pivot("periods_since_cohort", list(range(max_period + 1)))
                     .agg(F.first("retention_pct")))


def avg_retention(retention: DataFrame, periods=(1, 3)) -> DataFrame:
    """Mean retention over cohorts at the given periods; missing cells are skipped."""
    return retention.agg(*[
        F.avg(F.when(F.col("periods_since_cohort") == p, F.col("retention_pct"))).alias(f"avg_month{p}_retention")
        for p in periods])
