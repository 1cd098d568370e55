"""Adapters that give the driver's TPC-H-style tables the retail schemas.

transactions = lineitem ⋈ orders (one row per item), customers = customer,
articles = part.  Nulls and orphan keys do not exist in the source tables, so
the customers adapter induces nulls by fixed rules that SQL can express
identically.  All adapters are lazy projections: Catalyst prunes the columns a
query does not use and pushes date predicates on ``t_dat`` through the join
into the ``orders`` scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture rules (FIXTURES.md, "customers adapter").
STATUS_BY_SEGMENT = {
    "AUTOMOBILE": "ACTIVE",
    "BUILDING": "ACTIVE",
    "HOUSEHOLD": "PRE-CREATE",
    "FURNITURE": "LEFT CLUB",
}  # MACHINERY (and anything else) -> null
NEWS_BY_NATION_MOD4 = {1: "NONE", 2: "Regularly", 3: "Monthly"}  # 0 -> null

# Fixture dates (FIXTURES.md, "Dates for the fixtures").
CUTOFF = "2001-05-03"
HORIZON_DAYS = 90
FINAL_WEEK_START = "2001-07-26"
FINAL_WEEK_END = "2001-08-01"
HISTORY_BEFORE = "2001-07-25"
SPLIT_TRAIN_END = "2001-07-18"
SPLIT_VAL_END = "2001-07-25"
ROLLING_CUTOFFS = ["2001-02-01", "2001-03-01", "2001-04-01", "2001-05-01"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case_map(key: Column, mapping: dict) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = F.when(key == F.lit(k), F.lit(v)) if expr is None else expr.when(key == F.lit(k), F.lit(v))
    return expr


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item rows: t_dat, customer_id, article_id, price, sales_channel_id."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner").select(
        F.to_date("o_orderdate").alias("t_dat"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("article_id"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linestatus") == "O", F.lit(2)).otherwise(F.lit(1)).cast("int")
        .alias("sales_channel_id"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.when(F.col("c_custkey") % 3 == 0, F.lit(1.0)).cast("double").alias("FN"),
        F.when(F.col("c_custkey") % 4 == 0, F.lit(1.0)).cast("double").alias("Active"),
        _case_map(F.col("c_mktsegment"), STATUS_BY_SEGMENT).alias("club_member_status"),
        _case_map(F.col("c_nationkey") % 4, NEWS_BY_NATION_MOD4).alias("fashion_news_frequency"),
        F.when(F.col("c_acctbal") < 0, F.lit(None))
        .otherwise(F.lit(16) + F.col("c_custkey") % 85).cast("double").alias("age"),
        F.col("c_nationkey").cast("string").alias("postal_code"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("article_id"),
        F.col("p_name").alias("prod_name"),
        F.col("p_brand").alias("product_type_name"),
        F.col("p_type").alias("product_group_name"),
        F.substring_index(F.col("p_name"), " ", 1).alias("colour_group_name"),
        F.expr("p_size div 10").cast("string").alias("garment_group_name"),
    )


def reference_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer side for orphan checks: every tenth key is missing (fixture rule)."""
    return customers(spark, sf_dir).filter(F.col("customer_id") % 10 != 0)


def reference_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article side for orphan checks: every 25th key is missing (fixture rule)."""
    return articles(spark, sf_dir).filter(F.col("article_id") % 25 != 0)


def events_daily_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`events` as a second item-row series (t_dat, customer_id, article_id, price, channel)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.to_date("ts").alias("t_dat"),
        F.col("user_id").alias("customer_id"),
        F.hash("event_type").cast("long").alias("article_id"),
        F.col("value").alias("price"),
        F.lit(1).alias("sales_channel_id"),
    )
