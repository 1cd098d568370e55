"""Partial sums of the facts from which per-customer measures follow.

One scan of the facts gives two kinds of rows, in one aggregate that combines in
each task before it shuffles: a customer's days and a customer's articles.  A
customer has at most one row a day and one an article, so a hot one is small
before anything is dealt by customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.dates import is_weekend
from cartograph.functions.joins import materialize
from cartograph.functions.scalars import money, money_square
from cartograph.operators.features import ONLINE_CHANNEL, STORE_CHANNEL

DAY, ARTICLE = 0, 1


def partial_sums(tx: DataFrame, money_scale: int | None = None, undated: bool = False) -> DataFrame:
    """(customer_id, kind, t_dat, article_id, items, spend, priced, spend_squares, lowest, highest,
    store_items, online_items, first_day), as a plan: what a reader does not use is not computed.

    Rows of kind DAY have a day and its sums, rows of kind ARTICLE an article,
    its items and the day it was first bought.  ``spend`` and its squares are in
    minor units with ``money_scale``.  Rows without a date are left out, or with
    ``undated`` have a null day of their own; rows without an article make no
    ARTICLE row.
    """
    no_day, no_article = (F.lit(None).cast(tx.schema[c].dataType) for c in ("t_dat", "article_id"))
    kinds = F.array(
        F.struct(F.lit(DAY).alias("kind"), F.col("t_dat").alias("day"), no_article.alias("article")),
        F.struct(F.lit(ARTICLE).alias("kind"), no_day.alias("day"), F.col("article_id").alias("article")))
    tagged = ((tx if undated else tx.where(F.col("t_dat").isNotNull()))
              .select("customer_id", "t_dat", "price", "sales_channel_id", F.inline(kinds))
              .where((F.col("kind") == DAY) | F.col("article").isNotNull()))
    return tagged.groupBy("customer_id", "kind", "day", "article").agg(
        F.count(F.lit(1)).alias("items"),
        F.sum(money("price", money_scale)).alias("spend"),
        F.count("price").alias("priced"),
        F.sum(money_square("price", money_scale)).alias("spend_squares"),
        F.min("price").alias("lowest"), F.max("price").alias("highest"),
        F.count_if(F.col("sales_channel_id") == STORE_CHANNEL).alias("store_items"),
        F.count_if(F.col("sales_channel_id") == ONLINE_CHANNEL).alias("online_items"),
        F.min("t_dat").alias("first_day"),
    ).withColumnsRenamed({"day": "t_dat", "article": "article_id"})


PLAIN = ("customer_id", "kind", "t_dat", "article_id", "items", "spend", "priced", "online_items", "first_day")
WITH_PRICES = (*PLAIN, "spend_squares", "lowest", "highest", "store_items")


def customer_partials(tx: DataFrame, money_scale: int | None = None, columns: tuple = PLAIN) -> DataFrame:
    """``columns`` of ``partial_sums``, stored: for measures that read the days and the articles apart."""
    return materialize(partial_sums(tx, money_scale).select(*columns))


def days_of(partials: DataFrame) -> DataFrame:
    """One row for each shopping day of a customer, with its sums."""
    return partials.where(F.col("kind") == DAY).drop("kind", "article_id", "first_day")


def articles_of(partials: DataFrame) -> DataFrame:
    """(customer_id, article_id, items, first_day): one row for each article a customer bought."""
    return partials.where(F.col("kind") == ARTICLE).select("customer_id", "article_id", "items", "first_day")


def interval_summary(days: DataFrame, by: str) -> DataFrame:
    """One mergeable summary of a customer's days for each value of ``by``, which grows with the day.

    first_day, last_day, days, gaps, gap_sum and gap_squares describe the gaps
    within the group; two neighbouring groups merge by adding theirs and the gap
    between them.  Sums of items, spend, priced, online and weekend items add.
    """
    w = Window.partitionBy("customer_id", by).orderBy("t_dat")
    gap = F.date_diff("t_dat", F.lag("t_dat").over(w)).cast("long")
    weekend = F.when(is_weekend("t_dat"), F.col("items")).otherwise(0)
    return days.withColumn("gap", gap).groupBy("customer_id", by).agg(
        F.min("t_dat").alias("first_day"), F.max("t_dat").alias("last_day"), F.count(F.lit(1)).alias("days"),
        F.count("gap").alias("gaps"), F.coalesce(F.sum("gap"), F.lit(0)).alias("gap_sum"),
        F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).alias("gap_squares"),
        F.sum("items").alias("items"), F.sum("spend").alias("spend"), F.sum("priced").alias("priced"),
        F.sum("online_items").alias("online_items"), F.sum(weekend).alias("weekend_items"))


def merged_prefix(summary: DataFrame, by: str) -> DataFrame:
    """Each summary merged with all earlier ones of its customer, and ``next_day``, the first day of the next one.

    One window over at most one row for each value of ``by``; a group without a
    day has none.
    """
    w = Window.partitionBy("customer_id").orderBy(by)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    between = F.date_diff("first_day", F.lag("last_day").over(w)).cast("long")  # null for the first
    joined = summary.withColumn("between", between).withColumn("next_day", F.lead("first_day").over(w))

    def total(c):
        return F.sum(c).over(upto)

    return joined.select(
        "customer_id", by, F.min("first_day").over(upto).alias("first_day"), "last_day", "next_day",
        (total(F.col("gaps")) + F.count("between").over(upto)).alias("gaps"),
        (total(F.col("gap_sum")) + F.coalesce(total(F.col("between")), F.lit(0))).alias("gap_sum"),
        (total(F.col("gap_squares")) + F.coalesce(total(F.col("between") * F.col("between")), F.lit(0))).alias("gap_squares"),
        *[total(F.col(c)).alias(c) for c in ("days", "items", "spend", "priced", "online_items", "weekend_items")])
