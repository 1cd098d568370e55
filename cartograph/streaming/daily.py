"""The daily activity roll-up over a streaming transaction source.

The reference is batch only; this module only lets the same per-day measures
(item rows, revenue, distinct customers) be maintained incrementally as new
fact files land.  Structured Streaming specifics:

* the item stream is joined to the (static) order table — a stream-static join;
* distinct customers per day are exact: ``dropDuplicatesWithinWatermark`` on
  (day, customer) before counting, both bounded by the event-time watermark;
* the sink and its checkpoint live under the session's checkpoint directory,
  so a restarted query resumes exactly once from the last committed batch where
  that directory outlives the session (a fixed ``spark.checkpoint.dir``; the
  temporary one of a local session does not).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartograph.session import ensure_checkpoint_dir


def transactions_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int = 1) -> DataFrame:
    """Item rows from ``lineitem`` files arriving in ``source_dir`` ⋈ the static orders table."""
    li_schema = spark.read.parquet(os.path.join(source_dir, "lineitem.parquet")).schema
    items = (spark.readStream.schema(li_schema).option("pathGlobFilter", "lineitem*.parquet")
             .option("maxFilesPerTrigger", max_files_per_trigger).parquet(source_dir))
    orders = spark.read.parquet(os.path.join(source_dir, "orders.parquet")).select(
        "o_orderkey", "o_custkey", "o_orderdate")
    return items.join(orders, items.l_orderkey == orders.o_orderkey).select(
        F.to_date("o_orderdate").alias("t_dat"), F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_custkey").alias("customer_id"), F.col("l_partkey").alias("article_id"),
        F.col("l_extendedprice").alias("price"))


def daily_activity_stream(tx: DataFrame, watermark: str = "30 days") -> tuple[DataFrame, DataFrame]:
    """(per-day items and revenue, per-day distinct customers) as two streaming aggregates."""
    wm = tx.withWatermark("event_time", watermark)
    volume = wm.groupBy(F.window("event_time", "1 day").alias("day")).agg(
        F.count(F.lit(1)).alias("transaction_count"), F.sum("price").alias("revenue"))
    customers = (wm.dropDuplicatesWithinWatermark(["t_dat", "customer_id"])
                   .groupBy(F.window("event_time", "1 day").alias("day"))
                   .agg(F.count(F.lit(1)).alias("unique_customers")))
    return (volume.select(F.to_date("day.start").alias("t_dat"), "transaction_count", "revenue"),
            customers.select(F.to_date("day.start").alias("t_dat"), "unique_customers"))


def run_available_now(df: DataFrame, name: str, output_mode: str = "append") -> str:
    """Drain everything available into Parquet under the checkpoint directory; return the path."""
    spark = df.sparkSession
    base = os.path.join(spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark), "cartograph-stream", name)
    q = (df.writeStream.format("parquet").outputMode(output_mode)
           .option("checkpointLocation", os.path.join(base, "_checkpoint"))
           .option("path", os.path.join(base, "data")).trigger(availableNow=True).start())
    q.awaitTermination()
    return os.path.join(base, "data")
