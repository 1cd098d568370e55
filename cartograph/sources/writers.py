"""Parquet sinks: versioned feature splits, predictions, partitioned facts, metadata."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_feature_splits(train: DataFrame, val: DataFrame, test: DataFrame, base_path: str,
                         version: str = "v1") -> dict:
    """Overwrite ``churn_{train,val,test}_{version}`` under ``base_path``; return the paths."""
    paths = {}
    for name, df in (("train", train), ("val", val), ("test", test)):
        path = f"{base_path}/churn_{name}_{version}"
        df.write.mode("overwrite").parquet(path)
        paths[f"{name}_path"] = path
    return paths


def write_predictions(scored: DataFrame, path: str,
                      columns=("customer_id", "is_churned", "probability_churn", "prediction")) -> str:
    scored.select(*columns).write.mode("overwrite").parquet(path)
    return path


def with_year_month(df: DataFrame, date_col: str = "t_dat") -> DataFrame:
    return df.withColumn("year", F.year(date_col)).withColumn("month", F.month(date_col))


def write_partitioned(df: DataFrame, path: str, date_col: str = "t_dat") -> str:
    """Hive-style year/month layout.

    Repartitioning by (year, month) alone would put a whole month in one task;
    instead rows are hashed by month *and* a spread key so that every month is
    written by several tasks, each producing its own file in that directory.
    """
    out = with_year_month(df, date_col)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(max(n // 4, 1)))
    (out.repartition(n, "year", "month", spread)
        .write.mode("overwrite").partitionBy("year", "month").parquet(path))
    return path


def read_partitioned(spark: SparkSession, path: str, start: str | None = None,
                     end: str | None = None, date_col: str = "t_dat") -> DataFrame:
    """Read the year/month layout; date bounds also become partition predicates."""
    df = spark.read.parquet(path)
    if start is not None:
        s = _dt.date.fromisoformat(start)
        df = df.filter((F.col("year") * 100 + F.col("month")) >= s.year * 100 + s.month)
        df = df.filter(F.col(date_col) >= F.lit(start).cast("date"))
    if end is not None:
        e = _dt.date.fromisoformat(end)
        df = df.filter((F.col("year") * 100 + F.col("month")) <= e.year * 100 + e.month)
        df = df.filter(F.col(date_col) <= F.lit(end).cast("date"))
    return df


def feature_store_metadata(spark: SparkSession, features: DataFrame, customer_col: str = "customer_id",
                           created: str | None = None) -> DataFrame:
    """Creation time (now, in UTC, unless given), customer count and the feature list as one long table."""
    created = created or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat()
    names = spark.createDataFrame(
        [(i + 1, c) for i, c in enumerate(features.columns)],
        T.StructType([T.StructField("position", T.IntegerType()),
                      T.StructField("feature", T.StringType())]))
    total = features.agg(F.count_distinct(customer_col)).scalar()  # scalar subquery
    return names.select(
        F.lit(created).alias("creation_date"), total.alias("total_customers"),
        F.lit(len(features.columns)).alias("total_features"), "position", "feature")
