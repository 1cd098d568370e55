"""Data-quality checks, each returned as data (one job per report, not per column)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartograph.functions.scalars import pct

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
           T.DecimalType)


def _unpivot_counts(df: DataFrame, counts: dict, table_name: str, count_name: str) -> DataFrame:
    """One aggregate row → long (column_name, count, pct)."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [expr.alias(f"_c{i}") for i, expr in enumerate(counts.values())]
    row = df.agg(*aggs)
    pairs = ", ".join(f"'{name}', _c{i}" for i, name in enumerate(counts))
    long = row.select("_rows", F.expr(f"stack({len(counts)}, {pairs}) AS (column_name, {count_name})"))
    return long.select(
        F.lit(table_name).alias("table_name"), "column_name",
        F.col(count_name).cast("long").alias(count_name),
        pct(count_name, "_rows").alias(count_name.replace("count", "pct")),
    )


def null_profile(df: DataFrame, table_name: str = "table") -> DataFrame:
    """Null count and % per column; numeric columns also count NaN (validator rule)."""
    counts = {}
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, NUMERIC):
            counts[f.name] = F.count_if(c.isNull() | F.isnan(c.cast("double")))
        else:
            counts[f.name] = F.count_if(c.isNull())
    return _unpivot_counts(df, counts, table_name, "null_count")


def missing_profile(df: DataFrame, table_name: str = "table") -> DataFrame:
    """Null-only counts, offending columns only, with a severity class (<10, 10–50, >50 %)."""
    counts = {f.name: F.count_if(F.col(f"`{f.name}`").isNull()) for f in df.schema.fields}
    p = _unpivot_counts(df, counts, table_name, "missing_count").filter(F.col("missing_count") > 0)
    return p.withColumn("severity", F.when(F.col("missing_pct") > 50, "high")
                        .when(F.col("missing_pct") > 10, "medium").otherwise("low"))


def duplicate_keys(df: DataFrame, key: str, table_name: str = "table") -> DataFrame:
    """rows − distinct keys, where null counts as one key."""
    k = F.col(key)
    out = df.agg(F.count(F.lit(1)).alias("total_rows"),
                 (F.count_distinct(k) + F.max(F.when(k.isNull(), 1).otherwise(0))).alias("unique_keys"))
    return out.select(F.lit(table_name).alias("table_name"), F.lit(key).alias("key_column"),
                      "total_rows", F.col("unique_keys").cast("long").alias("unique_keys"),
                      (F.col("total_rows") - F.col("unique_keys")).cast("long").alias("duplicates"))


def date_range(df: DataFrame, date_col: str = "t_dat") -> DataFrame:
    out = df.agg(F.min(date_col).alias("min_date"), F.max(date_col).alias("max_date"))
    span = F.datediff("max_date", "min_date")
    return out.select("min_date", "max_date", span.alias("days_span"),
                      (span / 365.0).alias("years_span"))


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys without a dimension row (a null key is an orphan)."""
    return fact.select(key).distinct().join(dim.select(key), key, "left_anti")


def referential_integrity(tx: DataFrame, customers: DataFrame, articles: DataFrame,
                          customer_key: str = "customer_id", article_key: str = "article_id") -> DataFrame:
    """Counts of distinct orphan customer and article keys."""
    def one(name, fact_key, dim):
        return orphan_keys(tx, dim, fact_key).agg(
            F.lit(name).alias("check_name"), F.count(F.lit(1)).alias("orphan_keys"))
    return one("orphan_customers", customer_key, customers).unionByName(
        one("orphan_articles", article_key, articles))


def value_distribution(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    """Top-k values by count (ties by value, nulls last)."""
    return (df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
              .orderBy(F.col("count").desc(), F.col(column).asc_nulls_last()).limit(k))


def validation_report(articles: DataFrame, customers: DataFrame, tx: DataFrame,
                      article_key: str = "article_id", customer_key: str = "customer_id",
                      date_col: str = "t_dat") -> DataFrame:
    """All checks as one long table (table_name, check_name, column_name, value)."""
    parts = []
    for name, df in (("articles", articles), ("customers", customers), ("transactions", tx)):
        parts.append(null_profile(df, name).select(
            "table_name", F.lit("null_count").alias("check_name"), "column_name",
            F.col("null_count").cast("double").alias("value")))
    for name, df, key in (("articles", articles, article_key), ("customers", customers, customer_key)):
        parts.append(duplicate_keys(df, key, name).select(
            "table_name", F.lit("duplicates").alias("check_name"), F.col("key_column").alias("column_name"),
            F.col("duplicates").cast("double").alias("value")))
    dr = date_range(tx, date_col)
    parts.append(dr.select(F.lit("transactions").alias("table_name"), F.lit("days_span").alias("check_name"),
                           F.lit(date_col).alias("column_name"), F.col("days_span").cast("double").alias("value")))
    ri = referential_integrity(tx, customers, articles, customer_key, article_key)
    parts.append(ri.select(F.lit("transactions").alias("table_name"), "check_name",
                           F.when(F.col("check_name") == "orphan_customers", customer_key)
                           .otherwise(article_key).alias("column_name"),
                           F.col("orphan_keys").cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
