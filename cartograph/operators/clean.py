"""Imputation, cleaning and train/validation/test splits of the feature row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.functions.joins import join_small, materialize

# Constant modes and the columns whose nulls drop a row.
STATUS_MODE = "ACTIVE"
NEWS_MODE = "NONE"
CRITICAL_COLUMNS = ["customer_id", "days_since_last_purchase", "total_purchases", "is_churned"]
SPLIT_SEED = 42


def global_median(df: DataFrame, column: str, method: str = "exact", accuracy: int = 100):
    """A scalar-subquery Column for the median of ``column``.

    exact  — ``percentile_disc(0.5)``: an actual data value (lower median);
    approx — ``percentile_approx`` with relative error 1/accuracy (the
             Greenwald–Khanna sketch behind ``approxQuantile``); a data value too.
    Returns null on empty input instead of failing.
    """
    c = F.col(column)
    if method == "approx":
        agg = F.percentile_approx(c, 0.5, accuracy)
    else:
        agg = F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}`)")
    return df.filter(c.isNotNull()).agg(agg.cast("double")).scalar()


def impute_age(df: DataFrame, group_col: str = "club_member_status", age_col: str = "age",
               global_method: str = "exact") -> DataFrame:
    """Null ages ← median of the row's group, then ← global median of the result.

    Group medians are exact and interpolating (``median``).  A row whose group
    key is null never matches (equi-join), so it takes the global value.  The
    group table has one row per group; it is broadcast only after its size is
    checked (``join_small``).
    """
    medians = (df.filter(F.col(age_col).isNotNull()).groupBy(group_col)
                 .agg(F.median(age_col).alias("_group_median"))
                 .filter(F.col(group_col).isNotNull()))
    step1 = join_small(df, medians, group_col, "left")
    step1 = step1.withColumn(age_col, F.coalesce(F.col(age_col), F.col("_group_median"))).drop("_group_median")
    g = global_median(step1, age_col, global_method)
    return step1.withColumn(age_col, F.coalesce(F.col(age_col), g))


def mode_value(df: DataFrame, column: str):
    """Most frequent non-null value (ties → smallest value) as a scalar subquery."""
    top = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
             .orderBy(F.col("count").desc(), F.col(column).asc()).limit(1).select(column))
    return top.scalar()


def impute_mode(df: DataFrame, fills: dict | None = None, computed: Sequence[str] = ()) -> DataFrame:
    """Null ← constant (defaults: status ACTIVE, news NONE) or ← the computed mode."""
    fills = {"club_member_status": STATUS_MODE, "fashion_news_frequency": NEWS_MODE,
             **(fills or {})}
    for c, v in fills.items():
        value = mode_value(df, c) if c in computed else F.lit(v)
        df = df.withColumn(c, F.coalesce(F.col(c), value))
    return df


def clean_churn_features(features: DataFrame, global_method: str = "exact",
                         critical: Sequence[str] = CRITICAL_COLUMNS, materialize_input: bool = True) -> DataFrame:
    """Age (group, then global) → status → news → drop rows null in critical columns.

    The feature table (one row per customer) is read three times — group
    medians, the global median and the imputed rows — so it is materialised
    once first (reliable checkpoint) instead of recomputing it from the facts.
    """
    if materialize_input:
        features = materialize(features)
    df = impute_age(features, global_method=global_method)
    df = impute_mode(df)
    return df.dropna(how="any", subset=list(critical))


def cleaning_counts(raw: DataFrame, cleaned: DataFrame, age_col: str = "age") -> DataFrame:
    """Before/after report as data: rows and null ages on both sides (two small aggregates)."""
    before = raw.agg(F.count(F.lit(1)).alias("initial_rows"),
                     F.count_if(F.col(age_col).isNull()).alias("age_nulls_before"))
    after = cleaned.agg(F.count(F.lit(1)).alias("final_rows"),
                        F.count_if(F.col(age_col).isNull()).alias("age_nulls_after"))
    return before.select(
        "initial_rows", "age_nulls_before",
        after.select("final_rows").scalar().alias("final_rows"),
        after.select("age_nulls_after").scalar().alias("age_nulls_after"),
    ).withColumn("dropped", F.col("initial_rows") - F.col("final_rows"))


def hash_bucket(key: str, seed: int = SPLIT_SEED, buckets: int = 100):
    """Stable bucket in [0, buckets): first 8 hex digits of md5('<seed>:<key>') mod buckets."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), 1, 8), 16, 10)
    return F.pmod(h.cast("long"), F.lit(buckets))


def hash_split_label(key: str = "customer_id", train_ratio: float = 0.7, val_ratio: float = 0.15,
                     seed: int = SPLIT_SEED):
    b = hash_bucket(key, seed, 100)
    t = int(round(train_ratio * 100))
    v = int(round((train_ratio + val_ratio) * 100))
    return F.when(b < t, F.lit("train")).when(b < v, F.lit("validation")).otherwise(F.lit("test"))


def hash_split(df: DataFrame, key: str = "customer_id", train_ratio: float = 0.7,
               val_ratio: float = 0.15, seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Deterministic split by key hash: independent of partitioning and re-runs."""
    lab = hash_split_label(key, train_ratio, val_ratio, seed)
    return (df.filter(lab == "train"), df.filter(lab == "validation"), df.filter(lab == "test"))


def random_split(df: DataFrame, train_ratio: float = 0.7, val_ratio: float = 0.15,
                 seed: int = SPLIT_SEED) -> list[DataFrame]:
    """The reference's seeded ``randomSplit`` (depends on the input partitioning)."""
    return df.randomSplit([train_ratio, val_ratio, 1.0 - train_ratio - val_ratio], seed=seed)


def split_churn_rates(splits: dict, label_col: str = "is_churned") -> DataFrame:
    """Rows and churn % per named split."""
    parts = [df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("rows"),
                    (F.avg(F.col(label_col).cast("double")) * 100.0).alias("churn_pct"))
             for name, df in splits.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
