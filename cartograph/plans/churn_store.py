"""End-to-end churn feature store build (the reference's batch run, §3.1):
facts → leakage-free features → cleaning → key-hash split → versioned Parquet.

Counts that the reference logged with one extra job each are collected with
Spark ``Observation`` metrics on the writes themselves, so the whole build is
three write jobs.  The feature table is materialised once; cleaning runs with each write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from cartograph.operators import clean, features


def build_churn_store(tx: DataFrame, customers: DataFrame, base_path: str, version: str = "v1",
                      cutoff: str = features.DEFAULT_CUTOFF, horizon_days: int = features.DEFAULT_HORIZON,
                      money_scale: int | None = None) -> dict:
    """Build and persist train/validation/test feature splits; return paths and counts."""
    feats = features.churn_features(tx, customers, cutoff, horizon_days, money_scale=money_scale)
    cleaned = clean.clean_churn_features(feats)  # materialises its input, the feature table
    splits = clean.hash_split(cleaned)
    observed, paths = {}, {}
    for name, df in zip(("train", "val", "test"), splits):
        obs = Observation(f"churn_{name}")
        counted = df.observe(obs, F.count(F.lit(1)).alias("rows"),
                             F.sum(F.col("is_churned")).alias("churned"))
        path = f"{base_path}/churn_{name}_{version}"
        counted.write.mode("overwrite").parquet(path)
        observed[name] = obs.get
        paths[f"{name}_path"] = path
    total = sum(v["rows"] for v in observed.values())
    return {**paths, "counts": observed, "rows": total,
            "churn_pct": {k: (100.0 * v["churned"] / v["rows"] if v["rows"] else None) for k, v in observed.items()}}

