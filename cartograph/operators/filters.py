"""Projections, filters and predicates.

All are narrow transformations (no shuffle) except ``drop_sparse_columns``,
which needs one aggregate pass to measure null shares, and
``membership_filter`` with a data-derived list, which is a left-semi join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.dates import as_date
from cartograph.functions.scalars import clip_upper as _clip
from cartograph.functions.scalars import safe_ratio


def three_way_time_split(df: DataFrame, train_end: str, val_end: str,
                         date_col: str = "t_dat") -> tuple[DataFrame, DataFrame, DataFrame]:
    """train: d ≤ train_end; validation: train_end < d ≤ val_end; test: d > val_end."""
    d = F.col(date_col)
    return (df.filter(d <= as_date(train_end)),
            df.filter((d > as_date(train_end)) & (d <= as_date(val_end))),
            df.filter(d > as_date(val_end)))


def split_label(date_col: str, train_end: str, val_end: str):
    d = F.col(date_col)
    return (F.when(d <= as_date(train_end), F.lit("train"))
             .when(d <= as_date(val_end), F.lit("validation"))
             .otherwise(F.lit("test")))


def inclusive_window(df: DataFrame, start: str, end: str, date_col: str = "t_dat") -> DataFrame:
    """start ≤ d ≤ end (both ends inclusive)."""
    return df.filter(F.col(date_col).between(as_date(start), as_date(end)))


def column_subset(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def null_shares(df: DataFrame) -> DataFrame:
    """One row: the null share (0..1) of every column, in one pass; null for an empty table."""
    n = F.count(F.lit(1))
    return df.agg(*[safe_ratio(F.count_if(F.col(c).isNull()), n).alias(c) for c in df.columns])


def drop_sparse_columns(df: DataFrame, threshold: float = 0.65) -> DataFrame:
    """Drop columns whose null share exceeds ``threshold`` (one small aggregate job)."""
    shares = null_shares(df).first()
    if shares is None:
        return df
    sparse = [c for c in df.columns if shares[c] is not None and shares[c] > threshold]
    return df.drop(*sparse)


def drop_critical_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(columns))


def not_null_filter(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def membership_filter(df: DataFrame, column: str, values=None, keys: DataFrame | None = None) -> DataFrame:
    """``column IN values`` for a literal list, or a left-semi join on a key table.

    Spark chooses the join by the key table's size in bytes.
    """
    if values is not None:
        return df.filter(F.col(column).isin(list(values)))
    k = keys.select(F.col(keys.columns[0]).alias(column)).distinct()
    return df.join(k, column, "left_semi")


def clip_upper(df: DataFrame, column: str, upper, out: str | None = None) -> DataFrame:
    return df.withColumn(out or column, _clip(column, upper))


def scale_to_max_pct(df: DataFrame, columns: Sequence[str], suffix: str = "_pct_of_max") -> DataFrame:
    """metric / max(metric) × 100 over an aggregated (small) frame."""
    w = Window.partitionBy()
    for c in columns:
        df = df.withColumn(c + suffix, F.col(c) * 100.0 / F.max(c).over(w))
    return df
