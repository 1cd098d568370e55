"""Readers for the raw retail tables and the persisted feature splits."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartograph.sources import schemas


def _by_header(spark: SparkSession, path: str, schema: T.StructType, required, infer: bool, **options) -> DataFrame:
    """A CSV file read by its header: whatever their order, the columns that ``schema`` names get
    its types (a value that does not fit is null) and the others stay strings."""
    reader = spark.read.option("header", "true").options(**options)
    if infer:
        return reader.option("inferSchema", "true").csv(path)
    raw = reader.csv(path)
    missing = sorted(set(required) - set(raw.columns))
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} in the header")
    kinds = {f.name: f.dataType for f in schema}
    return raw.select(*[F.col(f"`{c}`").try_cast(kinds[c]).alias(c) if c in kinds else F.col(f"`{c}`") for c in raw.columns])


def read_articles(spark: SparkSession, path: str, infer_schema: bool = False,
                  cache: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """Product table; quotes inside fields are escaped with a double quote.

    All columns of the file are kept.  ``article_id`` must be there, and with an
    own ``schema`` every column that it names.  ``cache`` is for small dimension
    tables only.
    """
    df = _by_header(spark, path, schema or schemas.ARTICLES, schema.names if schema else ["article_id"], infer_schema, escape='"')
    return df.cache() if cache else df


def read_customers(spark: SparkSession, path: str, infer_schema: bool = False,
                   cache: bool = False, schema: T.StructType | None = None) -> DataFrame:
    df = _by_header(spark, path, schema or schemas.CUSTOMERS, schema.names if schema else ["customer_id"], infer_schema)
    return df.cache() if cache else df


def read_transactions(spark: SparkSession, path: str, infer_schema: bool = False,
                      schema: T.StructType | None = None) -> DataFrame:
    """Fact table; all of its columns must be there; never cached (it is the large one)."""
    wanted = schema or schemas.TRANSACTIONS
    df = _by_header(spark, path, wanted, wanted.names, infer_schema)
    return df.withColumn("t_dat", F.to_date("t_dat")) if infer_schema else df


def load_all(spark: SparkSession, raw_dir: str, infer_schema: bool = False, schemas_by_table: dict | None = None):
    """(articles, customers, transactions) from ``raw_dir``; a missing file raises FileNotFoundError."""
    own = schemas_by_table or {}
    found = []
    for name, read in (("articles", read_articles), ("customers", read_customers), ("transactions", read_transactions)):
        path = os.path.join(raw_dir, "transactions_train.csv" if name == "transactions" else f"{name}.csv")
        try:
            found.append(read(spark, path, infer_schema, schema=own.get(name)))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(path) from e
    return tuple(found)


def total_row_count(tables: dict) -> DataFrame:
    """One row: the sum of row counts over the given tables (one job)."""
    parts = [df.select(F.lit(name).alias("table_name")).groupBy("table_name").count()
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.agg(F.sum("count").cast("long").alias("total_rows"))


def dataset_profile(tables: dict, with_partitions: bool = False) -> DataFrame:
    """Rows and columns per table (and the input partition count if asked)."""
    parts = []
    for name, df in tables.items():
        cols = [F.lit(name).alias("table_name"), F.count(F.lit(1)).cast("long").alias("row_count"),
                F.lit(len(df.columns)).alias("column_count")]
        if with_partitions:
            cols.append(F.lit(df.rdd.getNumPartitions()).alias("partitions"))
        parts.append(df.agg(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def read_feature_split(spark: SparkSession, base_path: str, split: str = "train",
                       version: str = "v1") -> DataFrame:
    return spark.read.parquet(f"{base_path}/churn_{split}_{version}")
