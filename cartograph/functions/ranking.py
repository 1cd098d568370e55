"""Distributed global ranking and running totals.

A window with an ORDER BY but no PARTITION BY moves every row into one task.
These helpers number or accumulate rows in a global order without that funnel:

1. ``repartitionByRange(n, keys)`` + ``sortWithinPartitions`` — a sampled range
   shuffle with an explicit partition count (AQE keeps it as is), so partition
   ``i`` holds the i-th slice of the global order.  The result is written once
   with a reliable checkpoint: the range boundaries come from a sample seeded
   per RDD, so two independent evaluations of the shuffle (one per branch
   below) could choose different boundaries.  The checkpoint keeps the
   partitioning and in-partition order, so both branches see the same slices;
2. per-partition row counts (or measure sums) — at most ``n`` rows;
3. their exclusive prefix sums over those ``n`` rows (a tiny single-task window)
   joined back by broadcast (size bounded by ``n``);
4. the in-partition position from ``monotonically_increasing_id`` (whose low
   33 bits are the record number inside the partition), so numbering needs no
   second shuffle.  ``global_running_sum`` needs one more, by partition number,
   for its window; its inputs are one row per distinct value.

The order columns must form a total order (include a unique key last);
otherwise equal rows could be numbered differently across the two branches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.joins import materialize

_LOW33 = (1 << 33) - 1


def _ranged(df: DataFrame, order_cols: Sequence[Column], num_partitions: int | None):
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols))
    return (ranged.withColumn("_pid", F.spark_partition_id())
              .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))


def _offsets(ranged: DataFrame, measure: Column, name: str) -> DataFrame:
    per = ranged.groupBy("_pid").agg(F.sum(measure).alias("_part"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("_pid", F.coalesce(F.sum("_part").over(w), F.lit(0)).alias(name))


def global_row_number(df: DataFrame, order_cols: Sequence[Column], name: str = "rank",
                      num_partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number in the global order given by ``order_cols``."""
    r = _ranged(df, order_cols, num_partitions)
    off = _offsets(r, F.lit(1).cast("long"), "_off")
    return (r.join(F.broadcast(off), "_pid")
             .withColumn(name, F.col("_off") + F.col("_pos") + F.lit(1))
             .drop("_pid", "_pos", "_off"))


def global_running_sum(df: DataFrame, order_cols: Sequence[Column], measure: str,
                       name: str = "running_sum", num_partitions: int | None = None) -> DataFrame:
    """Inclusive running sum of ``measure`` in the global order of ``order_cols``."""
    r = _ranged(df, order_cols, num_partitions)
    off = _offsets(r, F.col(measure), "_off")
    local = Window.partitionBy("_pid").orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)
    return (r.withColumn("_local", F.sum(measure).over(local))
             .join(F.broadcast(off), "_pid")
             .withColumn(name, F.col("_off") + F.col("_local"))
             .drop("_pid", "_pos", "_off", "_local"))


def top_k(df: DataFrame, k: int, order_cols: Sequence[Column]) -> DataFrame:
    """orderBy(...).limit(k): planned as TakeOrderedAndProject (k rows per task)."""
    return df.orderBy(*order_cols).limit(k)


def top_k_per_group(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[Column], k: int,
                    name: str = "rank", salt_buckets: int = 16, salt_key: str | None = None) -> DataFrame:
    """Exact top-k rows per group, with hot groups split before ranking.

    Phase 1 ranks within (group, salt) where the salt hashes ``salt_key`` (or
    the whole row) into ``salt_buckets`` slices, so a group holding a third of
    the rows is spread over many tasks; phase 2 ranks the ≤ salt_buckets·k
    survivors per group.  The global top-k of a group is always among the
    per-slice top-k, so the result is exact.  ``order_cols`` must be a total
    order within a group (end with a unique key).
    """
    salt_src = F.col(salt_key) if salt_key else F.xxhash64(*[F.col(c) for c in df.columns])
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(salt_src), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order_cols)
    phase1 = salted.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return phase1.withColumn(name, F.row_number().over(w2)).filter(F.col(name) <= k)
