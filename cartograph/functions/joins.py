"""Joins and lineage cuts.

Spark chooses a join by the sides' sizes in bytes, at run time where adaptive
execution is on.  A side is broadcast by a hint only where its size is bounded
by construction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.session import ensure_checkpoint_dir


def broadcast_bounded(small: DataFrame) -> DataFrame:
    """Broadcast a side that cannot grow with the data: a ``limit(k)``, a literal list, calendar months, classes."""
    return F.broadcast(small)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Join with a data-derived side that is computed once; Spark broadcasts it only if its bytes allow it."""
    return big.join(materialize(small), on, how)


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage: a reliable checkpoint to the session's
    checkpoint directory (survives executor loss; never a machine-local cache).

    Used where an operator reads the same per-customer table several times
    (fitted medians, global ranks, counts) so the fact table is not rescanned.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
