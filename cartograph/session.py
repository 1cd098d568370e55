"""Session helpers.

On a cluster the session is supplied by the host; these helpers only fill in
what is missing (tests, bench).  A checkpoint directory is read from
``spark.checkpoint.dir``; a temporary one is created only for a single-JVM
session where it is unset.  Checkpoints are removed when they are no longer used
if the session sets ``spark.cleaner.referenceTracking.cleanCheckpoints``.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def get_session(app_name: str = "cartograph", cores: str | int = "*",
                shuffle_partitions: int = 8, driver_memory: str = "8g") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory.

    Where none is set, a session in a single JVM (``local``, as in tests) gets a
    temporary one; on a cluster that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="cartograph-ckpt-")  # one JVM: its own folder is shared by all its threads
    sc.setCheckpointDir(path)
    return path
