"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh64

from cartograph.session import ensure_checkpoint_dir

# The white space that separates words, and the letters that are folded.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

ROW = "_llm_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def fold_ascii(c: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def numbered(docs: DataFrame, name: str = ROW) -> DataFrame:
    """Add ``_llm_row`` (or ``name``), the row's place in the table: its file's place by path, then its place in the file.

    For a table of files the number does not depend on how they are split into
    partitions, so any two reads agree, whatever cores there are at the time.  A
    checkpoint has no files to name, but fixed partitions: there the number is
    the partition and the place in it.  The input must be one or the other, not
    a plan whose row order can change between two evaluations.
    """
    try:
        paths = docs.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.row_index")).select("p").distinct().collect()
    except AnalysisException as e:
        if not (e.getCondition() or "").startswith(("UNRESOLVED_COLUMN", "FIELD_NOT_FOUND")):
            raise
        return docs.withColumn(name, F.monotonically_increasing_id())
    path, place = (free_name(docs, n) for n in ("_llm_path", "_llm_file"))
    at = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(name))
    files = docs.sparkSession.createDataFrame([(p, i) for i, p in enumerate(sorted(r["p"] for r in paths))], f"{path} string, {place} long")
    # One row a file: as many as the driver lists for the scan itself.
    return (at.join(F.broadcast(files), path)
            .withColumn(name, F.shiftleft(place, 40) + F.col(name)).drop(path, place))


FILE_BITS, PLACE_BITS = 37, 26


def keyed(docs: DataFrame, name: str = ROW) -> DataFrame:
    """Add ``_llm_row`` (or ``name``): a hash of the row's file and the place in it, as one positive number.

    Nothing is joined or shuffled, and any two reads of one table agree, however
    its files are split.  The driver, which lists the files of a scan anyway,
    makes sure that no two of them have the same hash.  The input must read
    stored files, with projections and filters at most; anything else raises,
    since its rows have no place that a second evaluation would find again.
    """
    try:
        place = docs.metadataColumn("_metadata")
        at = docs.select("*", place["file_path"].alias(free_name(docs, "_llm_path")), place["row_index"].alias(free_name(docs, name)))
        files = docs.inputFiles()
    except AnalysisException as e:
        raise ValueError("rows can only be numbered in a stored table, not in the result of a plan") from e
    path, row = at.columns[-2:]
    salt, mask = 0, (1 << FILE_BITS) - 1
    while len({xxh64(f"{salt}{f}".encode(), seed=42).intdigest() & mask for f in files}) < len(set(files)):
        salt += 1
    of_file = F.xxhash64(F.concat(F.lit(str(salt)), F.col(path))).bitwiseAND(F.lit(mask))
    inside = F.when(F.col(row) < 1 << PLACE_BITS, F.col(row)).otherwise(
        F.raise_error(F.lit(f"a file with more than 2^{PLACE_BITS} rows")).cast("long"))
    return at.withColumn(row, F.shiftleft(of_file, PLACE_BITS) + inside).drop(path)


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to a fresh folder below the session's checkpoint directory and read it back.

    Cuts the lineage like ``checkpoint()``, in compressed columns: all executors
    share the folder, so a lost executor takes nothing with it.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH = 512  # rows that a Python worker of the pipeline is sent at once


def small_batches(spark: SparkSession) -> None:
    """Rows go to and from Python workers at most BATCH at a time, for all that the session runs from now on.

    Spark sends 10,000 texts at once else, which the JVM and every worker hold
    twice, and workers that wait for their next task keep what they grew to.
    The operators take rows in slices that are no larger, so no result depends
    on it.  A session that asks for fewer keeps its own number.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH:  # 0 or less: no bound
        spark.conf.set(name, str(BATCH))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8 (``bytes`` splits and folds ASCII only)."""
    return text.encode().lower().split() if text else []


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``docs`` has it (names ignore case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def keep_rows(docs: DataFrame, rows: DataFrame, how: str, number=numbered) -> DataFrame:
    """Rows of ``docs`` whose number, by ``number``, is (``left_semi``) or is not (``left_anti``) in ``rows``."""
    own = free_name(docs, ROW)
    marked = number(docs, own)
    wanted = rows.select(F.col(ROW).alias(own)).hint("shuffle_hash")
    return marked.join(wanted, own, how).drop(own)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, whatever the optimizer collapses."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
