"""Exact deduplication by deterministic block naming (DataFrame functions only).

Every text is cut into blocks of a fixed number of characters.  Equal blocks get
the same integer name and different blocks different ones: the name is the
smallest occurrence number among the equal blocks, found by an aggregation that
combines on the map side.  Adjacent names are then paired and the pairs named in
the same way, level by level, until one name is left for each document.  Two
documents of the same level are equal exactly when their last names are equal:
no hash is trusted.

Only documents that share their length and first characters with another one can
have an equal; the others are alone and need no names.

Scale: the texts are shuffled once by row number, and only contenders' blocks
are shuffled by content.  A name's group is never collected: it is one minimum,
joined back by a join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import ROW, fold_ascii, keep_rows, keyed, stage, text_or_empty

HEAD = 64
BLOCK = 16384
SALTS = 16


def _named(level: DataFrame, key: list[str]) -> DataFrame:
    """(row, n, pos, key…, occ) → (row, n, pos, name): the smallest ``occ`` among equal keys."""
    names = level.groupBy(*key).agg(F.min("occ").alias("name"))
    return level.join(names, key).select(ROW, "n", "pos", "name")


def _identities(blocks: DataFrame) -> DataFrame:
    """(row, n, pos, block) → one (row, depth, name) for each document."""
    named = stage(_named(stage(blocks.withColumn("occ", F.monotonically_increasing_id())), ["block"]))
    most = named.agg(F.max("n")).first()[0] or 0
    done, depth = [], 0
    while True:
        done.append(named.where("n = 1").select(ROW, F.lit(depth).alias("depth"), "name"))
        if most <= 1:
            break
        pairs = (named.where("n > 1")
                 .groupBy(ROW, "n", F.expr("pos div 2").cast("int").alias("pair"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right")))
        pairs = pairs.select(ROW, F.expr("cast((n + 1) div 2 as int)").alias("n"), F.col("pair").alias("pos"),
                             "left", "right", F.monotonically_increasing_id().alias("occ"))
        named = stage(_named(stage(pairs), ["left", "right"]))
        most, depth = (most + 1) // 2, depth + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block: int = BLOCK, head: int = HEAD) -> DataFrame:
    """One row per row of ``docs``: row number, id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z.  Of equal texts the
    row with the largest id stays.  Defined cases: a null text is an empty text,
    and empty texts are equal to one another; a null id counts as smaller than
    any other (``keep_id`` is null where a group has only null ids); where rows
    repeat an id, the one with the smallest row number stays, so exactly one row
    of each group is kept; an empty table gives an empty result; other columns of
    ``docs`` are ignored, whatever their names.  ``docs`` must be a stored table.
    """
    rows = keyed(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")))
    folded = rows.select(ROW, "doc_id", fold_ascii(F.col("text")).alias("norm"))
    keys = stage(folded.select(ROW, "doc_id", F.sha2("norm", 256).alias("text_sha256"),
                               F.octet_length("norm").alias("size"), F.substring("norm", 1, head).alias("head")))
    shared = keys.groupBy("size", "head").count().where("count > 1").select(
        "size", "head", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # Dealt by a salt too, so that many texts of one length and beginning do not meet in one task.
    contenders = (keys.withColumn("salt", F.pmod(F.xxhash64(ROW), F.lit(SALTS)).cast("int"))
                  .join(shared, ["size", "head", "salt"]).select(ROW))
    cut = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block), F.lit(0)))
    blocks = (folded.select(ROW, "norm").join(contenders.hint("shuffle_hash"), ROW)
              .select(ROW, cut.alias("cut"))
              .select(ROW, F.size("cut").alias("n"), F.posexplode("cut").alias("pos", "block")))
    names = stage(_identities(blocks).join(keys.select(ROW, "doc_id"), ROW))
    groups = names.groupBy("depth", "name").agg(
        F.max(F.struct("doc_id", (-F.col(ROW)).alias("minus_row"))).alias("best"), F.count("*").alias("size"))
    found = names.join(groups, ["depth", "name"]).select(ROW, "best", F.col("size").alias("group_size"))
    out = keys.select(ROW, "doc_id", "text_sha256").join(found, ROW, "left")
    alone = F.col("group_size").isNull()
    return out.select(
        ROW, "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("best.minus_row") == -F.col(ROW))).alias("kept"),
        "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that ``exact_groups`` keeps, with all their columns.

    Null, empty and repeated rows as there: of the rows without a text one stays,
    and of a row and its repetitions one; an empty table gives an empty one, and
    columns of any name are kept.  ``docs`` must be a stored table.
    """
    return keep_rows(docs, exact_groups(docs, id_col, text_col, **options).where("not kept"), "left_anti", keyed)
