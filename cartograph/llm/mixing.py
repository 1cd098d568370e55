"""Mixing sources to target weights, by fixed-length blocks.

Each source's words are packed, in a fixed pseudorandom order of its documents,
into blocks of BLOCK words.  A target gives every source a number of slots.
Output shards draw multinomial source counts, conditioned on these totals.  A
source's j-th slot takes, in pass ``j div blocks``, the block that a keyed
permutation of the block numbers gives for ``j mod blocks``; so every pass uses
each block once.  Slots and blocks are joined by source and block number.

Scale: what is collected is one size for each source (at most MAX_SOURCES).
Running sums are taken within (source, bucket) groups and over at most BUCKETS
bucket totals of a source, so that a hot source is spread over many tasks.  The
texts are shuffled once, with the pieces that each document has to give.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from re import compile as pattern

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cartograph.llm.common import ROW, free_name, numbered, stage, text_or_empty

WEIGHTS = (5.0, 2.0, 1.0)  # of the sources in their order, repeating
MAX_REPEATS = 3
BLOCK = 128
SHARDS = 64
BUCKETS = 4096
MAX_SOURCES = 100_000
SEED = 20

_WORD = pattern(r"[^\x20\x09-\x0D]+")
_U = np.uint64
_ROUND = np.arange(5, dtype=_U) * _U(0x9E3779B97F4A7C15)


def targets(sizes: Sequence[int], weights: Sequence[float], repeats: float = MAX_REPEATS) -> list[float]:
    """Shares of the whole by weight; what is above ``repeats`` times a size is reshared until none is.

    Sizes that sum to 0 have targets of 0.
    """
    out = [0.0] * len(sizes)
    left, free = float(sum(sizes)), [i for i, s in enumerate(sizes) if s > 0]
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > repeats * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(repeats * sizes[i])
        left -= sum(repeats * sizes[i] for i in over)
        free = [i for i in free if i not in set(over)]
    return out


def shard_counts(quotas: Sequence[int], shards: int, seed: int) -> np.ndarray:
    """(shards, sources) slots: multinomial draws conditioned on the sources' totals."""
    left = np.array(quotas, dtype=np.int64)
    total, out = int(left.sum()), np.zeros((shards, len(left)), dtype=np.int64)
    rng = np.random.default_rng(seed)
    for i in range(shards):
        need = total * (i + 1) // shards - total * i // shards
        while need and i < shards - 1:
            drawn = np.minimum(rng.multinomial(need, left / left.sum()), left)
            out[i] += drawn
            left -= drawn
            need -= int(drawn.sum())
    if shards:
        out[-1] += left
    return out


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """``index`` < ``size`` under the permutation of 0 … size - 1 that ``key`` chooses.

    Four Feistel rounds on the smallest even number of bits that holds ``size``;
    results outside are sent through again until they are inside.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64) + 1) // 2).astype(_U)
    mask = (_U(1) << half) - _U(1)
    out, todo = index.astype(_U), np.arange(len(index))
    while len(todo):
        h, m, k = half[todo], mask[todo], key[todo].astype(_U)
        left, right = out[todo] >> h, out[todo] & m
        for i in range(1, 5):
            x = (right + k + _ROUND[i]) * _U(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> _U(29))) * _U(0x94D049BB133111EB)
            left, right = right, left ^ ((x >> _U(32)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(_U)]
    return out.astype(np.int64)


def _placed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Row number, id, source, size and the first word's place in the source's stream."""
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                                text_or_empty(text_col).alias("text")))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(t.encode().split()) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (ROW, "doc_id", "source")), pa.array(sizes, pa.int64())],
                [ROW, "doc_id", "source", "size"])

    sized = rows.select(ROW, "doc_id", "source", "text").mapInArrow(
        run, f"{ROW} long, doc_id {kinds['doc_id']}, source {kinds['source']}, size long")
    sized = stage(sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)).cast("int")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = (sized.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
              .select(F.col("source").alias("s"), F.col("bucket").alias("k"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    within = (Window.partitionBy("source", "bucket").orderBy(F.col("doc_id").asc_nulls_last(), "size", ROW)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (sized.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("k")))
            .select(ROW, "doc_id", "source", "size", (F.col("base") + F.col("start")).alias("start")))


def _sources(placed: DataFrame, weights: Sequence[float], block: int) -> list[tuple]:
    """(index, source, size, target, blocks, slots) of every source, by code point, null last."""
    found = placed.groupBy("source").agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: group them first")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [int(r["n"]) for r in found]
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(found))])
    blocks = [-(-s // block) for s in sizes]
    slots = [min(MAX_REPEATS * b, int(t * b / s + 0.5)) if s else 0 for s, t, b in zip(sizes, wanted, blocks)]
    return [(i, r["source"], s, t, b, q) for i, (r, s, t, b, q) in enumerate(zip(found, sizes, wanted, blocks, slots))]


def _picks(placed: DataFrame, table: DataFrame, sources: list[tuple], block: int, shards: int, seed: int) -> DataFrame:
    """(row, shard, slot, a, b): the words a ≤ i < b of a row that a slot takes."""
    spark = placed.sparkSession
    counts = shard_counts([s[5] for s in sources], shards, seed)
    first = np.vstack([np.zeros(len(sources), dtype=np.int64), counts.cumsum(axis=0)[:-1]])
    plan = [(i, s, int(counts[i, s]), int(first[i, s]), int(counts[i, :s].sum()), int(sources[s][4]))
            for i in range(shards) for s in range(len(sources)) if counts[i, s]]
    planned = spark.createDataFrame(plan, "shard int, index int, n long, first long, before long, blocks long")
    slots = (planned.repartition("shard", "index")
             .select("shard", "index", "first", "before", "blocks", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"))
             .select("shard", "index", "blocks", (F.col("before") + F.col("i")).alias("slot"), (F.col("first") + F.col("i")).alias("j")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, blocks, j = (batch.column(c).to_numpy() for c in ("index", "blocks", "j"))
            key = (j // blocks) * 1_000_003 + index.astype(np.int64) * 7919 + seed
            yield pa.RecordBatch.from_arrays(
                [batch.column("shard"), batch.column("slot"), batch.column("index"), pa.array(permuted(j % blocks, blocks, key))],
                ["shard", "slot", "index", "block"])

    taken = slots.mapInArrow(run, "shard int, slot long, index int, block long")
    pieces = (placed.where("size > 0").join(table, placed["source"].eqNullSafe(table["s"]))
              .select(ROW, "index", "start", "size",
                      F.explode(F.expr(f"sequence(start div {block}, (start + size - 1) div {block})")).alias("block"))
              .select(ROW, "index", "block",
                      F.greatest(F.lit(0), F.col("block") * block - F.col("start")).alias("a"),
                      F.least("size", (F.col("block") + 1) * block - F.col("start")).alias("b")))
    # Both sides grow when they are exploded, which the planner's sizes don't show: never broadcast one.
    return pieces.hint("merge").join(taken, ["index", "block"]).select(ROW, "shard", "slot", "a", "b")


def _mixture(docs, id_col, text_col, source_col, weights, block, shards, seed):
    spark = docs.sparkSession
    placed = stage(_placed(docs, id_col, text_col, source_col))
    sources = _sources(placed, weights, block)
    kind = placed.schema["source"].dataType
    schema = T.StructType([T.StructField("index", T.IntegerType()), T.StructField("s", kind),
                           T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
    table = spark.createDataFrame([s[:4] for s in sources], schema)
    return placed, table, _picks(placed, table.select("index", "s"), sources, block, shards, seed)


def mixture(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            weights: Sequence[float] = WEIGHTS, block: int = BLOCK, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Row number, id, size, source_size, target and taken (words that the mix takes) of every row.

    Defined cases: a null or blank text has size 0 and gives nothing; the null
    source is a source, the last one; rows may repeat and ids may be null or
    repeated, each row is its own document; a table without words has targets
    and takings of 0; an empty table gives an empty result; other columns are
    ignored.  ``docs`` must be a stored table.
    """
    placed, table, picks = _mixture(docs, id_col, text_col, source_col, weights, block, shards, seed)
    taken = picks.groupBy(ROW).agg(F.sum(F.col("b") - F.col("a")).alias("n"))
    return (placed.join(table, placed["source"].eqNullSafe(table["s"])).join(taken, ROW, "left")
            .select(ROW, "doc_id", "size", "source_size", "target", F.coalesce("n", F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    length_col: str | None = "n_chars", weights: Sequence[float] = WEIGHTS, block: int = BLOCK,
                    shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """The mix itself: one row for each piece of a document that a slot takes, with the columns of ``docs``.

    The text is the piece, with the white space up to the next piece, so that
    the pieces of one pass over a document join to its text; ``length_col`` is
    the piece's length in code points where ``docs`` has that column.
    """
    _, _, picks = _mixture(docs, id_col, text_col, source_col, weights, block, shards, seed)
    own, got, text = (free_name(docs, n) for n in (ROW, "_llm_pieces", "_llm_text"))
    # A document's pieces are bounded by its own size: MAX_REPEATS times its blocks.
    pieces = (picks.groupBy(F.col(ROW).alias(own))
              .agg(F.sort_array(F.collect_list(F.struct("shard", "slot", "a", "b"))).alias(got)))
    rest = [f for f in docs.schema.fields if f.name != text_col]
    joined = numbered(docs, own).join(pieces.hint("shuffle_hash"), own)
    schema = T.StructType([*rest, T.StructField(text, T.ArrayType(T.StringType()))])

    def cut(text_: str, spans: list[dict]) -> list[str]:
        starts = [m.start() for m in _WORD.finditer(text_)]
        at = [0, *starts[1:], len(text_)]
        return [text_[at[s["a"]]: at[s["b"]]] for s in spans]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                cuts = [cut(t, s) for t, s in zip(batch.column(text_col).to_pylist(), batch.column(got).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(f.name) for f in rest), pa.array(cuts, pa.list_(pa.string()))], [f.name for f in schema])

    flat = joined.drop(own).mapInArrow(run, schema).withColumn(text, F.explode(text))
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col(text).alias(c))
        elif c == length_col:
            columns.append(F.char_length(text).cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"`{c}`"))
    return flat.select(*columns)
