"""Quality classifier by importance resampling.

Two bag models over hashed word n-grams (single words and pairs) are counted:
one of target text, the labelled good documents, one of all raw text.  A
document's log importance weight is the mean log ratio of its n-grams under the
two models, taken for a text of STANDARD n-grams so that long and short texts
compare.  Adding Gumbel noise and keeping the k largest draws k documents
without replacement in proportion to their weights.

Scale: raw counts cover all documents; each task adds its n-grams up in two
vectors of 2^BITS and sends only the sums.  Labelled ids have a documented bound
and are broadcast.  The k largest come from a distributed ranking.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.functions.ranking import global_row_number
from cartograph.llm.common import ROW, numbered, text_or_empty, words
from cartograph.llm.hashing import mix, word_hashes
from cartograph.llm.toxicity import held_out

BITS = 18
STANDARD = 1000
SMOOTHING = 1.0
MAX_TARGET = 50_000  # labelled documents that the target model counts at most, the first by a hash of their id
SEED = 3

_U = np.uint64


def ngrams(text: str | None, bits: int = BITS) -> np.ndarray:
    """Buckets of the words and word pairs of a text, with repeats."""
    joined = b" ".join(words(text))
    if not joined:
        return np.empty(0, dtype=np.int64)
    w = word_hashes(joined)
    both = np.concatenate([mix(w + _U(1)), mix(w[:-1] * _U(3) + w[1:] + _U(2))])
    return (both >> _U(64 - bits)).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", bits: int = BITS, bound: int = MAX_TARGET) -> tuple[np.ndarray, float]:
    """Log ratio of every bucket, and the share of good documents among the training labels.

    Labels of the held-out fold (crc32 of the id modulo 5 is 0) are not used.
    Without labelled good documents all ratios are 0 and the share is 1.
    """
    known = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("int").alias("good")))
    n, good = known.agg(F.count("*"), F.sum("good")).first()
    if not good:
        return np.zeros(1 << bits), 1.0
    target = (known.where("good = 1").orderBy(F.xxhash64("_id"), "_id").limit(bound)
              .select("_id", F.lit(True).alias("target")))
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    marked = rows.join(F.broadcast(target), "_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, own = np.zeros(1 << bits, dtype=np.int64), np.zeros(1 << bits, dtype=np.int64)

        def add(held: list[np.ndarray], to: np.ndarray) -> None:
            if held:
                to += np.bincount(np.concatenate(held), minlength=1 << bits)

        for batch in batches:
            held, wanted, size = [], [], 0
            for text, is_target in zip(batch.column("text").to_pylist(), batch.column("target").to_pylist()):
                found = ngrams(text, bits)
                held.append(found)
                size += len(found)
                if is_target:
                    wanted.append(found)
                if size > 1 << 22:
                    add(held, raw)
                    add(wanted, own)
                    held, wanted, size = [], [], 0
            add(held, raw)
            add(wanted, own)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(used), "raw": pa.array(raw[used]), "target": pa.array(own[used])})

    sums = (marked.mapInArrow(count, "bucket long, raw long, target long")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))).toPandas()
    raw, own = np.full(1 << bits, SMOOTHING), np.full(1 << bits, SMOOTHING)
    raw[sums["bucket"]] += sums["raw"]
    own[sums["bucket"]] += sums["target"]
    return np.log(own / own.sum()) - np.log(raw / raw.sum()), float((good + 0.5) / (n + 0.5))


def weigh(docs: DataFrame, ratio: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
          seed: int = SEED) -> DataFrame:
    """Row number, id, log_weight and gumbel_key (log_weight with Gumbel noise drawn from the id) of every row.

    Defined cases: a text without words has weight 0 in logarithms; null and
    repeated ids get a row each, repeated ids the same noise; an empty table
    gives an empty result; other columns are ignored.
    """
    bits = int(len(ratio)).bit_length() - 1
    shared = docs.sparkSession.sparkContext.broadcast(ratio.astype(np.float32))
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [ngrams(t, bits) for t in batch.column("text").to_pylist()]
            weights = [STANDARD * float(shared.value[x].mean(dtype=np.float64)) if len(x) else 0.0 for x in found]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), batch.column("doc_id"), pa.array(weights, pa.float64())],
                                             [ROW, "doc_id", "log_weight"])

    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / F.lit(float(1 << 53))
    return (rows.select(ROW, "doc_id", "text").mapInArrow(run, f"{ROW} long, doc_id {kind}, log_weight double")
            .withColumn("gumbel_key", F.col("log_weight") - F.log(-F.log(u))))


def resample(weighed: DataFrame, k: int) -> DataFrame:
    """``weighed`` with ``kept``: the k rows of the largest keys (ties by row number); all rows where k is larger."""
    ranked = global_row_number(weighed, [F.desc("gumbel_key"), F.asc(ROW)], "_rank")
    return ranked.withColumn("kept", F.col("_rank") <= k).drop("_rank")
