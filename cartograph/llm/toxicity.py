"""Toxicity classifier with counterfactual regularisation.

A logistic model over the words of a text and their beginnings.  Features that
separate the labels significantly are selected and scaled by their log odds.
Training adds a penalty on the squared change of the score when the identity
terms of a labelled text are swapped for others of their group, so that a
neutral mention of a group does not raise the score.

Scale: the labelled sample has a documented bound and is broadcast as ids only;
feature counts are aggregated in Spark; the fit sees only the selected features
of the sample.  Scoring is one map over the scan with the selected weights
(at most MAX_FEATURES) and no shuffle.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import ROW, numbered, stage, text_or_empty

MAX_SAMPLE = 20_000  # labelled rows that the fit uses at most, the first by a hash of their id
MAX_FEATURES = 100_000  # selected features at most, the most significant
CACHE = 100_000  # words that a worker remembers at most
_ROWS = 256  # texts that are held as Python objects at once
MIN_DOCS, MIN_Z = 3, 3.0
PENALTY, RIDGE, STEPS, RATE = 1.0, 0.001, 300, 0.05

# Groups of identity terms that can stand for one another in a sentence.
IDENTITY_GROUPS: Sequence[Sequence[str]] = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("gay", "lesbian", "straight", "bisexual"),
    ("transgender", "cisgender"), ("immigrants", "natives"), ("disabled", "able"), ("old", "young"),
)

_WORD = re.compile(rb"[a-z\x80-\xff]+")


def _swaps(groups: Sequence[Sequence[str]]) -> dict[bytes, bytes]:
    return {a.encode(): b.encode() for g in groups for a, b in zip(g, [*g[1:], g[0]])}


def _of_word(word: bytes) -> tuple[int, ...]:
    """The word itself and its first four and five bytes, hashed to 32 bits."""
    return (zlib.crc32(word), *(zlib.crc32(b"^" + word[:n]) for n in (4, 5) if len(word) > n))


def features(words: set[bytes]) -> set[int]:
    return {f for w in words for f in _of_word(w)}


def text_words(text: str | None) -> set[bytes]:
    """Distinct runs of letters, A-Z lower-cased (every byte outside ASCII counts as a letter)."""
    return set(_WORD.findall(text.encode().lower())) if text else set()


@dataclass
class Model:
    bias: float = -20.0
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, found: set[int]) -> float:
        z = self.bias + sum(self.weights.get(f, 0.0) for f in found)
        return float(1 / (1 + np.exp(-np.clip(z, -700, 700))))


def held_out(id_col: str | Column, folds: int = 5) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", folds: int = 5, bound: int = MAX_SAMPLE) -> DataFrame:
    """(text, label) of at most ``bound`` training rows, one for each id.

    Where documents repeat an id, the text with the smallest hash stands for it; a
    label table's repeated ids take the larger label.
    """
    ids = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col, folds))
           .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("label"))
           .orderBy(F.xxhash64("_id"), "_id").limit(bound))
    rows = docs.select(F.col(id_col).alias("_id"), text_or_empty(text_col).alias("text"))
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first")
    return stage(rows.join(F.broadcast(ids), "_id").groupBy("_id", "label").agg(one).select("_id", "first.text", "label"))


def fit(sample: DataFrame, groups: Sequence[Sequence[str]] = IDENTITY_GROUPS, penalty: float = PENALTY,
        min_docs: int = MIN_DOCS, min_z: float = MIN_Z) -> Model:
    """The model of a labelled sample (``_id``, ``text``, ``label``).

    Without rows of both classes there is nothing to tell apart: the model then
    scores nearly 0, so that a filter rejects nothing.
    """
    total = sample.agg(F.count("*"), F.sum("label")).first()
    n, pos = int(total[0]), int(total[1] or 0)
    if pos in (0, n):
        return Model()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[int, list[int]] = {}
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                for f in features(text_words(text)):
                    seen.setdefault(f, [0, 0])[label] += 1
            yield pa.RecordBatch.from_pydict(
                {"feature": pa.array(list(seen), pa.int64()), "neg": pa.array([x[0] for x in seen.values()], pa.int64()),
                 "pos": pa.array([x[1] for x in seen.values()], pa.int64())})

    docs_with = F.col("pos") + F.col("neg")
    share = docs_with / F.lit(n)
    z = F.abs(F.col("pos") / F.lit(pos) - F.col("neg") / F.lit(n - pos)) / F.sqrt(
        F.greatest(share * (1 - share), F.lit(1e-12)) * F.lit(1 / pos + 1 / (n - pos)))
    chosen = (sample.select("text", "label").mapInArrow(count, "feature long, neg long, pos long")
              .groupBy("feature").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
              .where(docs_with >= min_docs).withColumn("z", z).where(F.col("z") >= min_z)
              .orderBy(F.desc("z"), "feature").limit(MAX_FEATURES).collect())
    place = {row["feature"]: i for i, row in enumerate(chosen)}
    odds = np.array([np.log((r["pos"] + 0.5) / (pos + 1)) - np.log((r["neg"] + 0.5) / (n - pos + 1)) for r in chosen])
    odds = np.clip(odds, -4, 4) if len(chosen) else np.zeros(0)
    swap = _swaps(groups)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, other = [], []
            for text in batch.column("text").to_pylist():
                ws = text_words(text)
                own.append(sorted(place[f] for f in features(ws) if f in place))
                if ws.isdisjoint(swap):
                    other.append(None)
                else:
                    swapped = features({swap.get(w, w) for w in ws})
                    other.append(sorted(place[f] for f in swapped if f in place))
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("label"), pa.array(own, kind), pa.array(other, kind)],
                ["_id", "label", "own", "other"])

    kind = sample.schema["_id"].dataType.simpleString()
    rows = (sample.mapInArrow(reduce, f"_id {kind}, label int, own array<int>, other array<int>")
            .orderBy("_id", "label", "own").collect())
    return Model(*_descend(rows, odds, penalty, n, pos, list(place)))


def _descend(rows, odds: np.ndarray, penalty: float, n: int, pos: int, names: list[int]) -> tuple[float, dict]:
    """Adam on the logistic loss, a ridge, and the squared change of the score under a swap."""
    y = np.array([r["label"] for r in rows], dtype=float)
    column = np.array([c for r in rows for c in r["own"]], dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r["own"]) for r in rows])
    pairs = [(r["own"], r["other"]) for r in rows if r["other"] is not None]
    d_column = np.array([c for a, b in pairs for c in (*a, *b)], dtype=np.int64)
    d_row = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    d_sign = np.array([s for a, b in pairs for s in (*[1.0] * len(a), *[-1.0] * len(b))])
    x = np.append(np.full(len(odds), 0.5), np.log(pos / (n - pos)))
    first, second = np.zeros_like(x), np.zeros_like(x)
    for step in range(1, STEPS + 1):
        w = x[:-1] * odds
        z = np.bincount(row, weights=w[column], minlength=len(y)) + x[-1]
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        by_feature = np.bincount(column, weights=error[row], minlength=len(odds))
        if pairs:
            change = np.bincount(d_row, weights=w[d_column] * d_sign, minlength=len(pairs))
            by_feature = by_feature + 2 * penalty * np.bincount(
                d_column, weights=d_sign * change[d_row], minlength=len(odds))
        g = np.append(odds * by_feature / n + RIDGE * x[:-1], error.mean())
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        x = x - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    w = x[:-1] * odds
    return float(x[-1]), {f: float(v) for f, v in zip(names, w) if v}


class _Chosen(dict):
    """Word to the selected features it has; emptied when it has grown to its bound."""

    def __init__(self, weights: Mapping[int, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= CACHE:
            self.clear()
        self[word] = found = tuple(f for f in _of_word(word) if f in self.weights)
        return found


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row number, id, score in [0, 1] and predicted (1 from 0.5 on) for every row and whole text.

    Defined cases: a null or empty text has the score of a text without
    selected features; null and repeated ids get a row each; an empty table
    gives an empty result; other columns of ``docs`` are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        chosen = _Chosen(m.weights)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                scores = [m.score({f for fs in map(chosen.__getitem__, text_words(t)) for f in fs})
                          for t in batch.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(ROW), batch.column("doc_id"), pa.array(scores, pa.float64())], [ROW, "doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return (rows.select(ROW, "doc_id", "text").mapInArrow(run, f"{ROW} long, doc_id {kind}, score double")
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model does not predict toxic, with all their columns, without a shuffle.

    A null or empty text has no selected feature and is judged by the bias;
    repeated rows are judged alike; an empty table gives an empty one; columns of
    any name are kept as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        chosen = _Chosen(m.weights)
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS):
                batch = whole.slice(at, _ROWS)
                clean = [m.score({f for fs in map(chosen.__getitem__, text_words(t)) for f in fs}) < 0.5
                         for t in batch.column(text_col).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
