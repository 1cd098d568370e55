"""Language-model scoring by a hashed maximum-entropy model with a class-factored softmax.

p(word | history) = p(class | history) * p(word | class).  The class model is a
softmax whose features are hashed n-grams and skips of the history: a bias, the
last word, the one before it, the one before that, and the pair of the last two.
Within a class the maximum-entropy solution for a bias alone is the relative
frequency, smoothed as in the unigram base; one unknown word belongs to every
class.  So the probabilities of all words and the unknown ones sum to one.

Classes need no lookup of the word: the most frequent words are classes of their
own, and every other word belongs to the class of its first letters.  These are
clustered by which frequent word comes before them.

Training is one pass over the training documents in ROUNDS parts.  In each
round every task starts from the shared weights, takes gradient steps over its
own documents, and sends the change of the rows it touched; changes are averaged
by how many tokens touched the row.

Scale: the vocabulary is counted and joined by 64-bit word hashes and never
leaves Spark.  Only bounded tables are broadcast: HEADS frequent words, the
weights (ROWS * classes floats), LETTERS letter groups.  Words outside the
broadcast heads are joined with their counts by a shuffle of 16 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import ROW, numbered, stage, text_or_empty
from cartograph.llm.hashing import STEP, hashed_words, mix
from cartograph.llm.toxicity import held_out

HEADS = 1 << 17  # frequent words whose counts are broadcast
SINGLES = 15  # frequent words that are classes of their own
TAIL_CLASSES = 32
LETTERS = 4096  # groups of first letters
ROWS = 1 << 14  # hashed feature rows of the weights
ROUNDS = 3
BATCH = 8192
RATE = 0.3
ADD = 0.1  # smoothing of the base and of the words of a class

_U = np.uint64
END = int(mix(np.array([1], dtype=_U)).astype(np.int64)[0])  # the hash of the end token
_FEATURES = 4
_DOCS, _CHARS = 64, 1 << 20  # documents and characters that are hashed together


def _tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (int64) and letter groups of all tokens, each text's end included, and where the texts begin."""
    found, letters, counts = hashed_words([t.encode() if t else b"" for t in texts])
    sizes = counts + 1
    starts = np.cumsum(sizes) - sizes
    hashes, group = np.full(int(sizes.sum()), END, dtype=np.int64), np.zeros(int(sizes.sum()), dtype=np.int64)
    inside = np.ones(len(hashes), dtype=bool)
    inside[starts + counts] = False
    hashes[inside] = found.astype(np.int64)
    group[inside] = (mix(letters) % _U(LETTERS)).astype(np.int64)
    return hashes, group, starts


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Slices of a batch with their tokens, bounded in documents and in characters (but for one longer text)."""
    texts, at, size = batch.column("text").to_pylist(), 0, 0
    for i, text in enumerate(texts, 1):
        size += len(text)
        if i - at == _DOCS or size > _CHARS or i == len(texts):
            yield batch.slice(at, i - at), *_tokens(texts[at:i])
            at, size = i, 0


def _shifted(hashes: np.ndarray, starts: np.ndarray, by: int) -> np.ndarray:
    """Each token's ``by``-th predecessor in its text; 0 before the first."""
    out = np.zeros(len(hashes), dtype=_U)
    out[by:] = hashes[:-by].astype(_U)
    for i in range(by):
        at = starts + i
        out[at[at < len(out)]] = 0
    return out


def _features(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(tokens, 4) weight rows of the last word, two skips and the last pair; row 0 is the bias."""
    one, two, three = (_shifted(hashes, starts, i) for i in (1, 2, 3))
    found = (mix(one + _U(11)), mix(two + _U(22)), mix(three + _U(33)), mix(one * STEP + two + _U(44)))
    return np.stack([(f % _U(ROWS - 1)).astype(np.int64) + 1 for f in found], axis=1)


@dataclass
class Classes:
    """End, the single words and the letter groups' classes."""

    singles: np.ndarray  # sorted hashes
    of_single: np.ndarray
    of_group: np.ndarray
    n: int

    def of(self, hashes: np.ndarray, group: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.singles, hashes), len(self.singles) - 1)
        return np.where(self.singles[at] == hashes, self.of_single[at], self.of_group[group])


@dataclass
class LanguageModel:
    train_tokens: int
    vocabulary: int
    classes: Classes
    log_mass: np.ndarray  # log10 of each class's smoothed count
    weights: np.ndarray
    head_hashes: np.ndarray  # sorted
    head_counts: np.ndarray
    counts: DataFrame  # every training word: hash, c


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    own = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    return numbered(own).withColumn("held_out", held_out("doc_id", 10))


def _vocabulary(train: DataFrame) -> DataFrame:
    """(hash, letters, c) of every training word: hashes are counted in each task, then summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            both = np.concatenate([h for h, _ in held]), np.concatenate([g for _, g in held])
            held.clear()
            found, first, c = np.unique(both[0], return_index=True, return_counts=True)
            return pa.RecordBatch.from_pydict({"hash": pa.array(found), "letters": pa.array(both[1][first].astype(np.int32)),
                                               "c": pa.array(c.astype(np.int64))})

        for batch in batches:
            for _, hashes, group, _ in _pieces(batch):
                held.append((hashes, group))
                size += len(hashes)
                if size > 1 << 22:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return stage(train.select("text").mapInArrow(count, "hash long, letters int, c long")
                 .groupBy("hash").agg(F.min("letters").alias("letters"), F.sum("c").alias("c")))


def _heads(counts: DataFrame):
    """The most frequent words, at most HEADS: those above a count that a histogram of the counts gives."""
    step = F.floor(F.log2("c") * 16)
    held, least = 0, None
    for r in sorted(counts.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):  # 16 steps a doubling
        held += r["count"]
        if held > HEADS:
            break
        least = r["step"]
    chosen = counts.where(F.lit(False) if least is None else step >= least)
    return chosen.select("hash", "c").toPandas().sort_values("hash")


def _grouped(before: np.ndarray, mass: np.ndarray, n: int) -> np.ndarray:
    """Clusters of letter groups by what comes before them (k-means on roots of shares, weighted by mass)."""
    shares = np.sqrt((before + 0.01) / (before + 0.01).sum(axis=1, keepdims=True))
    weight = mass + 1e-9
    centres = [shares[np.argmax(weight)]]
    far = ((shares - centres[0]) ** 2).sum(axis=1)
    for _ in range(1, n):
        centres.append(shares[np.argmax(far * weight)])
        far = np.minimum(far, ((shares - centres[-1]) ** 2).sum(axis=1))
    centre = np.array(centres)
    for _ in range(20):
        near = (shares @ centre.T * 2 - (centre**2).sum(axis=1)).argmax(axis=1)
        total = np.bincount(near, weights=weight, minlength=n)
        for d in range(shares.shape[1]):
            sums = np.bincount(near, weights=weight * shares[:, d], minlength=n)
            centre[:, d] = np.where(total > 0, sums / np.maximum(total, 1e-12), centre[:, d])
    return near


def _classes(train: DataFrame, singles: list[int]) -> Classes:
    order = np.array(sorted([END, *singles]), dtype=np.int64)
    ranks = {h: i + 1 for i, h in enumerate(singles)} | {END: 0}
    of_single = np.array([ranks[int(h)] for h in order], dtype=np.int64)
    width = len(singles) + 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS * width, dtype=np.int64)
        one = Classes(order, of_single, np.full(LETTERS, width - 1), width)
        for batch in batches:
            for _, hashes, group, starts in _pieces(batch):
                own = one.of(hashes, group)
                last = np.zeros_like(own)
                last[1:] = own[:-1]
                last[starts] = 0
                tail = own == width - 1
                total += np.bincount(group[tail] * width + last[tail], minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": pa.array(used), "n": pa.array(total[used])})

    found = (train.select("text").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))).toPandas()
    table = np.zeros(LETTERS * width)
    table[found["cell"]] = found["n"]
    table = table.reshape(LETTERS, width)
    near = _grouped(table, table.sum(axis=1), TAIL_CLASSES)
    return Classes(order, of_single, near + len(singles) + 1, len(singles) + 1 + TAIL_CLASSES)


def _logits(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = weights.take(rows[:, 0], axis=0)
    out += weights[0]
    for i in range(1, _FEATURES):
        out += weights.take(rows[:, i], axis=0)
    out -= out.max(axis=1, keepdims=True)
    return out


def _steps(weights: np.ndarray, seen: np.ndarray, power: np.ndarray, rows: np.ndarray, own: np.ndarray) -> None:
    """Gradient steps over the tokens in batches; ``power`` holds each row's summed squared gradient."""
    for at in range(0, len(own), BATCH):
        r, y = rows[at: at + BATCH], own[at: at + BATCH]
        p = np.exp(_logits(weights, r))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        flat = np.ascontiguousarray(r.T).ravel()
        counts = np.bincount(flat, minlength=ROWS)
        counts[0] = len(y)  # the bias
        used = np.flatnonzero(counts)
        error = np.tile(p.T.astype(np.float64), (1, _FEATURES))
        sums = np.stack([np.bincount(flat, weights=e, minlength=ROWS) for e in error])
        sums[:, 0] = p.sum(axis=0)
        g = sums[:, used].T.astype(np.float32)
        power[used] += (g * g).mean(axis=1)
        weights[used] -= (RATE / np.sqrt(power[used] + 1e-6)).astype(np.float32)[:, None] * g
        seen += counts


_BLOCKS = 64


def _trained(train: DataFrame, classes: Classes) -> np.ndarray:
    context = train.sparkSession.sparkContext
    weights = np.zeros((ROWS, classes.n), dtype=np.float32)
    power = np.full(ROWS, 1.0)
    for part in range(ROUNDS):
        shared = context.broadcast((weights, power, classes))

        def learn(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            begin, summed, kinds = shared.value
            own, own_power, seen = begin.copy(), summed.copy(), np.zeros(ROWS, dtype=np.int64)
            for batch in batches:
                for _, hashes, group, starts in _pieces(batch):
                    _steps(own, seen, own_power, _features(hashes, starts), kinds.of(hashes, group))
            if seen.any():
                change = (own - begin) * seen[:, None]
                grown = (own_power - summed) * seen
                each = ROWS // _BLOCKS
                for b in range(_BLOCKS):
                    at = slice(b * each, (b + 1) * each)
                    yield pa.RecordBatch.from_pydict(
                        {"block": pa.array([b]), "seen": pa.array([seen[at].tobytes()]), "power": pa.array([grown[at].tobytes()]),
                         "change": pa.array([change[at].astype(np.float32).tobytes()])})

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = {"seen": np.int64, "power": np.float64, "change": np.float32}
            sums: dict[int, dict[str, np.ndarray]] = {}
            for batch in batches:
                for row in batch.to_pylist():
                    got = {k: np.frombuffer(row[k], dtype=t).astype(np.float64) for k, t in kinds.items()}
                    if row["block"] in sums:
                        for k, v in got.items():
                            sums[row["block"]][k] += v
                    else:
                        sums[row["block"]] = got
            for b, got in sums.items():
                yield pa.RecordBatch.from_pydict({"block": pa.array([b]), **{
                    k: pa.array([v.tobytes()]) for k, v in got.items()}})

        schema = "block long, seen binary, power binary, change binary"
        chosen = train.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(ROUNDS)) == part).select("text")
        sums = chosen.mapInArrow(learn, schema).repartition("block").mapInArrow(add_up, schema).collect()
        weights, power = weights.copy(), power.copy()
        each = ROWS // _BLOCKS
        for row in sums:  # one row for each block of the weights
            at = slice(row["block"] * each, (row["block"] + 1) * each)
            seen = np.maximum(np.frombuffer(row["seen"]), 1)
            weights[at] += (np.frombuffer(row["change"]).reshape(each, -1) / seen[:, None]).astype(np.float32)
            power[at] += np.frombuffer(row["power"]) / seen
        shared.unpersist()
    return weights


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> LanguageModel:
    """The model of the documents whose crc32(id) modulo 10 is not 0; a null id counts as training."""
    train = _documents(docs, id_col, text_col).where("not held_out")
    counts = _vocabulary(train)
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    heads = _heads(counts)
    first = counts.orderBy(F.desc("c"), "hash").limit(SINGLES + 1).select("hash").collect()
    singles = [r["hash"] for r in first if r["hash"] != END][:SINGLES]
    classes = _classes(train, singles)
    shared = docs.sparkSession.sparkContext.broadcast(classes)

    def mass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, total = shared.value, np.zeros(shared.value.n)
        for batch in batches:
            own = kinds.of(batch.column("hash").to_numpy(), batch.column("letters").to_numpy())
            total += np.bincount(own, weights=batch.column("c").to_numpy() + ADD, minlength=kinds.n)
        yield pa.RecordBatch.from_pydict({"class": pa.array(np.arange(kinds.n)), "mass": pa.array(total)})

    sums = counts.mapInArrow(mass, "class long, mass double").groupBy("class").agg(F.sum("mass").alias("mass")).toPandas()
    masses = np.full(classes.n, ADD)
    masses[sums["class"]] += sums["mass"]
    return LanguageModel(int(n or 0), int(v), classes, np.log10(masses), _trained(train, classes),
                         heads["hash"].to_numpy(dtype=np.int64), heads["c"].to_numpy(dtype=np.int64), counts.select("hash", "c"))


def score(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row number, id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Defined cases: a null or blank text has one token, its end; null and
    repeated ids get a row each; with nothing to train on, every word is unknown;
    an empty table gives an empty result; other columns are ignored.  ``docs``
    must be a stored table.
    """
    rows = _documents(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weights, model.classes, model.log_mass, model.head_hashes, np.log10(model.head_counts + ADD)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, classes, log_mass, heads, log_heads = shared.value
        for batch in batches:
            for part, hashes, group, starts in _pieces(batch):
                own, rows_ = classes.of(hashes, group), _features(hashes, starts)
                of_class = np.empty(len(own))
                for at in range(0, len(own), BATCH):
                    z = _logits(weights, rows_[at: at + BATCH])
                    y = own[at: at + BATCH]
                    of_class[at: at + BATCH] = z[np.arange(len(y)), y] - np.log(np.exp(z).sum(axis=1))
                if len(heads):
                    place = np.minimum(np.searchsorted(heads, hashes), len(heads) - 1)
                    is_head = heads[place] == hashes
                    counted = np.where(is_head, log_heads[place], 0.0)
                else:
                    is_head, counted = np.zeros(len(own), dtype=bool), np.zeros(len(own))
                ends = np.append(starts[1:], len(hashes))
                rest = pa.array(hashes[~is_head])
                offsets = np.concatenate([[0], np.cumsum(np.add.reduceat(~is_head, starts, dtype=np.int64))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(ROW), part.column("doc_id"), part.column("held_out"), pa.array(ends - starts),
                     pa.array(np.add.reduceat(of_class / np.log(10) - log_mass[own], starts)),
                     pa.array(np.add.reduceat(counted, starts)), pa.array(np.add.reduceat(is_head, starts, dtype=np.int64)),
                     pa.ListArray.from_arrays(offsets, rest)],
                    [ROW, "doc_id", "held_out", "n_tokens", "of_class", "of_heads", "n_heads", "rest"])

    found = stage(rows.select(ROW, "doc_id", "held_out", "text").mapInArrow(
        run, f"{ROW} long, doc_id {kind}, held_out boolean, n_tokens long, of_class double, of_heads double, "
             "n_heads long, rest array<long>"))
    rest = found.select(ROW, F.explode("rest").alias("hash")).join(model.counts, "hash", "left")
    sums = rest.groupBy(ROW).agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + ADD)).alias("of_rest"), F.count("c").alias("n_rest"))
    counted = F.col("of_heads") + F.coalesce("of_rest", F.lit(0.0))
    norm = float(np.log10(model.train_tokens + ADD * (model.vocabulary + 1)))
    return found.drop("rest").join(sums, ROW, "left").select(
        ROW, "doc_id", "held_out", "n_tokens", (F.col("n_heads") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * norm).alias("base_score"), (counted + F.col("of_class")).alias("score"))
