"""Near-duplicate detection by circulant MinHash, with exact verification.

Two permutations of the 32-bit numbers give all coordinates of a signature: the
first scatters the shingles, the second is shifted circularly by one more place
for each coordinate, which is then the smallest permuted shingle.  Coordinates
are cut into bands, once in their order and once in a strided order, so that each
serves in REUSE bands.  Documents that share a band are candidates, and every
candidate link is confirmed on the full sets of word shingles.

Documents with the same words are one class before anything is paired.  In a
band's bucket, the classes are first compared with the smallest one only.  What
that leaves in different components is compared further: members outside the
bucket's largest component are taken as hubs, 4, 16, 64, … of each component,
until all of them were.  A hub of one bucket is one in all its buckets and is
done then.  No pair within a component is ever made, no bucket is capped, and two
rows meet in the first bucket they share only.  Pairs that cannot be links are
left out in the condition of the join, without becoming a row: a text shares at
most those shingles that another candidate has, which bounds its similarity, and
the sketches of a link agree in most places.  A sketch has one bit of each of 1024
coordinates, made for such rows only and packed into 16 numbers: two texts at
s = 0.75 agree in 896 bits with a standard deviation below 11, and 843 are asked
for, which a link misses with a chance of less than one in a million.

Recall of the candidates: a band of WIDTH coordinates is shared with probability
s^WIDTH, 0.18 at similarity s = 0.75; all 80 bands over 240 coordinates are
missed by fewer than 3 in a million pairs at 0.75 (simulated), fewer above.
Wide bands keep texts that only share a passage apart: two of them meet where all
six coordinates of a band fall into the passage.

Scale: signatures are one map; buckets move 16 bytes a band and class; texts are
shuffled once to pick the candidates', then by pair.  A hub with very many
partners is split by a salt, its text repeated once for each salt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import ceil, gcd, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartograph.llm.common import ROW, keep_rows, numbered, stage, text_or_empty, words
from cartograph.llm.components import components
from cartograph.llm.hashing import STEP, mix, word_hashes

SHINGLE = 5
SKETCH = 1024  # coordinates of the sketches that rows left in a mixed bucket get
DEVIATIONS = 5  # a link's sketches agree in at most so many standard deviations less than expected
BANDS, WIDTH, REUSE = 80, 6, 2
NUMERATOR, DENOMINATOR = 75, 100  # links have DENOMINATOR * intersection >= NUMERATOR * union
PER_SALT = 512  # partners of a hub that are compared in one group
_CHUNK = 1 << 15  # shingles that are permuted at once
_BYTES = 1 << 20  # text that is hashed at once

_U = np.uint64


def _shingle_hashes(word: np.ndarray) -> np.ndarray:
    """Hashes of the distinct shingles of a document's word hashes; fewer words are one shingle."""
    k = min(SHINGLE, len(word))
    total = np.full(len(word) - k + 1, len(word) if k < SHINGLE else 0, dtype=_U)
    for j in range(k):
        total = mix(total + word[j: len(word) - k + 1 + j])
    return np.unique(total)


def _signatures(shingles: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """(documents, n) 32-bit coordinates for shingle hashes whose documents begin at ``starts``."""
    scattered = (mix(shingles) >> _U(32)).astype(np.uint32)  # the first permutation
    out = np.empty((len(starts), n), dtype=np.uint32)
    y, z = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(n):
        np.add(scattered, np.uint32(k), out=y)  # the circular shift
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):  # the second permutation
            np.right_shift(y, np.uint32(shift), out=z)
            np.bitwise_xor(y, z, out=y)
            np.multiply(y, np.uint32(factor), out=y)
        out[:, k] = np.minimum.reduceat(y, starts)
    return out


def _coordinates(bands: int, width: int) -> int:
    return bands * width // REUSE


def _band_keys(signature: np.ndarray, bands: int, width: int) -> np.ndarray:
    """(documents, bands) keys: bands of the coordinates in their order, then in a strided order."""
    n = signature.shape[1]
    stride = next(s for s in range(n // 3 + 1, 2 * n + 2) if gcd(s, n) == 1)
    order = np.concatenate([np.arange(n), np.arange(n) * stride % n])
    parts = signature[:, order].reshape(len(signature), bands, width).astype(_U)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=_U), parts.shape[:2])
    for j in range(width):
        key = mix(key * STEP + parts[:, :, j])
    return key.astype(np.int64)


def _sketches(signature: np.ndarray) -> np.ndarray:
    """(documents, numbers): the lowest bit of every coordinate, 64 coordinates a number."""
    bits = np.packbits((signature & np.uint32(1)).astype(bool), axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.int64)


def _most_different(n: int) -> int:
    """In how many of ``n`` coordinates the bits of a link's sketches may differ."""
    agree = (1 + NUMERATOR / DENOMINATOR) / 2  # half of the other coordinates have the same bit by chance
    return ceil(n * (1 - agree) + DEVIATIONS * sqrt(n * agree * (1 - agree)))


def _alike(a: str, b: str, n: int = SKETCH) -> Column:
    """Whether the sketches in columns ``a`` and ``b`` can be a link's.  Without lambdas, so that it is compiled."""
    differ = F.lit(0)
    for i in range(-(-n // 64)):
        differ = differ + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return differ <= _most_different(n)


def _document_signatures(sets: list[np.ndarray], n: int) -> list[np.ndarray | None]:
    """``n`` coordinates of each document's shingle hashes; None for a document without words."""
    out: list[np.ndarray | None] = [None] * len(sets)
    group: list[int] = []

    def flush() -> None:
        if group:
            starts = np.cumsum([0, *(len(sets[i]) for i in group[:-1])])
            for i, row in zip(group, _signatures(np.concatenate([sets[i] for i in group]), starts, n)):
                out[i] = row
            group.clear()

    held = 0
    for i, s in enumerate(sets):
        if len(s) > _CHUNK:  # a long document's minima are taken piece by piece
            parts = [_signatures(s[at: at + _CHUNK], np.zeros(1, dtype=np.int64), n)
                     for at in range(0, len(s), _CHUNK)]
            out[i] = np.minimum.reduce(parts)[0]
        elif len(s):
            if held + len(s) > _CHUNK:
                flush()
                held = 0
            group.append(i)
            held += len(s)
    flush()
    return out


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               bands: int = BANDS, width: int = WIDTH) -> DataFrame:
    """Row number, id, digest of the words, number of shingles and band keys of every row."""
    rows = numbered(docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def some(texts: list[bytes]) -> list[np.ndarray]:
        """Shingle hashes of texts of single-spaced words; all their words are hashed together."""
        full = [t for t in texts if t]
        if not full:
            return [np.empty(0, dtype=_U)] * len(texts)
        hashes = word_hashes(b" ".join(full))
        ends = np.cumsum([t.count(b" ") + 1 for t in full])
        parts = iter(np.split(hashes, ends[:-1]))
        return [_shingle_hashes(next(parts)) if t else np.empty(0, dtype=_U) for t in texts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts, sets, held, size = [], [], [], 0
                digests = []
                for t in batch.column("text").to_pylist():
                    text = b" ".join(words(t))
                    digests.append(hashlib.sha256(text).digest())
                    held.append(text)
                    size += len(text)
                    if size > _BYTES:
                        sets += some(held)
                        held, size = [], 0
                sets += some(held)
                of_rows = _document_signatures(sets, _coordinates(bands, width))
                full = [x for x in of_rows if x is not None]
                keys = iter(_band_keys(np.array(full), bands, width) if full else ())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(ROW), batch.column("doc_id"), pa.array(digests, pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([[] if x is None else next(keys) for x in of_rows], pa.list_(pa.int64()))],
                    [ROW, "doc_id", "words", "n_shingles", "bands"])

    return rows.mapInArrow(run, f"{ROW} long, doc_id {kind}, words binary, n_shingles long, bands array<long>")


def shingles(text: str | None) -> set[tuple[bytes, ...]]:
    """Distinct five-word shingles; fewer words are one shingle; without words, none."""
    w = words(text)
    if len(w) < SHINGLE:
        return {tuple(w)} if w else set()
    return set(zip(*(w[i:] for i in range(SHINGLE))))


def _confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` that are links on their full sets; a hub's text comes before its partners'.

    ``n`` of a pair bounds the hub's partners in the bucket it comes from: they are
    split into groups of about PER_SALT, each with the hub's text.
    """
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.ceil(F.col("n") / PER_SALT)).alias("salt"))
    partners = salted.join(texts.withColumnRenamed(ROW, "a"), "a").select("b", "salt", "a", "text")
    hubs = (salted.select("b", "salt").distinct().join(texts.withColumnRenamed(ROW, "b"), "b")
            .select("b", "salt", F.lit(None).cast("long").alias("a"), "text"))
    dealt = (hubs.unionByName(partners).repartition("b", "salt")
             .sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub: set[tuple[bytes, ...]] = set()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                a, b = [], []
                for x, y, text in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "text"))):
                    own = shingles(text)
                    if x is None:
                        hub = own
                        continue
                    both = len(hub & own)
                    if DENOMINATOR * both >= NUMERATOR * (len(hub) + len(own) - both):
                        a.append(x)
                        b.append(y)
                yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return dealt.mapInArrow(run, "a long, b long").select(F.col("a").alias("u"), F.col("b").alias("v"))


def _shareable(rows: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """(row, size, can) of ``rows``: how many shingles each has, and how many of them another of the rows has.

    Two texts can't share more than the smaller ``can``, which bounds their
    similarity.  Shingles are compared by hash here: a collision only raises ``can``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                own = [_shingle_hashes(word_hashes(b" ".join(words(t)))) for t in batch.column("text").to_pylist()]
                rows_ = np.repeat(batch.column(ROW).to_numpy(), [len(x) for x in own])
                yield pa.RecordBatch.from_pydict({ROW: pa.array(rows_), "hash": pa.array(np.concatenate(own).astype(np.int64))})

    hashes = texts.join(rows, ROW, "left_semi").mapInArrow(run, f"{ROW} long, hash long")
    single = hashes.groupBy("hash").agg(F.count("*").alias("n"), F.min(ROW).alias(ROW)).where("n = 1")
    alone = single.groupBy(ROW).agg(F.count("*").alias("alone"))
    sizes = found.select(ROW, F.col("n_shingles").alias("size")).join(rows, ROW, "left_semi")
    return sizes.join(alone, ROW, "left").select(ROW, "size", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("can"))


def _sketched(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """(row, sketch) of ``rows``, from their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = [_shingle_hashes(word_hashes(b" ".join(words(t)))) for t in batch.column("text").to_pylist()]
                made = _sketches(np.array(_document_signatures(sets, SKETCH)))
                yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(list(made), pa.list_(pa.int64()))], [ROW, "sketch"])

    return texts.join(rows, ROW, "left_semi").mapInArrow(run, f"{ROW} long, sketch array<long>")


def _pairs(rows: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) of a row and a hub, the smaller one b, with the largest bucket ``n`` they met in."""
    return (rows.select(F.greatest(ROW, "hub").alias("a"), F.least(ROW, "hub").alias("b"), "n")
            .groupBy("a", "b").agg(F.max("n").alias("n")))


def _placed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with the component each is in so far."""
    return (members.join(labels.withColumnRenamed("node", ROW), ROW, "left")
            .withColumn("label", F.coalesce("label", ROW)))


def _mixed(placed: DataFrame) -> DataFrame:
    """(key, main): buckets with members of several components, and the one with the most of them."""
    parts = placed.groupBy("key", "label").agg(F.count("*").alias("part"))
    return (parts.groupBy("key").agg(F.count("*").alias("parts"), F.max(F.struct("part", "label")).alias("most"))
            .where("parts > 1").select("key", F.col("most.label").alias("main")))


def _class_labels(found: DataFrame, classes: DataFrame, docs: DataFrame, text_col: str) -> DataFrame:
    """(node, label): classes, named by their first row, that are linked with another class."""
    first = classes.select(F.col("node").alias(ROW))
    banded = found.join(first, ROW, "left_semi").select(ROW, F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n"), F.min(ROW).alias("hub")).where("n > 1")
    members = stage(banded.join(shared, "key"))
    rows = numbered(docs.select(text_or_empty(text_col).alias("text")))
    texts = stage(rows.join(members.select(ROW).distinct().hint("shuffle_hash"), ROW).select(ROW, "text"))
    tried = stage(_pairs(members.where(F.col(ROW) != F.col("hub"))))
    links = stage(_confirmed(tried, texts))
    labels = stage(components(links))
    mixed = _mixed(_placed(members, labels)).select("key")  # a bucket of one component stays one
    left = stage(members.select("key", ROW, "n").join(mixed, "key", "left_semi"))
    bounds = _shareable(left.select(ROW).distinct(), found, texts)
    able = stage(bounds.where(DENOMINATOR * F.col("can") >= NUMERATOR * F.col("size")))  # the others are like no text here
    of_row = left.groupBy(ROW).agg(F.collect_set("key").alias("keys")).join(able, ROW).join(_sketched(able.select(ROW), texts), ROW)
    members = stage(of_row.join(left, ROW).withColumn("done", F.lit(False)))
    hubs_each = 4
    while True:
        placed = stage(_placed(members, labels))
        parts = placed.groupBy("key", "label").agg(F.count("*").alias("part"))
        minor = stage(parts.join(_mixed(placed), "key").where(F.col("label") != F.col("main")).drop("main"))
        most = minor.agg(F.max("part")).first()[0]
        if most is None:
            return labels
        chosen = (placed.where("not done").join(minor, ["key", "label"])
                  .where(F.pmod(F.xxhash64(ROW, "key"), "part") < hubs_each)  # hubs_each of a part, by a hash
                  .select(ROW, F.lit(True).alias("chosen")).distinct())
        placed = stage(placed.join(chosen, ROW, "left").withColumn("chosen", F.coalesce("chosen", F.lit(False))))
        hubs = placed.where("chosen").select("key", *(F.col(c).alias(f"hub_{c}") for c in ("label", "size", "can", "sketch", "keys")),
                                             F.col(ROW).alias("hub"))
        most_shared = F.least("can", "hub_can")
        met = placed.where("not done").join(hubs, "key").where(
            (F.col("label") != F.col("hub_label"))
            & (~F.col("chosen") | (F.col(ROW) < F.col("hub")))  # two hubs meet once
            & (DENOMINATOR * most_shared >= NUMERATOR * (F.col("size") + F.col("hub_size") - most_shared))
            & _alike("sketch", "hub_sketch")
            & (F.col("key") == F.array_min(F.array_intersect("keys", "hub_keys"))))  # in the first bucket they share
        new = stage(_pairs(met).join(tried.select("a", "b"), ["a", "b"], "left_anti"))
        if new.head(1):
            more = stage(_confirmed(new, texts))
            if more.head(1):
                links = links.unionByName(more)
                labels = stage(components(links))
            tried = tried.unionByName(new)
        if most <= hubs_each:
            return labels
        hubs_each *= 4
        members = placed.withColumn("done", F.col("done") | F.col("chosen")).drop("label", "chosen")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    bands: int = BANDS, width: int = WIDTH) -> DataFrame:
    """Row number, id, n_shingles, component_id, kept and first_row for every row of ``docs``.

    ``component_id`` is the smallest id in the row's component and ``kept`` says
    that it is the row's own; ``first_row`` is true for one row of each
    component, the first with that id.  Defined cases: a null, empty or blank
    text has no shingles and is linked with nothing; fewer than five words are
    one shingle; rows with the same words are linked, also where they repeat an
    id; null ids are larger than any other; an empty table gives an empty
    result; other columns are ignored.  ``docs`` must be a stored table.
    """
    found = stage(signatures(docs, id_col, text_col, bands, width))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(ROW).alias("row")))
    classes = stage(found.where("n_shingles > 0").groupBy("words").agg(F.min(ROW).alias("node"), least.alias("least")))
    labels = _class_labels(found, classes, docs, text_col)
    labelled = classes.join(labels, "node", "left").select("words", "least", F.coalesce("label", "node").alias("label"))
    best = labelled.groupBy("label").agg(F.min("least").alias("best"))
    of_words = labelled.select("words", "label").join(best, "label").select("words", "best")
    out = found.where("n_shingles > 0").select(ROW, "doc_id", "n_shingles", "words").join(of_words, "words").select(
        ROW, "doc_id", "n_shingles", F.col("best.id").alias("component_id"), (F.col("best.row") == F.col(ROW)).alias("first_row"))
    blank = found.where("n_shingles = 0").select(
        ROW, "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("first_row"))
    return out.unionByName(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without all but one row of each component, with all their columns."""
    return keep_rows(docs, near_duplicates(docs, id_col, text_col, **options).where("not first_row"), "left_anti")
