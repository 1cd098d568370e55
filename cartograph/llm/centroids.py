"""Centroid clustering (Lloyd's rounds in integers) with PCA-rotated filtering.

Vectors are integers.  A rotation onto their principal axes, fitted on all of
them, is stored beside each one as its leading coordinates and the norm of the
rest.  For a vector x and a centroid c, the squared distance of the leading
coordinates plus the squared difference of the two norms is a lower bound of
|x - c|², because a rotation keeps distances and the rest of x and the rest of c
are at least as far apart as their norms.  The exact integer distance to the
centroid with the least bound is then a limit: only centroids whose bound,
less a margin for rounding, does not exceed it are verified in integers.  The
rotation decides how many survive, never the result.

Scale: vectors are read once to sum their products, once to be stored rotated,
and once in each round; nothing is shuffled but one row for each task and
centroid.  The driver holds the sums of products (dimensions squared) and the
centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartograph.llm.common import stage

DIMENSIONS, SCALE = 64, 64
CENTROIDS, ROUNDS = 16, 3
LEADING = 16  # rotated coordinates that are stored; the others are one norm
MARGIN = 1e-6  # of the squared norms: far above what rounding to 32 and 64 bits can change a bound by
LARGEST = 1 << 26  # components beyond have squared distances that do not fit a long
SALTS = 64
_ROWS = 4096


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the usable vectors as integers ``floor(scale * x)``.

    Usable are vectors with exactly ``dimensions`` components, none of them null
    or non-finite.  A component beyond 2^26 raises: its distances do not fit a long.
    """
    x = F.col(vector_col)
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf")))
    usable = vectors.where((F.size(x) == dimensions) & F.forall(x, finite))

    def whole(e: Column) -> Column:
        scaled = F.floor(e.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(e.cast("double")) <= LARGEST / scale, scaled.cast("int")).otherwise(
            F.raise_error(F.lit(f"a component beyond {LARGEST}/{scale}: squared distances would not fit a long")).cast("int"))

    return usable.select(F.col(id_col).alias("vec_id"), F.transform(x, whole).alias("v"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            yield batch.slice(at, _ROWS)


def rotation(ints: DataFrame, dimensions: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes) of all vectors: the principal axes as columns, the one of largest variance first."""
    width = dimensions + 1

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in _slices(batches):
            x = np.ones((batch.num_rows, width))
            x[:, 1:] = _matrix(batch.column("v"), dimensions)
            total += x.T @ x
        if total[0, 0]:
            yield pa.RecordBatch.from_pydict({"cell": np.arange(width * width, dtype=np.int32), "n": total.ravel()})

    sums = ints.select("v").mapInArrow(products, "cell int, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    if not sums:
        return np.zeros(dimensions), np.eye(dimensions)
    total = np.zeros(width * width)
    total[[r["cell"] for r in sums]] = [r["n"] for r in sums]
    total = total.reshape(width, width)
    n, mean = total[0, 0], total[0, 1:] / total[0, 0]
    _, axes = np.linalg.eigh(total[1:, 1:] / n - np.outer(mean, mean))
    return mean, np.ascontiguousarray(axes[:, ::-1])


def _rotated(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> tuple[np.ndarray, np.ndarray]:
    y = (x - mean) @ axes
    return y[:, :leading], np.sqrt((y[:, leading:] ** 2).sum(axis=1))


def indexed(ints: DataFrame, mean: np.ndarray, axes: np.ndarray, leading: int = LEADING) -> DataFrame:
    """(vec_id, v, lead, rest): every vector with its leading rotated coordinates and the norm of the others."""
    dimensions = len(mean)
    kind = ints.schema["vec_id"].dataType.simpleString()

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            lead, rest = _rotated(_matrix(batch.column("v"), dimensions).astype(np.float64), mean, axes, leading)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * lead.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("v"),
                 pa.ListArray.from_arrays(ends, lead.astype(np.float32).ravel()), pa.array(rest.astype(np.float32))],
                ["vec_id", "v", "lead", "rest"])

    return ints.mapInArrow(rotate, f"vec_id {kind}, v array<int>, lead array<float>, rest float")


def nearest(x: np.ndarray, lead: np.ndarray, rest: np.ndarray, centroids: np.ndarray,
            c_lead: np.ndarray, c_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centroid, squared distance, exact distances computed) of each row of ``x``; of equal ones the smaller number."""
    exact = lambda i, j: ((x[i] - centroids[j]) ** 2).sum(axis=1)  # noqa: E731  64-bit integers
    own, theirs = (lead**2).sum(axis=1) + rest**2, (c_lead**2).sum(axis=1) + c_rest**2
    bound = (lead**2).sum(axis=1)[:, None] + (c_lead**2).sum(axis=1) - 2 * lead @ c_lead.T + (rest[:, None] - c_rest) ** 2
    bound -= MARGIN * (own[:, None] + theirs + 1)
    rows = np.arange(len(x))
    guess = bound.argmin(axis=1)
    limit = exact(rows, guess)
    alive = bound <= limit[:, None]
    alive[rows, guess] = False
    i, j = np.nonzero(alive)
    found = np.full(bound.shape, np.iinfo(np.int64).max)
    found[rows, guess] = limit
    for at in range(0, len(i), 1 << 15):
        some = slice(at, at + (1 << 15))
        found[i[some], j[some]] = exact(i[some], j[some])
    best = found.argmin(axis=1)  # the first of equal ones
    return best, found[rows, best], 1 + alive.sum(axis=1)


def _assigning(centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int):
    """A function from a batch of indexed vectors to (integers, centroid, distance, exact distances)."""
    c_lead, c_rest = _rotated(centroids.astype(np.float64), mean, axes, leading)

    def run(batch: pa.RecordBatch):
        x = _matrix(batch.column("v"), centroids.shape[1]).astype(np.int64)
        lead = _matrix(batch.column("lead"), leading).astype(np.float64)
        rest = batch.column("rest").to_numpy(zero_copy_only=False).astype(np.float64)
        return x, *nearest(x, lead, rest, centroids, c_lead, c_rest)

    return run


def _moved(index: DataFrame, centroids: np.ndarray, mean: np.ndarray, axes: np.ndarray, leading: int) -> np.ndarray:
    """The centroids after one round: each the componentwise floor of its vectors' mean; empty ones stay."""
    k, dimensions = centroids.shape
    assign = _assigning(centroids, mean, axes, leading)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dimensions + 1), dtype=np.int64)
        for batch in _slices(batches):
            x, cluster, _, _ = assign(batch)
            member = np.zeros((k, len(x)))
            member[cluster, np.arange(len(x))] = 1
            # Products of ones and integers below 2^26, at most _ROWS of them: exact in doubles.
            total[:, 0] += member.sum(axis=1).astype(np.int64)
            total[:, 1:] += (member @ x.astype(np.float64)).astype(np.int64)
        full = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), *(pa.array(total[full, i]) for i in range(dimensions + 1))],
            ["cluster", "n", *(f"s{i}" for i in range(dimensions))])

    names = ["n", *(f"s{i}" for i in range(dimensions))]
    parts = index.mapInArrow(sums, "cluster int, " + ", ".join(f"{c} long" for c in names))
    add = [F.sum(c).alias(c) for c in names]
    out = centroids.copy()
    # First within salts, so that a cluster's rows, one for each task, do not all meet in one.
    for row in parts.groupBy("cluster", (F.spark_partition_id() % SALTS).alias("salt")).agg(*add).groupBy("cluster").agg(*add).collect():
        out[row["cluster"]] = [row[c] // row["n"] for c in names[1:]]
    return out


def first_centroids(ints: DataFrame, k: int = CENTROIDS, seed: int = 1) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``<seed>:<vec_id>``, in its order (fewer where there are fewer)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = ints.orderBy(key.asc_nulls_last(), "v").limit(k).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64)


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CENTROIDS,
            rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, leading: int = LEADING,
            seed: int = 1) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance, n_exact), final centroids): every usable vector in its nearest cluster.

    ``n_exact`` is the number of integer distances that the last assignment
    verified.  Defined cases: vectors that are null, of another length or with a
    null or non-finite component are left out; a null id starts no centroid
    before others do; rows may repeat, each is a vector; equal distances go to
    the smaller cluster number; fewer vectors than ``k`` make that many
    centroids; an empty table gives an empty result and no centroids; other
    columns are ignored.
    """
    ints = integer_vectors(vectors, id_col, vector_col, dimensions, scale)
    centroids = first_centroids(ints, k, seed)
    kind = ints.schema["vec_id"].dataType
    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType()), T.StructField("n_exact", T.IntegerType())])
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    leading = max(1, min(leading, dimensions))
    mean, axes = rotation(ints, dimensions)
    index = stage(indexed(ints, mean, axes, leading))
    for _ in range(rounds):
        centroids = _moved(index, centroids, mean, axes, leading)
    assign = _assigning(centroids, mean, axes, leading)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            _, cluster_, distance, verified = assign(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cluster_.astype(np.int32)), pa.array(distance),
                 pa.array(verified.astype(np.int32))], [f.name for f in schema])

    return index.mapInArrow(run, schema), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assigned vectors with cluster_inertia, inertia and centroid_sha256."""
    spark = assigned.sparkSession
    assigned = stage(assigned)
    per = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    rows = [(c, per[c], sum(per.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
            for c in sorted(per)]
    table = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster")  # a row for each centroid
