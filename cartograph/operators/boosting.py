"""Cross-validation of many boosted tree models at once, level by level.

Spark's ``GBTClassifier`` fits one model as a chain of jobs, one for each level of
each tree.  A search has hundreds of such chains, and on small tables nearly all
of its time is the start of jobs.  Here all models of a search grow their trees
together: a level of all of them is one job.

The method is that of Spark's boosted trees: log loss on labels -1 and 1, the
first tree fitted to the labels and the others to the loss's negative gradient,
nodes split where the variance falls most, features cut at no more than MAX_BINS
quantiles of a bounded sample, which each fold takes from its own training rows.
Fits that draw nothing give the same scores as Spark's (a test compares them);
rows and features are drawn by other random numbers.

Rows are dealt into slices of about SLICE rows, and models of one fold into groups
of at most GROUP, as many as there are cores for.  A cell holds a slice and the
scores that a group's models give its rows.  Tasks sum the cells' histograms, which
are added by model in a shuffle (not where a group has only one slice), and there
every model's splits are chosen; only splits reach the driver.

Up to WHOLE rows are one slice, of which a task grows KEEP trees of a group's models
without leaving it (``Whole``): a job for KEEP trees instead of one a level.  It makes
the same trees.  WHOLE bounds what a task holds.
"""

from __future__ import annotations

import json
import pickle
import sys
import time
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.functions.joins import materialize
from cartograph.session import ensure_checkpoint_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

SLICE, GROUP = 16384, 40  # rows and models of a cell at most
SLICES = 8  # slices of a partition at most
WHOLE, WAVES = 1 << 20, 6  # rows that are one slice, and groups a core then
NARROW, WIDE = 32, 1024  # values of the codes that several features share, and of those for few nodes
MAX_BINS, SAMPLE = 32, 10_000  # as in Spark's trees
KEEP = 30  # trees after which the scores are checkpointed


@dataclass(frozen=True)
class Setting:
    """A model of the search, by the names of ``GBTClassifier``."""

    maxDepth: int = 5
    stepSize: float = 0.1
    subsamplingRate: float = 1.0
    featureSubsetStrategy: str = "all"

    def features(self, n: int) -> int:
        """How many of ``n`` features a node may be split by: all, or a share in (0, 1]."""
        if self.featureSubsetStrategy in ("all", "auto"):
            return n
        share = float(self.featureSubsetStrategy)
        if not 0 < share <= 1:
            raise ValueError(f"featureSubsetStrategy {self.featureSubsetStrategy!r}: all, auto or a share")
        return ceil(share * n)


@dataclass
class Tree:
    """Nodes by number (children of k: 2k and 2k + 1); ``open`` are those not yet split or left as leaves."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    open: np.ndarray = field(default_factory=lambda: np.ones(1, dtype=np.int64))

    @classmethod
    def of_depth(cls, depth: int) -> Tree:
        n = 2 << depth
        return cls(np.full(n, -1, dtype=np.int16), np.zeros(n, dtype=np.int16), np.zeros(n))

    def places(self, bins: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
        """The node each of ``rows`` has reached after ``depth`` steps."""
        node = np.ones(len(rows), dtype=np.int64)
        for _ in range(depth):
            f = self.feature[node]
            node = np.where(f >= 0, 2 * node + (bins[f, rows] > self.cut[node]), node)
        return node


def thresholds(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Where a feature is cut: between its distinct values, or near MAX_BINS - 1 quantiles of equal weight."""
    distinct, place = np.unique(values, return_inverse=True)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) < MAX_BINS:
        return middle
    counts = np.bincount(place, weights=weights)
    stride = counts.sum() / MAX_BINS
    seen = np.cumsum(counts)
    cuts, target = [], stride
    for i in range(1, len(distinct)):
        if abs(seen[i - 1] - target) < abs(seen[i] - target):
            cuts.append(middle[i - 1])
            target += stride
    return np.array(cuts)


def _targets(labels: np.ndarray, scores: np.ndarray, tree: int) -> np.ndarray:
    if tree == 0:
        return labels
    return 4 * labels / (1 + np.exp(np.minimum(2 * labels * scores, 700)))


def _histogram(cell: dict, tree: Tree, depth: int, targets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(2, open nodes, features, bins): weight and weighted sum of the targets."""
    bins, n_open = cell["bins"], len(tree.open)
    place = np.full(2 << depth, -1, dtype=np.int64)
    place[tree.open] = np.arange(n_open)
    at = place[tree.places(bins, rows, depth)]
    rows, at = rows[at >= 0], at[at >= 0]
    size = n_open * len(bins) * MAX_BINS
    codes = (bins[:, rows] + (at * len(bins) + np.arange(len(bins))[:, None]) * MAX_BINS).ravel()
    weights = cell["weights"][rows]
    both = [np.bincount(codes, weights=np.tile(x, len(bins)), minlength=size) for x in (weights, weights * targets[rows])]
    return np.array(both).reshape(2, n_open, len(bins), MAX_BINS)


def _splits(total: np.ndarray, allowed: np.ndarray) -> dict[str, np.ndarray]:
    """The best split of every node: by how much it lowers the squared error, where to cut, and the means of both sides."""
    n, s = total
    left_n, left_s = np.cumsum(n, axis=2), np.cumsum(s, axis=2)
    all_n, all_s = left_n[:, :1, -1:], left_s[:, :1, -1:]
    right_n, right_s = all_n - left_n, all_s - left_s
    right_n[np.cumsum(n[:, :, ::-1] > 0, axis=2)[:, :, ::-1] - (n > 0) == 0] = 0  # nothing to the right, whatever rounding left
    with np.errstate(divide="ignore", invalid="ignore"):
        base = all_s**2 / all_n
        gain = left_s**2 / left_n + right_s**2 / right_n - base
        gain[~((left_n > 0) & (right_n > 0)) | ~allowed[:, :, None]] = -np.inf
        flat = gain.reshape(len(gain), -1).argmax(axis=1)
        nodes, (f, cut) = np.arange(len(gain)), np.divmod(flat, MAX_BINS)
        at = (nodes, f, cut)
        means = [np.nan_to_num(x) for x in (all_s[:, 0, 0] / all_n[:, 0, 0], left_s[at] / left_n[at], right_s[at] / right_n[at])]
    return {"split": gain[at] > 1e-12 * np.nan_to_num(np.abs(base[:, 0, 0]) + 1), "feature": f, "cut": cut,
            "mean": means[0], "left": means[1], "right": means[2]}


def _grow(tree: Tree, found: dict[str, np.ndarray], deeper: bool) -> None:
    tree.value[tree.open] = found["mean"]
    node = tree.open[found["split"]]
    tree.feature[node], tree.cut[node] = found["feature"][found["split"]], found["cut"][found["split"]]
    tree.value[2 * node], tree.value[2 * node + 1] = found["left"][found["split"]], found["right"][found["split"]]
    tree.open = np.sort(np.concatenate([2 * node, 2 * node + 1])) if deeper else node[:0]


class Whole:
    """Grows trees on a cell that has all rows, each of weight 1.

    Histograms are (2, bins of all features, nodes).  Features of few values share a code, and for
    few nodes two such codes share another, so that one count serves them all.  Of two children
    only the one with fewer rows is counted, the other is the rest of the parent.
    """

    def __init__(self, cell: dict):
        self.bins, self.train = cell["bins"], cell["train"]
        self.flat, self.rows = self.bins.ravel(), np.arange(self.bins.shape[1])
        widths = [int(b.max()) + 1 for b in self.bins]
        order = sorted(range(len(widths)), key=lambda f: -widths[f])
        starts = dict(zip(order, np.cumsum([0, *(widths[f] for f in order)])))
        self.size = sum(widths)
        self.feature = np.concatenate([np.full(widths[f] - 1, f) for f in order] + [[0]])  # of each place to cut, and of none
        self.cut = np.concatenate([np.arange(widths[f] - 1) for f in order] + [[0]])
        self.turn = None if order == sorted(order) else np.append(np.lexsort((self.cut[:-1], self.feature[:-1])), len(self.cut) - 1)
        self.same, end = [], 0  # of the features of a width: how many, the width, where their bins and their places to cut begin
        for w in sorted({*widths} - {1}, reverse=True):
            own = [f for f in order if widths[f] == w]
            self.same.append((len(own), w, starts[own[0]], end))
            end += len(own) * (w - 1)
        units: list = []  # (features, values)
        for f in order:
            if units and units[-1][1] * widths[f] <= NARROW:
                units[-1] = [*units[-1][0], f], units[-1][1] * widths[f]
            else:
                units.append(([f], widths[f]))
        self.narrow = [([self._unit(own, starts, widths)], size, self._code(own, widths)) for own, size in units]
        self.wide = []
        for one, two in zip(self.narrow[::2], self.narrow[1::2] + [None] * (len(self.narrow) % 2)):
            self.wide.append(one if two is None else (one[0] + two[0], one[1] * two[1], one[2] * np.int16(two[1]) + two[2]))
        self.where, self.drawn, self.counts = np.empty_like(self.rows), None, None

    def _code(self, own: list[int], widths: list[int]) -> np.ndarray:
        code = np.zeros(len(self.rows), dtype=np.int16)
        for f in own:
            code = code * np.int16(widths[f]) + self.bins[f]
        return code

    @staticmethod
    def _unit(own: list[int], starts: dict, widths: list[int]) -> tuple:
        """(values, first bin, last bin, matrix that makes bins of all features from values; None: they are the same)."""
        size, end = int(np.prod([widths[f] for f in own])), starts[own[-1]] + widths[own[-1]]
        if len(own) == 1:
            return size, starts[own[0]], end, None
        values = np.unravel_index(np.arange(size), [widths[f] for f in own])
        return size, starts[own[0]], end, np.concatenate([v == np.arange(widths[f])[:, None] for f, v in zip(own, values)]).astype(float)

    def histogram(self, rows: np.ndarray, at: np.ndarray | None, nodes: int, targets: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        """Number of ``rows`` (unless given), and sum of their ``targets``, by bin and node ``at``."""
        out, codes, base = np.empty((2, self.size, nodes)), np.empty(len(rows), dtype=np.int64), {}
        if counts is not None:
            out[0] = counts
        for units, size, code in self.wide if nodes * WIDE <= len(rows) else self.narrow:
            if at is not None and size not in base:
                base[size] = at * size
            np.add(code.take(rows, mode="clip"), 0 if at is None else base[size], out=codes, dtype=np.int64)
            for k, weights in enumerate((None, targets)):
                if k == 0 and counts is not None:
                    continue
                made = np.bincount(codes, weights, size * nodes)
                if len(units) == 2:
                    made = made.reshape(nodes, units[0][0], units[1][0])
                for i, (n, first, end, apart) in enumerate(units):
                    own = (made.sum(axis=2 - i) if len(units) == 2 else made.reshape(nodes, n)).T
                    out[k, first:end] = own if apart is None else apart @ own
        return out

    def splits(self, total: np.ndarray, allowed: np.ndarray | None) -> dict[str, np.ndarray]:
        """As ``_splits``."""
        nodes, (_, w, first, _) = total.shape[2], self.same[0] if self.same else (1, 1, 0, 0)
        all_n, all_s = total[:, first: first + w].sum(axis=1)
        left = np.empty((2, len(self.cut), nodes))
        left[:, -1] = 0
        for n, w, first, place in self.same:
            bins, to = total[:, first: first + n * w].reshape(2, n, w, nodes), left[:, place: place + n * (w - 1)].reshape(2, n, w - 1, nodes)
            to[:, :, 0] = bins[:, :, 0]
            for i in range(1, w - 1):
                np.add(to[:, :, i - 1], bins[:, :, i], out=to[:, :, i])
        left_n, left_s = left
        right_n, right_s = all_n - left_n, all_s - left_s
        gain = left_s * left_s
        gain /= np.maximum(left_n, 0.5)  # 0 rows: also the sum is 0 but for rounding
        right_s *= right_s
        right_s /= np.maximum(right_n, 0.5)
        gain += right_s
        if allowed is not None:
            gain[:-1][~allowed.T[self.feature[:-1]]] = -np.inf
        best = gain.argmax(axis=0) if self.turn is None else self.turn[gain[self.turn].argmax(axis=0)]  # of equal ones the first feature
        at = (best, np.arange(nodes))
        n, s = left_n[at], left_s[at]
        some, means = np.maximum(all_n, 0.5), [s / np.maximum(n, 0.5), (all_s - s) / np.maximum(all_n - n, 0.5)]
        base = all_s * all_s / some
        split = (gain[at] - base > 1e-12 * (base + 1)) & (n > 0) & (all_n > n)
        return {"split": split, "feature": self.feature[best], "cut": self.cut[best], "mean": all_s / some, "left": means[0],
                "right": means[1], "fewer": 2 * n > all_n}

    def tree(self, depth: int, targets: np.ndarray, drawn: np.ndarray, allowed, nodes_too: bool = False):
        """What a tree on the ``drawn`` rows gives to every row, and with ``nodes_too`` its nodes as well.

        ``allowed(level, nodes)``: the features that each node may be split by, None for all.
        """
        if self.drawn is not drawn:
            self.drawn, self.counts = drawn, None
        rows = np.flatnonzero(drawn)
        total = self.histogram(rows, None, 1, targets.take(rows), self.counts) if depth else None
        at, value = np.zeros(len(self.rows), dtype=np.int64), np.zeros(1)  # at: leaves by place, those to be split first
        number, made = np.zeros(1, dtype=np.int64), []  # of the leaves; (node, left child, right child, feature, cut)
        for level in range(depth):
            if not level:
                self.counts = total[0]
            found, nodes = self.splits(total, allowed(level, total.shape[2])), total.shape[2]
            value[:nodes] = found["mean"]
            parents = np.flatnonzero(found["split"])
            k = len(parents)
            if not k:
                break
            others = np.delete(np.arange(len(value)), parents)
            to, start, cut = np.empty(len(value), dtype=np.int64), np.zeros(len(value), dtype=np.int64), np.full(len(value), 255, dtype=np.uint8)
            to[parents], to[others] = 2 * np.arange(k), 2 * k + np.arange(len(others))
            start[parents], cut[parents] = found["feature"][parents] * len(self.rows), found["cut"][parents]
            start.take(at, mode="clip", out=self.where)
            self.where += self.rows
            side = self.flat.take(self.where, mode="clip") > cut.take(at, mode="clip")
            to.take(at, mode="clip", out=self.where)
            np.add(self.where, side, out=at)
            value = np.concatenate([np.stack([found["left"], found["right"]], axis=1)[parents].ravel(), value[others]])
            new = 1 + 2 * sum(len(x[0]) for x in made) + np.arange(2 * k)
            made.append((number[parents], new[::2], new[1::2], found["feature"][parents], found["cut"][parents]))
            number = np.concatenate([new, number[others]])
            if level + 1 == depth:
                break
            fewer = found["fewer"][parents]
            counted = np.zeros(len(value), dtype=bool)
            counted[2 * np.arange(k) + fewer] = True
            rows = np.flatnonzero(counted.take(at, mode="clip") & drawn)
            own = self.histogram(rows, at.take(rows, mode="clip") >> 1, k, targets.take(rows, mode="clip"))
            rest = total[:, :, parents] - own
            total = np.empty((*own.shape, 2))
            total[..., 0], total[..., 1] = np.where(fewer, rest, own), np.where(fewer, own, rest)
            total = total.reshape(2, -1, 2 * k)
        given = value.take(at, mode="clip")
        return (given, self._nodes(made, number, at[drawn], targets[drawn])) if nodes_too else given

    def _nodes(self, made: list, number: np.ndarray, at: np.ndarray, targets: np.ndarray) -> list[tuple]:
        """(number, rows, sum and sum of squares of their targets, left child, right child, feature, cut) of every node."""
        sums = np.zeros((3, 1 + 2 * sum(len(x[0]) for x in made)))
        sums[:, number] = [np.bincount(at, w, len(number)) for w in (None, targets, targets * targets)]
        links = np.full((4, sums.shape[1]), -1)
        for node, left, right, feature, cut in reversed(made):
            sums[:, node] = sums[:, left] + sums[:, right]
            links[:, node] = left, right, feature, cut
        return [(i, *s, *x) for i, (s, x) in enumerate(zip(sums.T.tolist(), links.T.tolist()))]


def _edges(data: DataFrame, folds: int, flags: int) -> list[list[np.ndarray]]:
    """For each fold the cuts of every feature, from SAMPLE of its training rows; the last ``flags`` features are 0 or 1."""
    out = []
    for i in range(folds):
        rows = data.where(F.col("fold") != i).orderBy("key").limit(SAMPLE).select("x", "weight").collect()
        x, w = np.array([r["x"] for r in rows], dtype=float), np.array([r["weight"] for r in rows], dtype=float)
        n = x.shape[1] if len(rows) else 0
        out.append([np.array([0.5]) if f >= n - flags else thresholds(x[:, f], w) for f in range(n)])
    return out


def _cells(data: DataFrame, edges: list, groups: list, folds: int, slices: int, parts: int):
    """((group, slice), cell): features as bins, labels, weights, training rows, and the models' scores."""

    def cell(key, table):
        i = key[0].as_py()
        x = table["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        number, label, weight, fold = (table[c].to_numpy() for c in ("key", "label", "weight", "fold"))
        order = np.lexsort((*x.T, weight, label, number))  # the same draws whatever order the rows come in
        bins = np.array([np.searchsorted(e, x[order, f]) for f, e in enumerate(edges[i])], dtype=np.uint8)
        made = {"bins": bins, "labels": 2 * label[order] - 1, "weights": weight[order], "train": fold[order] != i}
        return pa.table({"of": pa.array([i], pa.int32()), "slice": pa.array([key[1].as_py()], pa.int32()),
                         "cell": pa.array([pickle.dumps(made)], pa.binary())})

    made = data.withColumn("of", F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))).groupBy("of", "slice").applyInArrow(
        cell, "of int, slice int, cell binary")

    def start(item):
        (g, _), stored = item
        held = pickle.loads(stored)
        held["scores"] = np.zeros((len(groups[g][1]), len(held["labels"])))
        return item[0], held

    return (made.rdd.flatMap(lambda r: [((g, r["slice"]), bytes(r["cell"])) for g, (i, _) in enumerate(groups) if i == r["of"]])
            .partitionBy(len(groups) * parts, lambda key: key[0] * parts + key[1] % parts).map(start, preservesPartitioning=True))


def cross_validated(data: DataFrame, settings: Sequence[Setting], sizes: Sequence[int], folds: int, seed: int,
                    flags: int = 0) -> Iterator[tuple[int, list, DataFrame]]:
    """For each of ``sizes``, the scores that models of so many trees give the rows of the fold they were not fitted on.

    ``data`` has ``features``, ``label`` (0 or 1), ``weight``, ``fold`` and ``key``, a hash that deals
    and orders the rows.  Yields (trees, groups, scores): groups[g] is (fold, places of its models in
    ``settings``); scores has (group, label, scores), an array with a score for each of the group's models.
    """
    spark = data.sparkSession
    ensure_checkpoint_dir(spark)
    data = data.select("key", "label", "weight", "fold", vector_to_array("features").alias("x"))
    n, whole = _size(data)
    slices = 1 if whole else max(1, ceil(n / SLICE))
    data = materialize(data.withColumn("slice", F.pmod(F.xxhash64("key"), F.lit(slices)).cast("int")))
    edges = _edges(data, folds, flags)
    n_features = max(map(len, edges))
    cores = spark.sparkContext.defaultParallelism
    chunks = max(ceil(len(settings) / GROUP), min(len(settings), ceil(WAVES * cores / folds) if whole else cores // (folds * slices)))
    by_depth = sorted(range(len(settings)), key=lambda p: settings[p].maxDepth)
    groups = [(i, by_depth[c::chunks]) for i in range(folds) for c in range(chunks)]
    models = [(g, j) for g, (_, own) in enumerate(groups) for j in range(len(own))]
    setting_of = {(g, j): settings[groups[g][1][j]] for g, j in models}
    parts = min(slices, max(ceil(cores / len(groups)), ceil(slices / SLICES)))
    reducers = min(len(models), cores) if parts > 1 else 0
    cells = _cells(data, edges, groups, folds, slices, parts).persist(StorageLevel.MEMORY_AND_DISK)
    stored, m = None, 0
    while m < max(sizes):
        if whole:
            end = min(m - m % KEEP + KEEP, *(s for s in (max(sizes), *sizes) if s > m))
            updated = _grown(cells, groups, setting_of, m, end, seed, n_features)
        else:
            end = m + 1
            trees = {x: Tree.of_depth(setting_of[x].maxDepth) for x in models}
            for depth in range(max(s.maxDepth for s in settings)):
                growing = {x: t for x, t in trees.items() if len(t.open)}
                if not growing:
                    break
                for x, found in _level(cells, groups, growing, setting_of, m, depth, seed, n_features, reducers):
                    _grow(trees[x], found, depth + 1 < setting_of[x].maxDepth)
            updated = _scored(cells, groups, trees, setting_of, m)
        updated.persist(StorageLevel.MEMORY_AND_DISK)
        if end % KEEP == 0:
            updated.checkpoint()
        updated.foreachPartition(lambda part: None)
        cells.unpersist()
        cells, m = updated, end
        if m % KEEP == 0:
            stored, earlier = cells.getCheckpointFile(), stored
            _drop(spark, earlier)
        if m in sizes:
            yield m, groups, _held(spark, cells)
    cells.unpersist()
    _drop(spark, stored)


def _size(data: DataFrame) -> tuple[int, bool]:
    """(rows, whether a task can hold them all as ``Whole`` does)."""
    n, least, most = data.agg(F.count(F.lit(1)), F.min("weight"), F.max("weight")).first()
    return n, 0 < n <= WHOLE and least == most == 1


def fitted(data: DataFrame, est: GBTClassifier, seed: int, flags: int = 0) -> GBTClassificationModel:
    """The model of ``est`` (which has a ``Setting`` and ``maxIter``) on all rows of ``data``, as in ``cross_validated``.

    Where ``Whole`` can hold them its trees are grown in one task and stored as Spark stores a
    model, which reads it; else ``est`` fits them itself.
    """
    spark = data.sparkSession
    rows = data.select("key", "label", "weight", F.lit(1).alias("fold"), vector_to_array("features").alias("x"))
    if not _size(rows)[1]:
        return est.fit(data.select("features", F.col("label").alias(est.getLabelCol()),
                                   *([F.col("weight").alias(est.getWeightCol())] if est.hasParam("weightCol") and est.isDefined("weightCol") else [])))
    trees, setting = est.getMaxIter(), Setting(est.getMaxDepth(), est.getStepSize(), est.getSubsamplingRate(), est.getFeatureSubsetStrategy())
    rows = materialize(rows.withColumn("slice", F.lit(0)))
    (edges,) = _edges(rows, 1, flags)

    def grow(item):
        _, cell = item
        grower, scores = Whole(cell), cell["scores"][0]
        for m in range(trees):
            given, nodes = grower.tree(setting.maxDepth, _targets(cell["labels"], scores, m), _drawn(cell, {setting.subsamplingRate}, [seed, m, 0])[setting.subsamplingRate],
                                       _chosen(setting, len(edges), seed, m, 0, 0), nodes_too=True)
            scores += (setting.stepSize if m else 1.0) * given
            spread = [s2 / n - (s / n) ** 2 for _, n, s, s2, *_ in nodes]
            for i, n, s, s2, left, right, f, cut in nodes:
                gain = spread[i] - sum(nodes[c][1] / n * spread[c] for c in (left, right)) if left >= 0 else -1.0
                yield m, (i, s / n, spread[i], [n, s, s2], int(n), gain, left, right, (f, [float(edges[f][cut])] if left >= 0 else [], -1))

    found = _cells(rows, [edges], [(0, [0])], 1, 1, 1).flatMap(grow)
    params, defaults = ({p.name: v for p, v in known.items()} for known in (est._paramMap, est._defaultParamMap))

    def about(kind: str, uid: str, own: set | None, **more) -> str:
        return json.dumps({"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "uid": uid} | {
            name: {k: v for k, v in known.items() if own is None or k in own} for name, known in (("paramMap", params), ("defaultParamMap", defaults))} | more)

    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    tree_params = {p.name for p in DecisionTreeRegressor().params}
    spark.createDataFrame([(about("classification.GBTClassificationModel", est.uid, None, numFeatures=len(edges), numTrees=trees),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    spark.createDataFrame([(m, about("regression.DecisionTreeRegressionModel", f"dtr_{uuid.uuid4().hex[:12]}", tree_params), est.getStepSize() if m else 1.0) for m in range(trees)],
                          "_1 int, _2 string, _3 double").write.parquet(f"{path}/treesMetadata")
    spark.createDataFrame(found, "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
                          "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>").write.parquet(f"{path}/data")
    model = GBTClassificationModel.load(path)
    _drop(spark, path)
    return model


def _drop(spark, stored: str | None) -> None:
    """Remove a checkpoint of cells that no later one needs."""
    if stored:
        path = spark._jvm.org.apache.hadoop.fs.Path(stored)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _level(cells, groups, growing, setting_of, m: int, depth: int, seed: int, n_features: int, reducers: int) -> list:
    """(model, its splits at this level): histograms of cells, summed by model."""

    def histograms(part):
        total: dict = {}
        for (g, s), cell in part:
            drawn = np.random.default_rng([seed, m, s]).random(len(cell["labels"]))
            rows: dict = {}
            for j in range(len(groups[g][1])):
                if (g, j) in growing:
                    rate = setting_of[g, j].subsamplingRate
                    if rate not in rows:
                        rows[rate] = np.flatnonzero(cell["train"] & (drawn < rate))
                    made = _histogram(cell, growing[g, j], depth, _targets(cell["labels"], cell["scores"][j], m), rows[rate])
                    total[g, j] = total[g, j] + made if (g, j) in total else made
        yield from total.items()

    def best(item):
        (g, j), total = item
        return (g, j), _splits(total, _allowed(setting_of[g, j], n_features, total.shape[1], [seed, m, depth, groups[g][0], groups[g][1][j]]))

    made = cells.mapPartitions(histograms)
    return (made.reduceByKey(lambda a, b: a + b, reducers) if reducers else made).map(best).collect()


def _allowed(setting: Setting, n: int, nodes: int, seed: list[int]) -> np.ndarray:
    """(nodes, features): which of ``n`` features each node may be split by."""
    k = setting.features(n)
    if k == n:
        return np.ones((nodes, n), dtype=bool)
    return np.random.default_rng(seed).random((nodes, n)).argsort(axis=1).argsort(axis=1) < k


def _drawn(cell: dict, rates: set, seed: list[int]) -> dict[float, np.ndarray]:
    drawn = np.random.default_rng(seed).random(len(cell["labels"]))
    return {rate: cell["train"] & (drawn < rate) for rate in rates}


def _chosen(setting: Setting, n: int, seed: int, m: int, fold: int, place: int):
    """``_allowed`` by level and number of nodes, or None for all features."""
    return lambda level, nodes: None if setting.features(n) == n else _allowed(setting, n, nodes, [seed, m, level, fold, place])


def _grown(cells, groups, setting_of, first: int, end: int, seed: int, n_features: int):
    """The cells with the trees ``first`` to ``end - 1`` in their scores; each cell has all rows."""

    def add(item):
        (g, s), cell = item
        fold, own = groups[g]
        scores = cell["scores"].copy()
        if not len(cell["labels"]) or not len(cell["bins"]):
            return item
        grower = Whole(cell)
        for m in range(first, end):
            drawn = _drawn(cell, {setting_of[g, j].subsamplingRate for j in range(len(own))}, [seed, m, s])
            for j, place in enumerate(own):
                setting = setting_of[g, j]
                given = grower.tree(setting.maxDepth, _targets(cell["labels"], scores[j], m), drawn[setting.subsamplingRate],
                                    _chosen(setting, n_features, seed, m, fold, place))
                scores[j] += (setting.stepSize if m else 1.0) * given
        return (g, s), {**cell, "scores": scores}

    return cells.map(add, preservesPartitioning=True)


def _scored(cells, groups, trees, setting_of, m: int):
    """The cells with this round's trees in their scores."""

    def add(item):
        (g, s), cell = item
        rows = np.arange(len(cell["labels"]))
        scores = cell["scores"].copy()
        for j in range(len(groups[g][1])):
            tree, setting = trees[g, j], setting_of[g, j]
            scores[j] += (setting.stepSize if m else 1.0) * tree.value[tree.places(cell["bins"], rows, setting.maxDepth)]
        return (g, s), {**cell, "scores": scores}

    return cells.map(add, preservesPartitioning=True)


def _held(spark, cells) -> DataFrame:
    def rows(item):
        (g, _), cell = item
        held = np.flatnonzero(~cell["train"])
        return [(g, label, scores) for label, scores in zip(((cell["labels"][held] + 1) / 2).tolist(), cell["scores"][:, held].T.tolist())]

    return materialize(spark.createDataFrame(cells.flatMap(rows), "group int, label double, scores array<double>"))
