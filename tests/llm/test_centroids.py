import hashlib
from math import floor, isfinite

import numpy as np
import pytest

from cartograph.llm.centroids import _rotated, cluster, nearest, with_inertia
from tests.llm.helpers import stored

SCHEMA = "vec_id long, embedding array<float>, label int, v string, lead string, cluster string, distance string"


def table(spark, rows):
    """(vec_id, embedding) rows as a stored table with columns of clashing names."""
    return stored(spark.createDataFrame([(i, e, 0, "x", "x", "x", "x") for i, e in rows], SCHEMA).coalesce(2))


def brute(rows, k, rounds, dimensions, scale=64):
    kept = [(i, [floor(scale * float(np.float32(x))) for x in e]) for i, e in rows
            if e is not None and len(e) == dimensions and all(x is not None and isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    centroids = [v for _, v in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        of = [j for _, j in assign()] if centroids else []
        for j in range(len(centroids)):
            own = [v for (_, v), at in zip(kept, of) if at == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    last = assign() if centroids else []
    per = {}
    for d, j in last:
        per[j] = per.get(j, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, j, d, per[j], sum(per.values()), digest[j]) for (i, _), (d, j) in zip(kept, last)), key=repr)


def found(spark, rows, k=4, rounds=3, dimensions=3, leading=1):
    got = with_inertia(*cluster(table(spark, rows), k=k, rounds=rounds, dimensions=dimensions, leading=leading)).collect()
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got), key=repr)


def test_edges(spark):
    rows = [(1, [0.1, -0.2, 0.3]), (2, [0.1, -0.2, 0.3]), (2, [0.1, -0.2, 0.3]), (None, [0.5, 0.5, 0.5]), (4, None), (5, []),
            (6, [0.1, 0.2]), (7, [0.1, None, 0.2]), (8, [float("nan"), 0.0, 0.0]), (9, [float("inf"), 0.0, 0.0]),
            (10, [-1.0, -1.0, -1.0]), (11, [1.0, 1.0, 1.0]), (12, [0.0, 0.0, 0.0]), (12, [0.25, 0.0, -0.25]), (13, [1e5, -1e5, 1e5])]
    assert found(spark, rows) == brute(rows, 4, 3, 3)
    assert found(spark, rows, k=100) == brute(rows, 100, 3, 3)  # fewer vectors than centroids: some end up empty


def test_empty_and_unusable(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, [1.0])]) == []


def test_too_large_raises(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        found(spark, [(1, [1e30, 0.0, 0.0])])


@pytest.mark.parametrize("seed, k, leading", [(1, 1, 0), (2, 3, 2), (3, 5, 4)])
def test_random_with_ties(spark, seed, k, leading):
    rng = np.random.default_rng(seed)  # few values: many equal vectors and equal distances
    rows = [(int(i), (x / 64).tolist()) for i, x in zip(rng.integers(0, 40, 120), rng.integers(-3, 4, (120, 4)))]
    assert found(spark, rows, k=k, rounds=2, dimensions=4, leading=leading) == brute(rows, k, 2, 4)


def test_filter_skips_distances():
    rng = np.random.default_rng(3)
    centres = rng.integers(-300, 300, (16, 64))
    x = centres[rng.integers(0, 16, 2000)] + rng.integers(-20, 20, (2000, 64))
    mean = x.mean(axis=0)
    axes = np.ascontiguousarray(np.linalg.eigh(np.cov(x.T))[1][:, ::-1])
    lead, rest = _rotated(x, mean, axes, 8)
    best, distance, verified = nearest(x, lead, rest, centres, *_rotated(centres, mean, axes, 8))
    every = ((x[:, None, :] - centres) ** 2).sum(axis=2)
    assert (best == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert verified.mean() < 2  # of 16
