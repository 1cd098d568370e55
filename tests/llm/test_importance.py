import math
import random
from collections import Counter

import numpy as np

from cartograph.llm.importance import STANDARD, fit, ngrams, resample, weigh
from tests.llm.helpers import EDGE, documents, stored


def corpus(n=500, seed=1):
    rng = random.Random(seed)
    good = [f"good{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(n):
        ok = i % 5 != 0
        w = [rng.choice(good) + ("" if ok else "%%%") for _ in range(rng.randrange(5, 60))]
        rows.append((i, " ".join(w), "en", "s"))
        if i % 2:
            labels.append((i, int(ok), 0))
    return rows, labels


def table_of(spark, labels):
    return stored(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_keeps_what_is_like_the_target(spark):
    rows, labels = corpus()
    docs = documents(spark, rows, clashes=True)
    ratio, share = fit(docs, table_of(spark, labels))
    assert abs(share - 0.8) < 0.05
    k = math.ceil(share * len(rows))
    got = resample(weigh(docs, ratio), k).collect()
    assert sum(r.kept for r in got) == k and len(got) == len(rows)
    kept = {r.doc_id for r in got if r.kept}
    good = [i for i in range(len(rows)) if i % 5]
    assert sum(i in kept for i in good) >= 0.95 * len(good)
    assert {r.doc_id for r in sorted(got, key=lambda r: -r.gumbel_key)[:k]} == kept


def test_ratios_against_brute_force(spark):
    rows, labels = corpus(60)
    ratio, _ = fit(documents(spark, rows), table_of(spark, labels), bits=8)
    import zlib
    good = {i for i, q, _ in labels if q and zlib.crc32(str(i).encode()) % 5}
    raw, own = Counter(), Counter()
    for i, t, _, _ in rows:
        raw.update(ngrams(t, 8).tolist())
        if i in good:
            own.update(ngrams(t, 8).tolist())
    n, m = sum(raw.values()) + 256, sum(own.values()) + 256
    want = np.array([math.log((own[b] + 1) / m) - math.log((raw[b] + 1) / n) for b in range(256)])
    assert np.allclose(ratio, want)
    w = {r.doc_id: r.log_weight for r in weigh(documents(spark, rows), ratio).collect()}
    assert all(abs(w[i] - STANDARD * want[ngrams(t, 8)].mean()) < 1e-2 for i, t, _, _ in rows)


def test_noise_is_gumbel_and_repeatable(spark):
    docs = documents(spark, [(i, "", "", "") for i in range(3000)])
    flat = np.zeros(1 << 8)
    keys = np.array([r.gumbel_key for r in weigh(docs, flat).collect()])
    assert abs(keys.mean() - 0.5772) < 0.1 and abs(keys.std() - math.pi / math.sqrt(6)) < 0.1
    assert sorted(keys) == sorted(r.gumbel_key for r in weigh(docs, flat).collect())


def test_edges_and_empty(spark):
    docs = documents(spark, clashes=True)
    ratio, share = fit(docs, table_of(spark, [(1, None, 0), (None, 1, 0)]))
    assert not ratio.any() and share == 1.0
    assert resample(weigh(docs, ratio), 1000).where("kept").count() == len(EDGE)
    ratio, _ = fit(docs, table_of(spark, [(1, 1, 0), (2, 0, 0), (8, 1, 0), (8, 0, 0)]))
    assert len(resample(weigh(docs, ratio), 3).where("kept").collect()) == 3
    none = documents(spark, [])
    assert resample(weigh(none, fit(none, table_of(spark, [(1, 1, 0)]))[0]), 5).count() == 0
