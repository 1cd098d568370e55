import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cartograph.llm.mixing import MAX_REPEATS, mixed_documents, mixture, permuted, shard_counts, targets
from tests.llm.helpers import CLASHES, EDGE, documents, same_rows


def size(text):
    return len((text or "").encode().split())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from([5.0, 2.0, 1.0])), min_size=1, max_size=12))
def test_targets(found):
    sizes, weights = zip(*found)
    t = targets(sizes, weights)
    assert abs(sum(t) - sum(sizes)) < 1e-6 * max(1, sum(sizes))
    assert all(x <= MAX_REPEATS * s + 1e-9 for x, s in zip(t, sizes))
    free = [x / w for x, s, w in zip(t, sizes, weights) if s and x < MAX_REPEATS * s - 1e-9]
    assert not free or max(free) - min(free) < 1e-6 * max(free)  # by weight where not full
    full = [x / w for x, s, w in zip(t, sizes, weights) if s and x >= MAX_REPEATS * s - 1e-9]
    assert not free or not full or max(full) <= min(free) + 1e-6


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000])
def test_permutation(n):
    for key in (0, 5):
        out = permuted(np.arange(n), np.full(n, n), np.full(n, key))
        assert sorted(out.tolist()) == list(range(n))
    if n == 1000:
        assert (permuted(np.arange(n), np.full(n, n), np.full(n, 1)) != permuted(np.arange(n), np.full(n, n), np.full(n, 2))).mean() > 0.9


def test_shard_counts():
    counts = shard_counts([50, 0, 1000, 7], 8, 1)
    assert counts.sum(axis=0).tolist() == [50, 0, 1000, 7]
    assert counts.sum(axis=1).max() - counts.sum(axis=1).min() <= 1
    assert (counts >= 0).all() and (counts == shard_counts([50, 0, 1000, 7], 8, 1)).all()
    assert shard_counts([0, 0], 4, 1).sum() == 0


def rows(n=400):
    rng = np.random.default_rng(4)
    return [(i, " ".join(f"w{j}" for j in range(int(rng.integers(1, 90)))), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(n)]


def test_takings_come_near_targets(spark):
    docs = rows()
    got = {r.doc_id: r for r in mixture(documents(spark, docs), block=16).collect()}
    by = {}
    for i, t, _, s in docs:
        r = got[i]
        assert r.size == size(t) and r.taken <= MAX_REPEATS * r.size
        x = by.setdefault(s, [0, 0, r.target, r.source_size])
        x[0] += r.size
        x[1] += r.taken
    names = sorted(by)
    want = targets([by[s][0] for s in names], [(5.0, 2.0, 1.0)[i % 3] for i in range(len(names))])
    for s, t in zip(names, want):
        assert by[s][3] == by[s][0] and abs(by[s][2] - t) < 1e-6
        assert abs(by[s][1] - t) <= 3 * 16 + 0.02 * t


def test_the_mix_is_what_was_taken(spark):
    docs = documents(spark, rows(150), clashes=True)
    taken = {r.doc_id: r.taken for r in mixture(docs, block=16).collect() if r.taken}
    mix = mixed_documents(docs, block=16)
    assert mix.columns == docs.columns
    got, whole = {}, {r[0]: r[1] for r in rows(150)}
    for r in mix.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + size(r.text)
        assert r.text in whole[r.doc_id] and r.n_chars == len(r.text) and all(r[c] == "clash" for c in CLASHES)
    assert got == taken


def test_one_pass_joins_to_the_texts(spark):
    docs = [(i, f"  a{i}\tb\n\nc  " + "d " * 50, "en", "only") for i in range(5)]
    pieces = mixed_documents(documents(spark, docs), block=8).collect()
    for i, t, _, _ in docs:
        own = [r.text for r in pieces if r.doc_id == i]
        assert sum(map(len, own)) == len(t) and own and t.startswith(min(own, key=t.find))


def test_edges(spark):
    docs = documents(spark, clashes=True)
    got = mixture(docs).collect()
    assert sorted((r.size for r in got)) == sorted(size(r[1]) for r in EDGE)
    assert all(r.taken == 0 for r in got if r.size == 0)
    assert all(r.taken <= 3 * r.size for r in got)
    assert same_rows(mixture(docs), mixture(docs))
    assert mixed_documents(docs).columns == docs.columns


def test_empty_and_wordless_tables(spark):
    assert mixture(documents(spark, [])).count() == 0
    assert mixed_documents(documents(spark, [])).count() == 0
    got = mixture(documents(spark, [(1, "", "en", "a"), (2, None, "en", None)])).collect()
    assert [(r.target, r.taken) for r in got] == [(0.0, 0)] * 2
