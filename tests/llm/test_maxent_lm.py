import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

import cartograph.llm.maxent_lm as lm
from tests.llm.helpers import EDGE, documents


def tokens(text):
    return (text or "").encode().lower().split() + [b""]


def base(rows):
    count = Counter()
    for i, t, *_ in rows:
        if i is None or zlib.crc32(str(i).encode()) % 10:
            count.update(tokens(t))
    n, v = sum(count.values()), len(count)
    return n, count, [(i, len(tokens(t)), sum(count[w] > 0 for w in tokens(t)),
                       sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t, *_ in rows]


def languages(n=300, seed=3):
    """Two languages without a word in common: the last words tell which one it is."""
    rng = random.Random(seed)
    words = [[f"{a}{i}" for i in range(80)] + [h] * 40 for a, h in (("ka", "the"), ("zo", "der"))]
    return [(i, " ".join(rng.choice(words[i % 2]) for _ in range(rng.randrange(20, 60))), "en", "s") for i in range(n)]


@pytest.fixture(scope="module")
def scored(spark):
    docs = documents(spark, languages(), clashes=True)
    model = lm.fit(docs)
    return model, {r.doc_id: r for r in lm.score(docs, model).collect()}


def check_base(rows, got):
    n, _, want = base(rows)
    a = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got), key=repr)
    assert a == sorted(((i, t, k, round(b, 6)) for i, t, k, b in want), key=repr)
    assert {r.train_tokens for r in got} <= {n}


def test_base_against_brute_force(scored):
    check_base(languages(), scored[1].values())


def test_held_out_texts_score_better_than_the_base(scored):
    out = [r for r in scored[1].values() if r.held_out]
    assert out and sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out)
    assert {r.doc_id for r in out} == {i for i, *_ in languages() if zlib.crc32(str(i).encode()) % 10 == 0}


def test_probabilities_sum_to_one(scored):
    """After some history, all known words and one unknown word of each class."""
    model = scored[0]
    _, count, _ = base(languages())
    vocabulary = sorted(w.decode() for w in count if w)
    hashes, group, _ = lm._tokens(vocabulary)
    own = model.classes.of(hashes, group)
    word = np.ones(len(hashes), dtype=bool)
    ends = np.flatnonzero(hashes == lm.END)
    word[ends[:-1]] = False  # one end is enough
    c = np.array([count[w.encode()] for w in vocabulary for w in (w, "")], dtype=float)
    inside = np.log10(c + lm.ADD) - model.log_mass[own]
    unknown = np.log10(lm.ADD) - model.log_mass
    for text in ("the ka1 ka2", "der zo5", ""):
        h, _, starts = lm._tokens([text])
        z = lm._logits(model.weights, lm._features(h, starts))[-1]
        p = np.exp(z) / np.exp(z).sum()
        total = (p[own] * 10**inside)[word].sum() + (p * 10**unknown).sum()
        assert abs(total - 1) < 1e-5


def test_heads_and_tail_score_alike(spark, scored, monkeypatch):
    monkeypatch.setattr(lm, "HEADS", 5)
    docs = documents(spark, languages())
    few = {r.doc_id: r for r in lm.score(docs, lm.fit(docs)).collect()}
    assert all(abs(few[i].base_score - r.base_score) < 1e-6 and few[i].n_known == r.n_known for i, r in scored[1].items())


def test_edges(spark):
    docs = documents(spark, clashes=True)
    got = lm.score(docs, lm.fit(docs)).collect()
    check_base(EDGE, got)
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_empty_table_and_nothing_to_train_on(spark):
    none = documents(spark, [])
    model = lm.fit(none)
    assert lm.score(none, model).count() == 0
    got = lm.score(documents(spark, [(1, "a b", "", "")]), model).collect()[0]
    assert (got.n_tokens, got.n_known, got.train_tokens) == (3, 0, 0) and got.base_score == pytest.approx(0) and got.score <= 0


def test_word_classes_are_split_from_text():
    h, g, starts = lm._tokens(["a  b", None, "\t", "Ab"])
    assert starts.tolist() == [0, 3, 4, 5] and (h == lm.END).tolist() == [False, False, True, True, True, False, True]
    assert lm._tokens(["aB"])[0][0] == h[5]


def test_production_classes(scored):
    """The end, 15 words and 32 classes of letter groups, all of them trained."""
    model = scored[0]
    assert model.classes.n == 48 and model.weights.shape[1] == 48
    assert set(np.unique(model.classes.of_group)) <= set(range(16, 48))
