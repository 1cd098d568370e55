import random

import numpy as np
import pytest

from cartograph.llm.common import ROW, words
from cartograph.llm.components import components
from cartograph.llm.hashing import word_hashes
from cartograph.llm.minhash import (
    _alike, _document_signatures, _most_different, _signatures, _sketches, drop_near_duplicates, near_duplicates, shingles)
from tests.llm.helpers import EDGE, documents


def brute(rows):
    """component ids by comparing all pairs; rows with the same words are linked."""
    sets = [shingles(r[1]) for r in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = root(i), root(j)
                label[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        least = min(ids, default=None)
        out += [(rows[i][0], len(sets[i]), least, rows[i][0] == least) for i in members]
    return sorted(out, key=repr), len(groups)


def check(spark, rows, **options):
    found = near_duplicates(documents(spark, rows, clashes=True), **options)
    got = found.collect()
    want, n = brute(rows)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got), key=repr) == want
    assert sum(r.first_row for r in got) == n
    assert len({r[ROW] for r in got}) == len(rows)


def text(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, w, share):
    return [f"e{rng.randrange(10**6)}" if rng.random() < share else x for x in w]


def test_edges(spark):
    check(spark, EDGE)


def test_near_copies_chains_and_shared_passages(spark):
    rng = random.Random(5)
    rows, i = [], 0
    passage = text(rng, 60)
    for _ in range(12):
        base = text(rng, 120)
        for _ in range(5):
            rows.append((i, " ".join(edited(rng, base, 0.02)), "en", "s"))
            i += 1
        chain = base  # each like the one before it, the last unlike the first
        for _ in range(6):
            chain = chain[9:] + text(rng, 9)
            rows.append((i, " ".join(chain), "en", "s"))
            i += 1
        rows.append((i, " ".join(passage + text(rng, 60)), "en", "s"))
        i += 1
    check(spark, rows)


def test_links_are_found_when_buckets_mix_components(spark):
    """One band of one coordinate throws unlike texts together; hubs beyond the first must find the links."""
    rng = random.Random(8)
    common = text(rng, 40)
    rows = []
    for i in range(40):
        rows.append((i, " ".join(common + text(rng, 6 if i % 2 else 60)), "en", "s"))
    check(spark, rows, bands=64, width=1)


def test_hot_group(spark):
    rng = random.Random(3)
    base = text(rng, 150)
    rows = [(i, " ".join(edited(rng, base, 0.008)), "en", "s") for i in range(250)] + [(1000 + i, " ".join(text(rng, 30)), "en", "s") for i in range(30)]
    check(spark, rows)


def test_drop_keeps_one_of_each(spark):
    docs = documents(spark, clashes=True)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.count() == brute(EDGE)[1]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert near_duplicates(docs).count() == 0 and drop_near_duplicates(docs).columns == docs.columns


def test_coordinates_estimate_similarity():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 1000, dtype=np.int64).astype(np.uint64)
    b = np.concatenate([a[:750], rng.integers(0, 2**63, 250, dtype=np.int64).astype(np.uint64)])
    sig = _signatures(np.concatenate([a, b]), np.array([0, 1000]), 512)
    assert abs((sig[0] == sig[1]).mean() - 750 / 1250) < 0.08
    assert len(np.unique(sig[0])) > 250


def test_long_documents_have_the_same_minima(monkeypatch):
    import cartograph.llm.minhash as m
    sets = [np.arange(1, 5000, dtype=np.uint64) * np.uint64(977), np.arange(3, 40, dtype=np.uint64), np.empty(0, dtype=np.uint64)]
    whole = _document_signatures(sets, 16)
    monkeypatch.setattr(m, "_CHUNK", 100)
    parts = _document_signatures(sets, 16)
    assert whole[2] is None and parts[2] is None
    assert all((whole[i] == parts[i]).all() for i in (0, 1))


@pytest.mark.parametrize("n", [1024, 100])
def test_sketches_of_links_are_alike(spark, n):
    rng = np.random.default_rng(2)
    most, pairs, differ = _most_different(n), [], []
    for i in range(400):
        shared = 857 if i % 2 else 667  # of 1000: similarity 0.75 and 0.5
        a = rng.integers(0, 2**63, 1000, dtype=np.int64).astype(np.uint64)
        b = np.concatenate([a[:shared], rng.integers(0, 2**63, 1000 - shared, dtype=np.int64).astype(np.uint64)])
        sig = _signatures(np.concatenate([a, b]), np.array([0, 1000]), n)
        x, y = _sketches(sig).tolist()
        pairs.append((i, x, y))
        differ.append(int(((sig[0] ^ sig[1]) & 1).sum()))
    got = {r.i: r.alike for r in spark.createDataFrame(pairs, "i int, x array<long>, y array<long>").select("i", _alike("x", "y", n).alias("alike")).collect()}
    assert got == {i: d <= most for i, d in enumerate(differ)}
    assert all(got[i] for i in range(1, 400, 2))
    if n == 1024:
        assert not any(got[i] for i in range(0, 400, 2))
        assert most == 181 and abs(np.mean(differ[1::2]) - 128) < 6 and np.std(differ[1::2]) < 14


def test_unlike_texts_of_a_bucket_make_no_rows(spark, monkeypatch):
    """Texts that are half alike share many buckets; few pairs of them may reach the exact comparison."""
    import cartograph.llm.minhash as m
    rng = random.Random(11)
    base = text(rng, 300, 10**6)
    rows = [(i, " ".join(edited(rng, base, 0.065)), "en", "s") for i in range(150)]
    sent, plain = [], m._confirmed
    monkeypatch.setattr(m, "_confirmed", lambda pairs, texts: sent.append(pairs.count()) or plain(pairs, texts))
    check(spark, rows)
    assert sum(sent) < 150 * 149 / 2 / 4


def test_words_hash_alike_wherever_they_stand():
    one, two = word_hashes(b"a bc a d"), word_hashes(b"bc")
    assert one[0] == one[2] and one[1] == two[0] and len(set(one.tolist())) == 3
    assert words("A\x0bB c ") == [b"a", "b c ".encode()]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(7, 7)]
    label = {x: x for e in links for x in e}
    for _ in label:
        for u, v in links:
            label[u] = label[v] = min(label[u], label[v])
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    alone = {x for x in label if not any(x in e and e[0] != e[1] for e in links)}
    assert got == {x: m for x, m in label.items() if x not in alone}
