import random
import re
from collections import Counter
from zlib import crc32

import pytest

from cartograph.llm.spelling import Acceptor, near_pairs, variants
from tests.llm.helpers import EDGE, documents

LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, ratio=5, least=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= least}
    near = {w: sorted((-n[x], x) for x in n if one_edit(w, x)) for w in n}
    form = {w: v[0][1] if v and -v[0][0] >= ratio * n[w] else None for w, v in near.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n)


def check(spark, rows, part=20_000, clashes=False):
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows], clashes)
    got = sorted(map(tuple, variants(docs, part=part).select("word", "form", "root", "n", "n_near", "form_n").collect()))
    assert got == brute(rows)
    return got


def some_rows(seed):
    """Texts of words of few letters, their misspellings, and accents, with frequencies far apart."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abàÿ") for _ in range(rng.randint(6, 9))) for _ in range(40)]

    def edited(w):
        at = rng.randrange(len(w))
        return rng.choice([w[:at] + w[at + 1:], w[:at] + "b" + w[at:], w[:at] + "é" + w[at + 1:]])

    words = []
    for w in base:
        words += [w] * rng.choice([5, 30, 300])
        for _ in range(3):
            v = edited(w)
            words += [v] * rng.choice([4, 5, 40]) + [edited(v)] * rng.choice([5, 6, 7])
    rng.shuffle(words)
    upper = {c: c - 32 for c in range(97, 123)}
    return [(i, rng.choice(" -_\n").join(words[i::50]).translate(upper) if i % 7 else " ".join(words[i::50])) for i in range(50)]


@pytest.mark.parametrize("part", [20_000, 12])
def test_brute_force(spark, part):
    got = check(spark, some_rows(5), part)
    assert sum(r[1] is not None for r in got) > 20 and any(r[2] != (r[1] or r[0]) for r in got)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in EDGE] * 5 + [(None, "Letters LETTERS lettérs " * 9), (3, None), (4, ""), (5, "x" * 3000 + " " + "x" * 3001)] * 5
    check(spark, rows, clashes=True)
    check(spark, [(i, t) for i, t in rows if t is None or len(t) < 1000], part=2)


def test_empty(spark):
    check(spark, [])
    check(spark, [(1, "no word is frequent enough")])


@pytest.mark.parametrize("seed", range(20))
def test_acceptor(seed):
    rng = random.Random(seed)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(0, 6))) for _ in range(40)})
    a = Acceptor(words)
    found = list(a.pairs())
    assert len(found) == len({frozenset(p) for p in found})
    assert {frozenset(p) for p in found} == {frozenset((x, y)) for x in words for y in words if one_edit(x, y)}
    rests = {w[i:] for w in words for i in range(len(w) + 1)}
    of = {frozenset(r for r in rests if any(w == p + r for w in words)) for w in words for p in [w[:i] for i in range(len(w) + 1)]}
    assert len(a.arcs) == len(of)  # as few states as there are different sets of rests


def test_pairs_once(spark):
    words = sorted({w[:i] + c + w[i:] for w in ("abcdefgh", "aaaaaaa", "babababa") for i in range(len(w)) for c in "abx"})
    vocabulary = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    count = {w: i + 1 for i, w in enumerate(words)}
    for part in (20_000, 5):
        got = [(r.a, r.b, r.n_a, r.n_b) for r in near_pairs(vocabulary, part=part).collect()]
        assert all((count[a], count[b]) == (x, y) for a, b, x, y in got)
        assert sorted(tuple(sorted(p[:2])) for p in got) == sorted((a, b) for a in words for b in words if a < b and one_edit(a, b))
