"""Cosine recommendations against a plain computation over every customer and article, and what is read for them."""

import math
import random
from collections import Counter, defaultdict

import pytest

from cartograph.operators import similarity

ATTRS = similarity.ATTRIBUTES


def frames(spark, seed, n_articles=120, n_items=300):
    rng = random.Random(seed)
    arts = [(i, *[rng.choice([None, "x", *[f"{a[8]}{j}" for j in range(m)]]) for a, m in zip(ATTRS, (15, 5, 8, 3))]) for i in range(n_articles)]
    arts += [(500, None, None, None, None), (501, *arts[0][1:]), (502, *arts[0][1:])]
    tx = [("2020-01-01", f"u{rng.randint(0, 12)}", rng.choice([0, 1, 2, rng.randint(0, n_articles + 5)]), 1.0, 1) for _ in range(n_items)]
    tx += [("2020-01-01", "blank", 500, 1.0, 1), ("2020-01-01", "unlisted", 9999, 1.0, 1), ("2021-01-01", "later", 1, 1.0, 1)]
    facts = spark.createDataFrame(tx, "t_dat string, customer_id string, article_id long, price double, sales_channel_id int").selectExpr(
        "cast(t_dat as date) t_dat", "customer_id", "article_id", "price", "sales_channel_id")
    return tx, arts, facts, spark.createDataFrame(arts, "article_id long, " + ", ".join(f"{a} string" for a in ATTRS))


def plain(tx, arts, k):
    vector = {a: [(n, v) for n, v in zip(ATTRS, vs) if v is not None] for a, *vs in arts}
    holders = Counter(f for fs in vector.values() for f in fs)
    weight = {f: math.log(1 + len(arts) / n) for f, n in holders.items()}
    norm = {a: math.sqrt(sum(weight[f] ** 2 for f in fs)) for a, fs in vector.items()}
    popular = Counter(r[2] for r in tx if r[0] < "2020-06-01")
    profiles = defaultdict(Counter)
    for r in tx:
        if r[0] < "2020-06-01":
            profiles[r[1]].update(vector.get(r[2], []))
    out = set()
    for c, p in profiles.items():
        length = math.sqrt(sum((n * weight[f]) ** 2 for f, n in p.items()))
        found = []
        for a, fs in vector.items():
            dot = sum(p[f] * weight[f] ** 2 for f in fs)
            if dot:
                found.append((-round(dot / length / norm[a], 6), -popular[a], a))
        out |= {(c, a, -s, i + 1) for i, (s, _, a) in enumerate(sorted(found)[:k])}
    return out


@pytest.mark.parametrize("seed, k", [(1, 12), (2, 3), (3, 500)])
def test_against_every_pair(spark, seed, k):
    tx, arts, facts, articles = frames(spark, seed)
    got = similarity.similarity_recommender(facts, articles, "2020-06-01", k).collect()
    assert {(r.customer_id, r.article_id, r.score, r["rank"]) for r in got} == plain(tx, arts, k)


def test_lists_of_common_values_are_not_read(spark, monkeypatch):
    """Every article shares a value; customers with their own kind of article do not read its list."""
    arts = [(i, f"kind{i % 40}", "all", f"c{i % 40}", f"m{i % 40}") for i in range(4000)]
    arts = [(i, *v, ) if i % 2 else (i, v[0], v[1], v[2], f"own{i}") for i, *v in arts]
    tx = [("2020-01-01", f"u{i}", i, 1.0, 1) for i in range(40)]
    facts = spark.createDataFrame(tx, "t_dat string, customer_id string, article_id long, price double, sales_channel_id int").selectExpr(
        "cast(t_dat as date) t_dat", "customer_id", "article_id", "price", "sales_channel_id")
    scored, score = [], similarity._scores
    monkeypatch.setattr(similarity, "_scores", lambda c, p, x: (scored.append(c), score(c, p, x))[1])
    similarity.similarity_recommender(facts, spark.createDataFrame(arts, "article_id long, " + ", ".join(f"{a} string" for a in ATTRS)), k=5).collect()
    classes = 2020
    assert sum(c.count() for c in scored) < 0.2 * 40 * classes


def test_empty(spark):
    _, _, facts, articles = frames(spark, 1)
    assert similarity.similarity_recommender(facts.limit(0), articles).collect() == []
    assert similarity.similarity_recommender(facts, articles.limit(0)).collect() == []


def test_pairs_stay_in_the_cells(spark, monkeypatch):
    """Customers with one common value ask for all articles with it, but only k of these become rows; cells do not matter."""
    monkeypatch.setattr(similarity, "CUSTOMERS", 20)
    monkeypatch.setattr(similarity, "CLASSES", 100)
    tx, arts, facts, articles = frames(spark, 5, 480, 200)
    made, score = [], similarity._scores
    monkeypatch.setattr(similarity, "_scores", lambda c, p, x: (made.append(score(c, p, x)), made[-1])[1])
    got = similarity.similarity_recommender(facts, articles, "2020-06-01", 4).collect()
    assert {(r.customer_id, r.article_id, r.score, r["rank"]) for r in got} == plain(tx, arts, 4)
    blocks = 5
    assert len(made) == 2 and all(0 < m.count() <= 14 * 4 * blocks for m in made)
