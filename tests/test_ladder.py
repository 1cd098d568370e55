"""Popularity lists by what is known of a customer, on every rung, against a plain ranking."""

from collections import Counter

from cartograph.operators import recommend

ARTICLES = [(i, f"g{i % 3}" if i % 7 else None, f"c{i % 4}" if i % 5 else None) for i in range(1, 41)]


def frames(spark):
    tx = [("2020-01-01", f"u{i % 9}", i % 40 + 1, 1.0, 1) for i in range(600) for _ in range(i % 3)] + [("2020-01-02", "u1", 999, 1.0, 1)] * 40
    facts = spark.createDataFrame(tx, "t_dat string, customer_id string, article_id long, price double, sales_channel_id int").selectExpr(
        "cast(t_dat as date) t_dat", "customer_id", "article_id", "price", "sales_channel_id")
    articles = spark.createDataFrame(ARTICLES, "article_id long, product_group_name string, colour_group_name string")
    known = [("both", "g1", "c2"), ("group", "g2", None), ("colour", None, "c1"), ("nothing", None, None), ("new group", "g9", "c9"),
             ("rare", "g0", "c0")]
    customers = spark.createDataFrame([(k[0],) for k in known] * 2 + [("unknown",)], "customer_id string")
    return tx, facts, articles, customers, spark.createDataFrame(known, "customer_id string, cat string, col string"), known


def plain(tx, known, k):
    n = Counter(r[2] for r in tx)
    of = {a: (g, c) for a, g, c in ARTICLES}
    out = []
    for customer, cat, col in [*known, ("unknown", None, None)]:
        def step(a):
            g, c = of.get(a, (None, None))
            if cat is not None and g == cat:
                return 0 if col is not None and c == col else 1
            return 2
        best = sorted(n, key=lambda a: (step(a), -n[a], a))[:k]
        out += [(customer, a, i + 1, recommend.RUNGS[step(a)]) for i, a in enumerate(best)]
    return sorted(out)


def test_every_rung(spark):
    tx, facts, articles, customers, known, rows = frames(spark)
    for k in (3, 12, 100):
        got = recommend.ladder_recommender(facts, articles, customers, k=k, known=known)
        assert sorted(tuple(r) for r in got.select("customer_id", "article_id", "rank", "rung").collect()) == plain(tx, rows, k)
    assert {r[3] for r in plain(tx, rows, 12)} == set(recommend.RUNGS)


def test_blend_covers_new_customers(spark):
    _, facts, articles, customers, known, _ = frames(spark)
    got = recommend.hybrid_recommender(facts, articles, customers, k=5, known=known)
    assert {r.customer_id: r["n"] for r in got.groupBy("customer_id").count().withColumnRenamed("count", "n").collect()
            if not r.customer_id.startswith("u") or r.customer_id == "unknown"} == dict.fromkeys(
        ["both", "group", "colour", "nothing", "new group", "rare", "unknown"], 5)


def test_no_purchases(spark):
    _, facts, articles, customers, known, _ = frames(spark)
    assert recommend.ladder_recommender(facts.limit(0), articles, customers, known=known).collect() == []
