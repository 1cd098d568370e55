"""History inputs of the next-purchase model: against a plain loop, and without a look ahead."""

import random
from datetime import date, timedelta
from statistics import median, stdev

from cartograph.operators import segment

ARTICLES = [(1, "a"), (2, "a"), (3, "b"), (4, "c"), (5, None)]  # 6 is not listed


def rows_for(seed, n=150):
    rng = random.Random(seed)
    return [(date(2020, 1, 1) + timedelta(days=rng.choice([0, 1, 2, 40, rng.randint(0, 500)])), rng.choice("uvwx"), rng.randint(1, 6), 1.0, 1)
            for _ in range(n)] + [(date(2020, 5, 1), "once", 1, 1.0, 1), (date(2020, 1, 1), "plain", 5, 1.0, 1),
                                  (date(2020, 1, 9), "plain", 3, 1.0, 1), (date(2020, 1, 20), "plain", 6, 1.0, 1), (date(2020, 2, 1), "plain", 4, 1.0, 1)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "t_dat date, customer_id string, article_id long, price double, sales_channel_id int")


def inputs(spark, rows):
    articles = spark.createDataFrame(ARTICLES, "article_id long, product_group_name string")
    got = segment.next_purchase_inputs(frame(spark, rows), articles).collect()
    return {(r.customer_id, r.t_dat): r for r in got}


def plain(rows):
    group, out = dict(ARTICLES), {}
    for c in {r[1] for r in rows}:
        days = sorted({r[0] for r in rows if r[1] == c})
        for i, d in enumerate(days[:-1]):
            gaps = [(b - a).days for a, b in zip(days[:i + 1], days[1:i + 1])]
            n = {}
            for r in rows:
                if r[1] == c and r[0] <= d and group.get(r[2]):
                    n[group[r[2]]] = n.get(group[r[2]], 0) + 1
            last = gaps[-1] if gaps else -1
            out[c, d] = ((days[i + 1] - d).days, last, median(gaps) if gaps else -1, round(stdev(gaps), 6) if len(gaps) > 1 else -1,
                         min(n, key=lambda g: (-n[g], g)) if n else None,
                         "dormant" if last > 180 else "at_risk" if last > 60 else "new" if (d - days[0]).days < 90 else "loyal")
    return out


def test_against_a_loop(spark):
    for seed in (1, 2):
        rows = rows_for(seed)
        got = {k: (r.target, r.prev_gap, r.median_gap, round(r.std_gap, 6), r.category, r.lifecycle) for k, r in inputs(spark, rows).items()}
        assert got == plain(rows)


def test_no_look_ahead(spark):
    """What comes after a day changes its target at most."""
    rows = rows_for(3)
    cut = date(2020, 6, 1)
    early = {k: r for k, r in inputs(spark, [r for r in rows if r[0] < cut]).items()}
    late = inputs(spark, rows + [(cut + timedelta(days=i), c, 4, 9.0, 2) for c in "uvwx" for i in range(20)])
    assert early
    for k, r in early.items():
        assert {**r.asDict(), "target": 0} == {**late[k].asDict(), "target": 0}


def test_metrics_beside_the_baseline(spark):
    rows = [(date(2020, 1, 1) + timedelta(days=(3 + c % 2 * 27) * i), f"c{c}", 1 + c % 4, 1.0, 1) for c in range(60) for i in range(12)]
    articles = spark.createDataFrame(ARTICLES, "article_id long, product_group_name string")
    got = segment.next_purchase_regression(segment.next_purchase_inputs(frame(spark, rows), articles)).first()
    assert got.mae < got.baseline_mae / 2 and got.rmse < got.baseline_rmse  # customers keep their own rhythm


def test_empty(spark):
    assert inputs(spark, []) == {}
