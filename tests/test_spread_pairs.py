"""Distinct attribute values from parts of fixed size: a task's map does not grow with the facts."""

from cartograph.operators import store


def test_parts_follow_the_rows(spark, monkeypatch):
    tx = spark.sql("select date'2020-01-01' t_dat, id % 7 customer_id, id article_id, 1.0D price, 1 sales_channel_id from range(1000)")
    articles = spark.sql("select id article_id, cast(id % 5 as string) product_group_name, if(id % 2 = 0, 'red', null) colour_group_name, "
                         "cast(id as string) garment_group_name from range(900)")
    monkeypatch.setattr(store, "PAIRS", 100)
    parts, counts = [], store.attribute_counts
    monkeypatch.setattr(store, "attribute_counts", lambda b, *a: (parts.append(b.rdd.getNumPartitions()), counts(b, *a))[1])
    got = {r.customer_id: tuple(r)[1:] for r in store.category_diversity(tx, articles, "2021-01-01").collect()}
    assert parts == [11]
    assert got == {c: (5, 1, sum(i % 7 == c for i in range(900))) for c in range(7)}
