"""Cases that the fixtures lack: shuffled wide files, empty and one-class inputs, null prices, large counts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cartograph.functions.scalars import money_stddev
from cartograph.operators import cohort, customers, features, filters, ml, products, quality, recommend, store, temporal, transactions
from cartograph.sources import readers, schemas

CATALOGUE = ["section_name", "prod_name", "article_id", "product_code", "product_type_no", "product_type_name", "product_group_name",
             "graphical_appearance_no", "graphical_appearance_name", "colour_group_code", "colour_group_name", "perceived_colour_value_id",
             "perceived_colour_value_name", "perceived_colour_master_id", "perceived_colour_master_name", "department_no", "department_name",
             "index_code", "index_name", "index_group_no", "index_group_name", "section_no", "garment_group_no", "garment_group_name",
             "detail_desc"]

TX = "t_dat date, customer_id string, article_id long, price double, sales_channel_id int"


def tx_of(spark, rows):
    return spark.createDataFrame(rows, "t_dat string, customer_id string, article_id long, price double, sales_channel_id int").withColumn(
        "t_dat", F.col("t_dat").cast("date"))


@pytest.fixture
def tx(spark):
    return tx_of(spark, [("2020-01-01", "a", 1, 2.0, 2), ("2020-01-01", "a", 2, None, 1), ("2020-02-01", "a", 1, 2.0, 2), ("2020-03-01", "b", 2, None, 1)])


def test_catalogue_is_read_by_header(spark):
    d = tempfile.mkdtemp(prefix="cartograph-test-")
    values = {c: f"{c} value" for c in CATALOGUE} | {"article_id": "0108775015", "detail_desc": 'Quoted "words", and a comma'}
    path = os.path.join(d, "articles.csv")
    with open(path, "w") as f:
        f.write(",".join(CATALOGUE) + "\n")
        f.write(",".join('"' + values[c].replace('"', '""') + '"' for c in CATALOGUE) + "\n")
    row = readers.read_articles(spark, path).first()
    assert row.article_id == 108775015
    assert all(row[c] == values[c] for c in CATALOGUE if c != "article_id")
    with pytest.raises(ValueError, match="no_such"):
        readers.read_articles(spark, path, schema=schemas.T.StructType([schemas.T.StructField("no_such", schemas.T.StringType())])).first()


def test_load_all_names_a_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        readers.load_all(spark, tempfile.mkdtemp(prefix="cartograph-test-"))


def test_mean_price_skips_nulls(spark, tx):
    assert {r.customer_id: r.avg_order_value for r in features.rfm_features(tx, "2020-06-01").collect()} == {"a": 2.0, "b": None}
    demo = spark.createDataFrame([("a", 1.0, "x", "y")], "customer_id string, age double, club_member_status string, fashion_news_frequency string")
    assert {r.customer_id: r.avg_order_value for r in features.churn_features(tx, demo, "2020-06-01").collect()} == {"a": 2.0, "b": None}
    assert {r.customer_id: r.avg_order_value for r in customers.customer_stats(tx).collect()} == {"a": 2.0, "b": None}
    art = spark.createDataFrame([(1, "g"), (2, "h")], "article_id long, product_group_name string")
    assert {r.product_group_name: r.avg_price for r in products.category_revenue(tx, art).collect()} == {"g": 2.0, "h": None}
    assert {r.customer_id: r.spend_per_purchase for r in store.rfm_extended(tx, "2020-06-01").collect()} == {"a": 2.0, "b": None}


def test_spending_trend_has_every_customer(tx):
    got = {r.customer_id: r.spending_trend for r in store.spending_trend(tx, "2021-06-01").collect()}
    assert got == {"a": 0.0, "b": 0.0}


def test_large_counts_do_not_overflow(spark):
    """The last step of the deviation for four billion values, without making them."""
    n = F.lit(4_000_000_000).cast("long")
    m = n.cast("double")
    assert spark.range(1).select((m * (m - 1)).alias("x")).first().x > 9.2e18
    got = spark.createDataFrame([(1.0,), (2.0,), (4.0,)], "p double").agg(money_stddev("p", 2).alias("s"), F.stddev_samp("p").alias("t")).first()
    assert abs(got.s - got.t) < 1e-12


def scored(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, is_churned int, probability_churn double, prediction double")


@pytest.mark.parametrize("rows", [[("a", 1, 0.9, 0.0), ("b", 0, 0.1, 0.0)], [("a", 1, 0.9, 1.0)], [("a", 0, 0.9, 1.0)], []])
def test_metrics_of_one_class_or_few_rows(spark, rows):
    m = ml.classification_metrics(scored(spark, rows)).first()
    assert m.tp + m.tn + m.fp + m.fn == len(rows)
    assert (m.auc_roc is None) == (len({r[1] for r in rows}) < 2)
    p = ml.precision_at_k_pct(scored(spark, rows)).first()
    assert p.precision_at_5pct is None


def test_empty_tables(spark):
    tx = tx_of(spark, []).select("t_dat", "customer_id", "article_id", "price", "sales_channel_id")
    people = spark.createDataFrame([], "customer_id string, club_member_status string, fashion_news_frequency string, age double")
    assert {r.null_pct for r in quality.null_profile(tx).collect()} == {None}
    assert customers.engagement_metrics(people).first().active_pct is None
    assert filters.drop_sparse_columns(people).columns == people.columns
    assert temporal.popularity_coverage(tx, "2020-01-01", "2020-01-07", "2020-01-01").first().coverage_pct is None
    assert temporal.final_week_vs_history(tx, "2020-01-01", "2020-01-07", "2020-01-01").first().diff_pct is None
    assert transactions.histogram(tx, "price").count() == 0
    art = spark.createDataFrame([], "article_id long, product_group_name string, colour_group_name string, garment_group_name string")
    assert quality.validation_report(art, people, tx).count() > 0


def test_histogram_of_one_value(spark):
    got = transactions.histogram(spark.createDataFrame([(1.0,), (1.0,)], "x double"), "x", bins=5).collect()
    assert [(r.bin_start, r["count"]) for r in got] == [(1.0, 2)]


def test_all_cohorts(spark, tx):
    counts = cohort.cohort_counts(tx)
    every = cohort.cohort_retention(counts, max_period=None, n_cohorts=None)
    assert every.count() == counts.count() and cohort.cohort_retention(counts, n_cohorts=1).select("cohort_month").distinct().count() == 1


def churn_rows(spark, n=240):
    rows = [(str(i), i % 3 == 0, float(i % 7), float(i % 11), "x" if i % 2 else "y") for i in range(n)]
    df = spark.createDataFrame(rows, "customer_id string, churned boolean, a double, b double, club_member_status string")
    label = (F.col("churned") | (F.col("a") > 5)).cast("int")
    numeric = [F.col("a" if i % 2 else "b").alias(c) for i, c in enumerate(schemas.NUMERIC_MODEL_FEATURES)]
    return df.select("customer_id", label.alias("is_churned"), *numeric, "club_member_status", F.lit("z").alias("fashion_news_frequency"))


@pytest.mark.parametrize("subsampling", [0.8, 1.0])
def test_first_trees_equal_a_shorter_fit(spark, subsampling):
    df = ml.encode_features(churn_rows(spark)).withColumn("is_churned", F.col("is_churned").cast("double")).cache()
    make = lambda n: ml.gbt().setParams(maxIter=n, maxDepth=3, subsamplingRate=subsampling).fit(df)
    long, short = make(6), make(3)
    from pyspark.ml.functions import vector_to_array
    raw = lambda d: [r[0] for r in d.orderBy("customer_id").select(vector_to_array("rawPrediction")[1]).collect()]
    a, b = raw(ml.first_trees(long, 3, df)), raw(short.transform(df))
    assert len(a) == len(b) > 0 and max(abs(x - y) for x, y in zip(a, b)) < 1e-9


def test_search_covers_the_grid_and_finds_the_best(spark):
    grid = {"maxDepth": [2, 3], "maxIter": [2, 4], "stepSize": [0.1], "subsamplingRate": [1.0]}
    results, model = ml.staged_search(churn_rows(spark), grid, folds=2)
    rows = results.collect()
    assert sorted((r.maxDepth, r.maxIter) for r in rows) == [(2, 2), (2, 4), (3, 2), (3, 4)]
    best = max(r.mean_auc for r in rows)
    chosen = ml.best_params(model)
    assert [r.mean_auc for r in rows if (r.maxDepth, r.maxIter) == (chosen["maxDepth"], chosen["maxIter"])] == [best]


def test_class_weights_reach_the_fit(spark):
    df = churn_rows(spark)
    balanced = ml.churn_gbt(df, balanced=True, maxIter=2, maxDepth=2)
    assert balanced.stages[-1].getOrDefault("weightCol") == "weight"
    assert balanced.transform(df.withColumn("is_churned", F.col("is_churned").cast("double"))).count() == df.count()


def test_best_products_against_brute_force(spark, monkeypatch):
    """Several blocks of users and items, repeated factors (ties by article), fewer items in the last block."""
    monkeypatch.setattr(recommend, "USER_BLOCK", 7)
    monkeypatch.setattr(recommend, "ITEM_BLOCK", 16)
    users = [(i, [float((i * 7 + j * 3) % 11 - 5) for j in range(3)]) for i in range(20)]
    items = [(i, f"a{i:03}", [float((i * 5 + j * 13) % 17 - 8) for j in range(3)]) for i in range(75)]
    got, share = recommend.best_products(spark.createDataFrame(users, "uid int, features array<float>"),
                                         spark.createDataFrame([i[1:] for i in items], "article_id string, features array<float>"), 4)
    want = {(u, pos, a, -loss) for u, f in users for pos, (loss, a) in enumerate(
        sorted((-sum(x * y for x, y in zip(f, g)), a) for _, a, g in items)[:4])}
    assert {(r.uid, r.pos, r.r.article_id, -r.r.loss) for r in got.collect()} == want
    assert 0 < share <= 1


def test_best_products_leave_out_what_cannot_enter(spark, monkeypatch):
    """Articles with short factors are not scored, lists are those of all articles; fewer articles than k, and no users."""
    monkeypatch.setattr(recommend, "ITEM_BLOCK", 16)
    users = [(i, [1.0 + i % 3, 0.5]) for i in range(30)]
    items = [(f"a{i:03}", [3.0 * 0.97**i, 1.0 * 0.97**i * (-1) ** i]) for i in range(300)]
    frame = spark.createDataFrame(users, "uid int, features array<float>")
    frames = [spark.createDataFrame(x, "article_id string, features array<float>") for x in (items, items[:3])]
    got, share = recommend.best_products(frame, frames[0], 5)
    every, all_share = recommend.best_products(frame, frames[1], 5)
    f32 = lambda x: [float(v) for v in __import__("numpy").array(x, dtype="float32")]
    for lists, known in ((got, items), (every, items[:3])):
        want = {(u, pos, a) for u, f in users for pos, (_, a) in enumerate(
            sorted((-sum(x * y for x, y in zip(f, f32(g))), a) for a, g in known)[:5])}
        assert {(r.uid, r.pos, r.r.article_id) for r in lists.collect()} == want
    assert share < 0.2 and all_share == 1
    assert recommend.best_products(frame.limit(0), frames[0], 5)[0].collect() == []
    assert recommend.best_products(frame, frames[0].limit(0), 5)[0].collect() == []


def test_later_rounds_return_only_what_enters(spark, monkeypatch):
    """Items of like length, so that every round is taken: lists with ties are exact, and a round returns no pair beyond a user's k-th."""
    import numpy as np
    for name, value in (("ITEM_BLOCK", 16), ("USER_BLOCK", 8)):
        monkeypatch.setattr(recommend, name, value)
    rng = np.random.default_rng(3)
    around = rng.normal(size=(150, 4))
    factors = np.repeat(around / np.linalg.norm(around, axis=1)[:, None], 2, axis=0).astype("float32")  # each twice: ties
    own = rng.normal(size=(60, 4)).astype("float32")
    items = [(f"a{(i * 37) % 300:03}", [float(x) for x in f]) for i, f in enumerate(factors)]
    users = spark.createDataFrame([(i, [float(x) for x in u]) for i, u in enumerate(own)], "uid int, features array<float>")
    returned, cells = [], recommend._scored_cells

    def counted(*args):
        out = cells(*args).cache()
        returned.append(sum(len(r.best) for r in out.collect()))
        return out

    monkeypatch.setattr(recommend, "_scored_cells", counted)
    got, _ = recommend.best_products(users, spark.createDataFrame(items, "article_id string, features array<float>"), 5)

    def loss(u, f):
        total = 0.0
        for x, y in zip(u, f):
            total -= float(x) * float(y)
        return total

    want = {(i, pos, a) for i, u in enumerate(own) for pos, (_, a) in enumerate(sorted((loss(u, f), a) for a, f in items)[:5])}
    assert {(r.uid, r.pos, r.r.article_id) for r in got.collect()} == want
    assert len(returned) == 6 and sum(returned) < 0.8 * 6 * 5 * 60


def test_als_lists_reach_articles_beyond_the_500_most_bought(spark):
    """A group of customers that only buys the least bought articles of 540 gets these."""
    common = [("2020-01-01", f"c{i}", j, 1.0, 1) for i in range(30) for j in range(520)]
    rare = [("2020-01-01", f"r{i}", 1000 + j, 1.0, 1) for i in range(10) for j in range(20)]
    got = recommend.als_recommender(tx_of(spark, common + rare), k=5, max_iter=5).collect()
    assert len(got) == 40 * 5
    lists = {c: [r.article_id for r in got if r.customer_id == c] for c in ("r0", "r7")}
    assert all(a >= 1000 for found in lists.values() for a in found)


def test_first_trees_with_feature_subsets(spark):
    df = ml.encode_features(churn_rows(spark)).withColumn("is_churned", F.col("is_churned").cast("double")).cache()
    long, short = (ml.gbt().setParams(maxIter=n, maxDepth=3, subsamplingRate=0.8, featureSubsetStrategy="0.8").fit(df) for n in (6, 3))
    raw = lambda d: [r.rawPrediction.toArray().tolist() for r in d.orderBy("customer_id").collect()]
    a, b = raw(ml.first_trees(long, 3, df)), raw(short.transform(df))
    assert len(a) == len(b) > 0 and max(abs(x - y) for p, q in zip(a, b) for x, y in zip(p, q)) < 1e-9


def test_the_wide_query_searches_the_whole_grid(spark, monkeypatch):
    """The registered query hands all 72 points to the staged search, which fits each setting once for both sizes."""
    from cartograph.plans import queries_ml

    searched = []
    monkeypatch.setattr(ml, "staged_search", lambda train, grid, folds, parallelism: (searched.append((grid, folds)), (None, "model"))[1])
    monkeypatch.setattr(ml, "score_predictions", lambda model, df: model)
    monkeypatch.setattr(queries_ml, "_splits", lambda spark, sf: (None, None))
    assert queries_ml.q_wide(spark, "") == "model"
    points = 1
    for values in searched[0][0].values():
        points *= len(values)
    assert searched[0][1] == 3 and points == 72 and max(searched[0][0]["maxIter"]) == 300


def test_wide_search_returns_the_best_of_all_points(spark, monkeypatch):
    grid = {"maxDepth": [2], "maxIter": [2, 4], "stepSize": [0.1], "subsamplingRate": [1.0], "featureSubsetStrategy": ["0.8", "all"]}
    found, search = [], ml.staged_search
    monkeypatch.setattr(ml, "staged_search", lambda *a, **k: found.append(search(*a, **k)) or found[0])
    model = ml.churn_boosted_wide(churn_rows(spark), grid, folds=2, parallelism=2)
    rows, chosen = found[0][0].collect(), ml.best_params(model)
    assert len(rows) == 4
    assert [r.mean_auc for r in rows if all(r[c] == chosen[c] for c in grid)] == [max(r.mean_auc for r in rows)]


def test_articles_without_colour_do_not_crowd_out_the_others(spark):
    """The most popular articles of a category have no colour: they come after every article with one."""
    bought = [("2020-01-01", "a", i, 1.0, 1) for i in range(10) for _ in range(20 - i)] + [("2020-01-01", "a", i, 1.0, 1) for i in (50, 51, 52)]
    arts = [(i, "g", None) for i in range(10)] + [(50, "g", "red"), (51, "g", "blue"), (52, "g", "green")]
    articles = spark.createDataFrame(arts, "article_id long, product_group_name string, colour_group_name string")
    got = recommend.content_recommender(tx_of(spark, bought), articles, k=4).orderBy("rank").collect()
    assert [r.article_id for r in got] == [51, 50, 52, 0]  # blue is preferred (ties by name), then other colours, then none


def test_every_query_fits_its_own_search(spark, monkeypatch):
    """No result of an earlier run is returned for the same folder."""
    from cartograph.plans import queries_ml

    searched = []
    monkeypatch.setattr(queries_ml, "_splits", lambda spark, sf: ("train", "test"))
    monkeypatch.setattr(ml, "staged_search", lambda train: searched.append(train) or (None, len(searched)))
    monkeypatch.setattr(ml, "score_predictions", lambda model, df: spark.range(3))
    monkeypatch.setattr(ml, "best_params", lambda model: {"fit": model})
    assert [queries_ml.q_best(spark, "same folder").first().fit for _ in range(2)] == [1, 2]


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    """A task of the ALS holds a block, so blocks are of bounded size; the factors still find each group's own articles."""
    from pyspark.ml.recommendation import ALS

    fits, fit = [], ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, data: fits.append((self.getNumUserBlocks(), self.getNumItemBlocks(), self.getIntermediateStorageLevel())) or fit(self, data))
    rows = [("2020-01-01", f"{g}{i}", 100 * g + j, 1.0, 1) for g in (1, 2) for i in range(20) for j in range(15)]
    small = recommend.als_recommender(tx_of(spark, rows), k=5, max_iter=3).count()
    monkeypatch.setattr(recommend, "RATINGS", 40)
    got = recommend.als_recommender(tx_of(spark, rows), k=5, max_iter=3).collect()
    assert small == len(got) == 40 * 5 and fits == [(10, 10, "DISK_ONLY"), (15, 15, "DISK_ONLY")]
    assert all(r.article_id // 100 == int(r.customer_id[0]) for r in got)
