"""The models of a search that grow together against Spark's, fitted one by one."""

from itertools import product

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartograph.operators import boosting, ml


def rows_of(spark, n=600):
    """Two numbers, one with few and one with many values, and a flag; the label follows them with noise."""
    rng = np.random.default_rng(1)
    few, many, flag = rng.integers(0, 6, n).astype(float), rng.random(n), (rng.random(n) < 0.1).astype(float)
    label = (few + 6 * many * many + 4 * flag + rng.normal(0, 2, n) > 5).astype(float)
    rows = [(int(i), *map(float, r)) for i, r in enumerate(zip(few, many, flag, label))]
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame(rows, "key long, few double, many double, flag double, label double")
    df = VectorAssembler(inputCols=["few", "many", "flag"], outputCol="features").transform(df)
    return df.select("features", "label", F.lit(1.0).alias("weight"), F.pmod(F.xxhash64("key"), F.lit(2)).cast("int").alias("fold"), "key").cache()


@pytest.mark.parametrize("slice_rows", [8192, 100])
def test_scores_are_those_of_sparks_own_fits(spark, monkeypatch, slice_rows):
    """Every fold, setting and number of trees, whether rows lie in one slice or several; models of two depths in one group."""
    monkeypatch.setattr(boosting, "SLICE", slice_rows)
    data = rows_of(spark)
    settings = [boosting.Setting(maxDepth=2, stepSize=0.1), boosting.Setting(maxDepth=4, stepSize=0.3)]
    for n, groups, held in boosting.cross_validated(data, settings, [2, 6], 2, seed=5, flags=1):
        got = held.collect()
        for g, (fold, own) in enumerate(groups):
            for j, p in enumerate(own):
                est = ml.gbt(5).setParams(labelCol="label", maxDepth=settings[p].maxDepth, stepSize=settings[p].stepSize, maxIter=n)
                scored = est.fit(data.where(F.col("fold") != fold)).transform(data.where(F.col("fold") == fold))
                want = sorted((r[0], r[1]) for r in scored.select("label", vector_to_array("rawPrediction")[1]).collect())
                mine = sorted((r["label"], r["scores"][j]) for r in got if r["group"] == g)
                assert len(want) == len(mine) > 200
                assert np.abs(np.array(want) - np.array(mine)).max() < 1e-6, (n, fold, settings[p])


def test_drawn_rows_and_features_change_scores_and_repeat(spark):
    data = rows_of(spark)
    settings = [boosting.Setting(3, 0.1, rate, share) for rate in (0.5, 1.0) for share in ("0.5", "all")]

    def scores():
        (_, groups, held), = boosting.cross_validated(data, settings, [4], 2, seed=5, flags=1)
        of = {(i, p): (g, j) for g, (i, own) in enumerate(groups) for j, p in enumerate(own)}
        rows = held.collect()
        return {k: sorted(r["scores"][j] for r in rows if r["group"] == g) for k, (g, j) in of.items()}

    first, second = scores(), scores()
    assert first == second
    assert len({tuple(first[0, p]) for p in range(4)}) == 4


def test_a_search_takes_a_job_a_level_not_one_a_model(spark):
    """Twice the models, the same jobs."""
    data, tracker = rows_of(spark, 200), spark.sparkContext.statusTracker()

    def jobs(settings):
        spark.sparkContext.setJobGroup(f"search of {len(settings)}", "")
        list(boosting.cross_validated(data, settings, [5], 2, seed=5, flags=1))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(f"search of {len(settings)}"))

    settings = [boosting.Setting(3, 0.1 + i / 100) for i in range(8)]
    assert jobs(settings[:2]) + 4 > jobs(settings)


def test_thresholds():
    assert boosting.thresholds(np.array([3.0, 1, 1, 2]), np.ones(4)).tolist() == [1.5, 2.5]
    many = boosting.thresholds(np.arange(1000.0), np.ones(1000))
    assert len(many) <= boosting.MAX_BINS - 1 and np.abs(np.diff(many) - 1000 / boosting.MAX_BINS).max() <= 1


def test_shares_of_features():
    assert boosting.Setting(featureSubsetStrategy="0.8").features(7) == 6 and boosting.Setting().features(7) == 7
    with pytest.raises(ValueError):
        boosting.Setting(featureSubsetStrategy="8").features(7)


def test_every_point_of_the_searches_is_a_setting():
    for grid, points in ((ml.GBT_GRID, 8), (ml.WIDE_GRID, 36)):
        names = [k for k in grid if k != "maxIter"]
        made = {boosting.Setting(**dict(zip(names, p))) for p in product(*[grid[k] for k in names])}
        assert len(made) == points and all(s.features(25) in (20, 25) for s in made)


def test_stored_scores_are_removed(spark, monkeypatch):
    import os
    from urllib.parse import urlparse

    stored, drop = [], boosting._drop

    def noted(spark, path):
        stored.append((path, path is not None and os.path.exists(urlparse(path).path)))
        drop(spark, path)

    monkeypatch.setattr(boosting, "KEEP", 2)
    monkeypatch.setattr(boosting, "_drop", noted)
    (_, _, held), = boosting.cross_validated(rows_of(spark, 200), [boosting.Setting(2)], [6], 2, seed=5, flags=1)
    paths = [p for p, there in stored if there]
    assert len(paths) == 3 and not any(os.path.exists(urlparse(p).path) for p in paths)
    assert held.count() == 200


def scores_of(data, settings, trees=4):
    """{(fold, place of the setting): sorted (label, score)} of one search."""
    (_, groups, held), = boosting.cross_validated(data, settings, [trees], 2, seed=5, flags=1)
    rows = held.collect()
    return {(i, p): sorted((r["label"], r["scores"][j]) for r in rows if r["group"] == g) for g, (i, own) in enumerate(groups) for j, p in enumerate(own)}


def test_whole_trees_are_those_of_a_job_a_level(spark, monkeypatch):
    """Also with drawn rows and features; the level's jobs have one slice, so that they draw the same rows."""
    data = rows_of(spark, 900)
    settings = [boosting.Setting(3, 0.1), boosting.Setting(3, 0.3, 0.8, "0.5"), boosting.Setting(1, 0.1)]
    whole = scores_of(data, settings)
    monkeypatch.setattr(boosting, "WHOLE", 0)
    by_level = scores_of(data, settings)
    assert whole.keys() == by_level.keys() and len(whole) == 6
    for k in whole:
        assert np.abs(np.array(whole[k]) - np.array(by_level[k])).max() < 1e-6, k


def test_a_small_search_takes_a_job_for_many_trees(spark):
    """20 trees of 3 levels: a job a level would be more than 60."""
    data, tracker = rows_of(spark, 200), spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("a search of 20 trees", "")
    list(boosting.cross_validated(data, [boosting.Setting(3)], [20], 2, seed=5, flags=1))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(tracker.getJobIdsForGroup("a search of 20 trees")) < 25


def test_the_last_fit_is_sparks_own_model(spark, tmp_path):
    """The same predictions, nodes' gains and importances as Spark's own fit; it can be stored and keeps its settings."""
    data = rows_of(spark)
    est = ml.gbt(5).setParams(labelCol="label", maxDepth=3, stepSize=0.3, maxIter=5)
    mine, own = boosting.fitted(data, est, 5, flags=1), est.fit(data)
    one, two = ([r[0] for r in m.transform(data).orderBy("key").select(vector_to_array("probability")[1]).collect()] for m in (mine, own))
    assert np.abs(np.array(one) - np.array(two)).max() < 1e-6
    assert np.abs(mine.featureImportances.toArray() - own.featureImportances.toArray()).max() < 1e-6
    assert mine.treeWeights == own.treeWeights and mine.getOrDefault("maxIter") == 5 and mine.getOrDefault("stepSize") == 0.3
    mine.write().overwrite().save(str(tmp_path / "model"))
    assert type(mine).load(str(tmp_path / "model")).totalNumNodes == own.totalNumNodes


def test_features_of_one_value_are_never_cut():
    cell = {"bins": np.zeros((2, 6), dtype=np.uint8), "train": np.ones(6, dtype=bool)}
    given = boosting.Whole(cell).tree(3, np.array([1.0, 1, 1, -1, -1, 4]), cell["train"], lambda level, nodes: None)
    assert np.abs(given - 5 / 6).max() < 1e-12


def test_auc_of_all_models_in_one_pass(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rng = np.random.default_rng(3)
    rows = [(g, float(rng.random() < 0.4), [float(x) for x in np.round(rng.random(2), 1)]) for g in (0, 1) for _ in range(300)] + [(2, 1.0, [0.5, 0.1])]
    held = spark.createDataFrame(rows, "group int, label double, scores array<double>")
    got, evaluator = ml.group_auc(held), BinaryClassificationEvaluator(labelCol="label")
    for g in (0, 1, 2):
        for j in (0, 1):
            want = evaluator.evaluate(held.where(F.col("group") == g).select("label", F.col("scores")[j].alias("rawPrediction")))
            assert abs(got[g, j] - want) < 1e-9
