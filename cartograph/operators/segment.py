"""Customer segmentation (k-means on scaled RFM) and next-purchase timing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.dates import as_date
from cartograph.functions.joins import materialize
from cartograph.operators.store import SEGMENT_BOUNDS

RFM_COLUMNS = ["days_since_last_purchase", "total_purchases", "total_spend"]


def kmeans_segments(features: DataFrame, k: int = 6, columns=RFM_COLUMNS, seed: int = 42,
                    max_iter: int = 20):
    """(assignments, silhouette): k-means (k-means|| init) on standardised RFM."""
    from pyspark.ml.clustering import KMeans
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="skip"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="segment")])
    features = materialize(features.select("customer_id", *columns))  # scaled, fitted, scored and evaluated
    model = pipe.fit(features)
    out = model.transform(features)
    sil = ClusteringEvaluator(featuresCol="features", predictionCol="segment").evaluate(out)
    return out.select("customer_id", "segment", *columns), sil


def choose_segments(features: DataFrame, ks: Sequence[int] = (6, 7, 8), columns=RFM_COLUMNS, seed: int = 42):
    """k-means for each number of segments: (assignments of the one with the best silhouette, comparison).

    The comparison has k, silhouette and the summed squared distance within the
    segments.  The scaled features are computed once for all fits.
    """
    from pyspark.ml.clustering import KMeans
    raw = materialize(features.select("customer_id", *columns))
    scale = Pipeline(stages=[VectorAssembler(inputCols=list(columns), outputCol="_raw", handleInvalid="skip"),
                             StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)])
    scaled = materialize(scale.fit(raw).transform(raw))
    judge, found = ClusteringEvaluator(featuresCol="features", predictionCol="segment"), []
    for k in ks:
        model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="segment").fit(scaled)
        found.append((k, float(judge.evaluate(model.transform(scaled))), float(model.summary.trainingCost), model))
    best = max(found, key=lambda f: (f[1], -f[0]))
    comparison = features.sparkSession.createDataFrame([f[:3] for f in found], "k int, silhouette double, within_ss double")
    return best[3].transform(scaled).select("customer_id", "segment", *columns), comparison


def segment_profile(assigned: DataFrame, columns=RFM_COLUMNS) -> DataFrame:
    return assigned.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"),
                                           *[F.avg(c).alias(f"avg_{c}") for c in columns])


def next_purchase_rows(tx: DataFrame, before: str | None = None) -> DataFrame:
    """One row per (customer, shopping day) that has a next shopping day.

    target = days to the next shopping day; features known on that day: the
    previous gap, items bought, weekday, month and the customer's running mean
    gap.  Windows run per customer over ≤ one row per calendar day.
    """
    t = tx if before is None else tx.filter(F.col("t_dat") < as_date(before))
    days = t.groupBy("customer_id", "t_dat").agg(F.count(F.lit(1)).alias("items"))
    w = Window.partitionBy("customer_id").orderBy("t_dat")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    d = (days.withColumn("next_date", F.lead("t_dat").over(w))
             .withColumn("prev_gap", F.datediff("t_dat", F.lag("t_dat").over(w)))
             .withColumn("mean_gap_so_far", F.avg("prev_gap").over(run))
             .withColumn("day_number", F.row_number().over(w)))
    return d.filter(F.col("next_date").isNotNull()).select(
        "customer_id", "t_dat", F.datediff("next_date", "t_dat").alias("target"),
        F.coalesce(F.col("prev_gap"), F.lit(-1)).cast("double").alias("prev_gap"),
        F.coalesce(F.col("mean_gap_so_far"), F.lit(-1.0)).alias("mean_gap_so_far"),
        F.col("items").cast("double").alias("items"), F.dayofweek("t_dat").cast("double").alias("dow"),
        F.month("t_dat").cast("double").alias("month"), F.col("day_number").cast("double").alias("day_number"))


def next_purchase_inputs(tx: DataFrame, articles: DataFrame, before: str | None = None,
                         group_col: str = "product_group_name", bounds: dict | None = None) -> DataFrame:
    """``next_purchase_rows`` with what a customer's history says on that day.

    ``median_gap`` and ``std_gap`` are of the gaps up to the day (−1 without one,
    and without two); ``category`` is the group bought most often up to and
    including the day, ties by name; ``lifecycle`` follows the segment rules with
    the gap before the day as recency.  Nothing after the day is read but the
    target.

    The median's state is the count of each gap length, carried along a
    customer's days; the category's is the running count of each group, whose
    largest so far leads because counts only grow.  A customer has one row a day
    (and group), so no state grows beyond the calendar.
    """
    b = {**SEGMENT_BOUNDS, **(bounds or {})}
    rows = next_purchase_rows(tx, before)
    run = Window.partitionBy("customer_id").orderBy("t_dat").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.when(F.col("prev_gap") >= 0, F.col("prev_gap"))
    tenure = F.date_diff("t_dat", F.min("t_dat").over(run))
    lifecycle = (F.when(F.col("prev_gap") > b["dormant_recency"], "dormant").when(F.col("prev_gap") > b["at_risk_recency"], "at_risk")
                 .when(tenure < b["new_tenure"], "new").otherwise("loyal"))
    known = rows.select("*", F.coalesce(F.percentile(gap, 0.5).over(run), F.lit(-1.0)).alias("median_gap"),
                        F.coalesce(F.stddev_samp(gap).over(run), F.lit(-1.0)).alias("std_gap"), lifecycle.alias("lifecycle"))
    t = tx if before is None else tx.filter(F.col("t_dat") < as_date(before))
    bought = (t.groupBy("customer_id", "t_dat", "article_id").agg(F.count(F.lit(1)).alias("n"))
              .join(articles.select("article_id", F.col(group_col).alias("group")), "article_id")
              .where(F.col("group").isNotNull()).groupBy("customer_id", "t_dat", "group").agg(F.sum("n").alias("n")))
    of_group = Window.partitionBy("customer_id", "group").orderBy("t_dat").rowsBetween(Window.unboundedPreceding, 0)
    # Days on which nothing with a group was bought keep the leader of the days before.
    days = rows.select("customer_id", "t_dat").join(
        bought.withColumn("sofar", -F.sum("n").over(of_group)).groupBy("customer_id", "t_dat").agg(
            F.min(F.struct("sofar", "group")).alias("best")), ["customer_id", "t_dat"], "full")
    lead = days.withColumn("category", F.min("best").over(run)["group"]).select("customer_id", "t_dat", "category")
    return known.join(lead, ["customer_id", "t_dat"], "left")


def regression_metrics(pred: DataFrame, label: str = "target", prediction: str = "prediction",
                       tolerance: float = 7.0) -> DataFrame:
    err = F.col(prediction) - F.col(label)
    return pred.agg(F.avg(F.abs(err)).alias("mae"), F.sqrt(F.avg(err * err)).alias("rmse"),
                    (F.avg((F.abs(err) <= tolerance).cast("double")) * 100.0).alias("pct_within_7d"),
                    F.count(F.lit(1)).alias("rows"))


def median_baseline(rows: DataFrame) -> DataFrame:
    """Predict the median target for every row (the exact median's buffer holds one
    entry per distinct gap length, ≤ days in the calendar)."""
    med = rows.agg(F.median("target")).scalar()
    return regression_metrics(rows.withColumn("prediction", med)).withColumn("median_days", med)


def next_purchase_regression(rows: DataFrame, train_frac_bucket: int = 80, num_trees: int = 20, seed: int = 42):
    """Random-forest regressor on a customer-hash split; the test metrics beside those of the training median.

    Inputs are the numeric columns of ``rows``; ``category`` and ``lifecycle``,
    where ``rows`` has them, as indices (values the training rows lack are one more).
    """
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.regression import RandomForestRegressor

    from cartograph.operators.clean import hash_bucket
    rows = materialize(rows.withColumn("target", F.col("target").cast("double")))
    codes = [c for c in ("category", "lifecycle") if c in rows.columns]
    feats = [c for c in rows.columns if c not in ("customer_id", "t_dat", "target", *codes)]
    b = hash_bucket("customer_id")
    train, test = rows.filter(b < train_frac_bucket), rows.filter(b >= train_frac_bucket)
    groups = max([1, *(train.select(c).distinct().count() for c in codes)])
    pipe = Pipeline(stages=[*[StringIndexer(inputCol=c, outputCol=f"{c}_code", handleInvalid="keep") for c in codes],
                            VectorAssembler(inputCols=[*feats, *[f"{c}_code" for c in codes]], outputCol="features"),
                            RandomForestRegressor(labelCol="target", featuresCol="features", maxBins=max(32, groups + 1),
                                                  numTrees=num_trees, seed=seed)])
    model = pipe.fit(train)
    median = train.agg(F.median("target")).scalar()
    base = regression_metrics(test.withColumn("prediction", median)).select(
        F.col("mae").alias("baseline_mae"), F.col("rmse").alias("baseline_rmse"))
    return regression_metrics(model.transform(test)).select("*", *[base.select(c).scalar().alias(c) for c in base.columns])
