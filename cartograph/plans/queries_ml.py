"""Queries: churn models, metrics, recommenders, MAP@12, segmentation, next purchase.

Model fits are randomised or iterative, so those queries carry no SQL oracle
(rows-only check).  Metrics are checked exactly on a fixed, data-derived score
(recency), and recommenders are checked against brute-force SQL.
Both boosted searches run their whole grids; all models of a search grow their
trees together (``operators.boosting``; times in the README).
"""

from __future__ import annotations

import os

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cartograph.operators import clean, ml, recommend, segment, similarity
from cartograph.plans.oracle import D, R, churn_feature_ctes, with_
from cartograph.plans.queries_core import CUT, END, churn_features_df
from cartograph.plans.queries_quality import CLEAN_CTES, _store_dir, cleaned_df
from cartograph.plans.registry import register
from cartograph.sources import adapters as ad
from cartograph.sources import writers
from cartograph.sources.schemas import CATEGORICAL_MODEL_FEATURES, NUMERIC_MODEL_FEATURES

FW = f"t_dat BETWEEN {D(ad.FINAL_WEEK_START)} AND {D(ad.FINAL_WEEK_END)}"


def _splits(spark, sf):
    tr, _va, te = clean.hash_split(cleaned_df(spark, sf))
    return tr, te


# ---------------------------------------------------------------- models (rows-only)

def _codes_sql(c: str) -> str:
    """Category codes by descending frequency, ties by value; the domain has no nulls after cleaning."""
    return (f"code_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS DOUBLE) AS code "
            f"FROM cleaned GROUP BY {c})")


@register("encode_features", with_(*CLEAN_CTES, *[_codes_sql(c) for c in CATEGORICAL_MODEL_FEATURES]) + f"""
SELECT customer_id, is_churned, CAST({len(NUMERIC_MODEL_FEATURES)} + (SELECT count(*) FROM code_club_member_status)
         + (SELECT count(*) FROM code_fashion_news_frequency) AS INTEGER) AS feature_count,
       a.code AS status_code, b.code AS news_code,
       {R(' + '.join(f'CAST({c} AS DOUBLE)' for c in NUMERIC_MODEL_FEATURES))} AS numeric_sum
FROM cleaned JOIN code_club_member_status a USING (club_member_status)
JOIN code_fashion_news_frequency b USING (fashion_news_frequency)""")
def q_encode(spark, sf):
    """Length of the vector, both category codes, the numeric inputs' sum: taken from the vector itself."""
    enc = ml.encode_features(cleaned_df(spark, sf))
    v, n = vector_to_array("features"), len(NUMERIC_MODEL_FEATURES)
    total = F.aggregate(F.slice(v, 1, n), F.lit(0.0), lambda a, x: a + x)
    return enc.select("customer_id", "is_churned", F.size(v).alias("feature_count"),
                      F.col("code_of_club_member_status").alias("status_code"),
                      F.col("code_of_fashion_news_frequency").alias("news_code"), total.alias("numeric_sum"))


@register("churn_gbt")
def q_gbt(spark, sf):
    tr, te = _splits(spark, sf)
    return ml.score_predictions(ml.churn_gbt(tr), te)


@register("cv_grid_search")
def q_cv(spark, sf):
    """All 16 grid points with their cross-validated AUC, and the best one's AUC on the test rows."""
    tr, te = _splits(spark, sf)
    results, model = ml.staged_search(tr)
    auc = ml.classification_metrics(ml.score_predictions(model, te)).select("auc_roc").scalar()
    return results.withColumn("best_test_auc", auc)


@register("churn_boosted_wide")
def q_wide(spark, sf):
    tr, te = _splits(spark, sf)
    return ml.score_predictions(ml.churn_boosted_wide(tr), te)


@register("score_predictions")
def q_score(spark, sf):
    """Scored test set persisted and read back, then the predicted-class distribution."""
    tr, te = _splits(spark, sf)
    scored = ml.score_predictions(ml.churn_gbt(tr), te)
    path = _store_dir(spark, f"predictions-{os.path.basename(sf)}")
    writers.write_predictions(scored, path)
    return ml.prediction_distribution(spark.read.parquet(path))


@register("best_params")
def q_best(spark, sf):
    tr, te = _splits(spark, sf)
    _, model = ml.staged_search(tr)
    scored = ml.score_predictions(model, te)
    return scored.agg(F.count(F.lit(1)).alias("test_rows")).select(
        "test_rows", *[F.lit(v).alias(k) for k, v in ml.best_params(model).items()])


@register("evaluator_metrics")
def q_evaluators(spark, sf):
    tr, te = _splits(spark, sf)
    scored = ml.score_predictions(ml.churn_gbt(tr), te)
    m = ml.evaluator_metrics(scored)
    return scored.agg(F.count(F.lit(1)).alias("test_rows")).select(
        "test_rows", *[F.lit(float(v)).alias(k) for k, v in m.items()])


@register("model_classification_metrics")
def q_model_metrics(spark, sf):
    tr, te = _splits(spark, sf)
    return ml.classification_metrics(ml.score_predictions(ml.churn_gbt(tr), te))


# ---------------------------------------------------------------- metrics on a fixed score (exact)

SCORED = """sc AS (SELECT customer_id, is_churned,
  CASE WHEN CAST(days_since_last_purchase AS DOUBLE) / 180.0 > 1.0 THEN 1.0
       ELSE CAST(days_since_last_purchase AS DOUBLE) / 180.0 END AS s,
  CASE WHEN days_since_last_purchase > 60 THEN 1 ELSE 0 END AS p FROM feat)"""


def _scored(spark, sf):
    return ml.rule_scores(churn_features_df(spark, sf))


@register("classification_metrics", with_(*churn_feature_ctes(CUT, END), SCORED) + f"""
, ps AS (SELECT s, sum(is_churned) AS pos, sum(1 - is_churned) AS neg FROM sc GROUP BY s),
pc AS (SELECT pos, neg, sum(pos) OVER (ORDER BY s DESC) AS pos_cum FROM ps),
au AS (SELECT sum(neg * (pos_cum - pos + pos * 0.5)) AS num FROM pc),
cm AS (SELECT count(*) AS n, CAST(count_if(is_churned = 1 AND p = 1) AS BIGINT) AS tp,
              CAST(count_if(is_churned = 0 AND p = 0) AS BIGINT) AS tn,
              CAST(count_if(is_churned = 0 AND p = 1) AS BIGINT) AS fp,
              CAST(count_if(is_churned = 1 AND p = 0) AS BIGINT) AS fn FROM sc)
SELECT {R('(SELECT num FROM au) / ((tp + fn) * (tn + fp))')} AS auc_roc, {R('(tp + tn) / n')} AS accuracy,
       {R('(tp + fn) / n * coalesce(tp / (tp + fp), 0.0) + (tn + fp) / n * coalesce(tn / (tn + fn), 0.0)')}
         AS weighted_precision,
       {R('(tp + fn) / n * coalesce(tp / (tp + fn), 0.0) + (tn + fp) / n * coalesce(tn / (tn + fp), 0.0)')}
         AS weighted_recall, tp, tn, fp, fn FROM cm""")
def q_class_metrics(spark, sf):
    return ml.classification_metrics(_scored(spark, sf))


@register("precision_at_k_pct", with_(*churn_feature_ctes(CUT, END), SCORED) + f"""
, rk AS (SELECT *, row_number() OVER (ORDER BY s DESC, customer_id) AS rank FROM sc),
nn AS (SELECT count(*) AS n FROM sc)
SELECT {R('count_if(rank <= floor(n * CAST(0.05 AS DOUBLE)) AND is_churned = 1) / floor(n * CAST(0.05 AS DOUBLE))')}
         AS precision_at_5pct,
       {R('count_if(rank <= floor(n * CAST(0.1 AS DOUBLE)) AND is_churned = 1) / floor(n * CAST(0.1 AS DOUBLE))')}
         AS precision_at_10pct,
       {R('count_if(rank <= floor(n * CAST(0.2 AS DOUBLE)) AND is_churned = 1) / floor(n * CAST(0.2 AS DOUBLE))')}
         AS precision_at_20pct,
       {R('1.0 - (5.0 * count_if(is_churned = 1 AND p = 0) + 1.0 * count_if(is_churned = 0 AND p = 1)) / (5.0 * count(*))')}
         AS cost_weighted_accuracy FROM rk, nn GROUP BY n""")
def q_prec_at_k(spark, sf):
    return ml.precision_at_k_pct(_scored(spark, sf))


@register("class_weights", with_(*churn_feature_ctes(CUT, END)) + f"""
SELECT is_churned, count(*) AS n_class,
       {R('(SELECT count(*) FROM feat) / ((SELECT count(DISTINCT is_churned) FROM feat) * count(*))')} AS class_weight
FROM feat GROUP BY is_churned""")
def q_class_weights(spark, sf):
    return ml.class_weights(churn_features_df(spark, sf))


# ---------------------------------------------------------------- recommenders

POP = f"""pop AS (SELECT article_id, count(*) AS popularity FROM tx WHERE t_dat < {D(ad.HISTORY_BEFORE)}
  GROUP BY article_id)"""
TOP = """top AS (SELECT article_id, popularity, row_number() OVER (ORDER BY popularity DESC, article_id) AS rank
  FROM pop QUALIFY rank <= 12)"""


@register("interaction_matrix", with_() + """
SELECT customer_id, article_id, count(*) AS purchase_count FROM tx GROUP BY 1, 2""")
def q_interactions(spark, sf):
    return recommend.interaction_matrix(ad.transactions(spark, sf))


@register("popularity_recommender", with_(POP, TOP) + "SELECT article_id, popularity, CAST(rank AS INTEGER) AS rank FROM top")
def q_pop_rec(spark, sf):
    return recommend.popularity_recommender(ad.transactions(spark, sf), 12, ad.HISTORY_BEFORE)


@register("category_popularity_recommender", with_(POP) + """
SELECT article_id, popularity, product_group_name, CAST(rank AS INTEGER) AS rank FROM (
  SELECT p.article_id, p.popularity, a.product_group_name,
         row_number() OVER (PARTITION BY a.product_group_name ORDER BY p.popularity DESC, p.article_id) AS rank
  FROM pop p JOIN art a ON p.article_id = a.article_id) x WHERE rank <= 12""")
def q_cat_pop(spark, sf):
    return recommend.category_popularity_recommender(ad.transactions(spark, sf), ad.articles(spark, sf), 12,
                                                     ad.HISTORY_BEFORE)


@register("recency_weighted_popularity", with_() + f"""
SELECT article_id, score, CAST(row_number() OVER (ORDER BY score DESC, article_id) AS INTEGER) AS rank
FROM (SELECT article_id, {R(f"sum(exp(-ln(2.0) / 30.0 * date_diff('day', t_dat, {D(ad.HISTORY_BEFORE)})))")} AS score
      FROM tx WHERE t_dat < {D(ad.HISTORY_BEFORE)} GROUP BY article_id) s
ORDER BY score DESC, article_id LIMIT 12""")
def q_recency_pop(spark, sf):
    return recommend.recency_weighted_popularity(ad.transactions(spark, sf), ad.HISTORY_BEFORE, 12)


PREFS = f"""tra AS (SELECT t.*, a.product_group_name, a.colour_group_name FROM tx t LEFT JOIN art a
  ON t.article_id = a.article_id WHERE t.t_dat < {D(ad.HISTORY_BEFORE)}),
pcat AS (SELECT customer_id, v AS cat FROM (SELECT customer_id, product_group_name AS v,
  row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, product_group_name) AS rn
  FROM tra WHERE product_group_name IS NOT NULL GROUP BY 1, 2) x WHERE rn = 1),
pcol AS (SELECT customer_id, v AS col FROM (SELECT customer_id, colour_group_name AS v,
  row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, colour_group_name) AS rn
  FROM tra WHERE colour_group_name IS NOT NULL GROUP BY 1, 2) x WHERE rn = 1),
content AS (SELECT customer_id, article_id, CAST(rank AS INTEGER) AS rank FROM (
  SELECT c.customer_id, p.article_id, row_number() OVER (PARTITION BY c.customer_id
         ORDER BY (a.colour_group_name = l.col) DESC, p.popularity DESC, p.article_id) AS rank
  FROM pcat c JOIN pcol l ON c.customer_id = l.customer_id
  JOIN art a ON a.product_group_name = c.cat JOIN pop p ON p.article_id = a.article_id) x WHERE rank <= 12)"""


SIMILAR = f"""vals AS (
  SELECT article_id, 'product_type_name' AS attr, product_type_name AS v FROM art WHERE product_type_name IS NOT NULL UNION ALL
  SELECT article_id, 'product_group_name', product_group_name FROM art WHERE product_group_name IS NOT NULL UNION ALL
  SELECT article_id, 'colour_group_name', colour_group_name FROM art WHERE colour_group_name IS NOT NULL UNION ALL
  SELECT article_id, 'garment_group_name', garment_group_name FROM art WHERE garment_group_name IS NOT NULL),
rare AS (SELECT attr, v, ln(1 + (SELECT count(*) FROM art) / count(*)) AS w FROM vals GROUP BY 1, 2),
av AS (SELECT article_id, attr, v, w FROM vals JOIN rare USING (attr, v)),
an AS (SELECT article_id, sqrt(sum(w * w)) AS norm FROM av GROUP BY 1),
prof AS (SELECT customer_id, attr, v, w, count(*) AS n FROM tx JOIN av USING (article_id) WHERE t_dat < {D(ad.HISTORY_BEFORE)} GROUP BY ALL),
pn AS (SELECT customer_id, sqrt(sum(n * w * n * w)) AS norm FROM prof GROUP BY 1),
cosines AS (SELECT p.customer_id, a.article_id, sum(p.n * p.w * a.w) AS dot FROM prof p JOIN av a USING (attr, v) GROUP BY 1, 2),
similar_ AS (SELECT customer_id, article_id, {R('dot / pn.norm / an.norm')} AS score, coalesce(popularity, 0) AS popularity
  FROM cosines JOIN pn USING (customer_id) JOIN an USING (article_id) LEFT JOIN pop USING (article_id))"""


@register("content_recommender", with_(POP, SIMILAR) + """
SELECT customer_id, article_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, popularity DESC, article_id) AS rank FROM similar_)
WHERE rank <= 12""")
def q_similar(spark, sf):
    return similarity.similarity_recommender(ad.transactions(spark, sf), ad.articles(spark, sf), ad.HISTORY_BEFORE)


@register("preferred_category_recommender", with_(POP, PREFS) + "SELECT * FROM content")
def q_content(spark, sf):
    return recommend.content_recommender(ad.transactions(spark, sf), ad.articles(spark, sf), ad.HISTORY_BEFORE)


LADDER = """everyone AS (SELECT DISTINCT customer_id FROM cust),
steps AS (
  SELECT e.customer_id, p.article_id, CASE WHEN a.product_group_name = c.cat AND a.colour_group_name = l.col THEN 0
           WHEN a.product_group_name = c.cat THEN 1 ELSE 2 END AS step, p.popularity
  FROM everyone e LEFT JOIN pcat c ON e.customer_id = c.customer_id LEFT JOIN pcol l ON e.customer_id = l.customer_id
  CROSS JOIN pop p LEFT JOIN art a ON p.article_id = a.article_id),
fits AS (
  SELECT customer_id, article_id, step, row_number() OVER (PARTITION BY customer_id ORDER BY step, popularity DESC, article_id) AS r,
         row_number() OVER (PARTITION BY customer_id, step ORDER BY popularity DESC, article_id) AS place
  FROM steps),
ladder AS (SELECT customer_id, article_id, CAST(r AS INTEGER) AS rank,
  CASE step WHEN 0 THEN 'group and colour' WHEN 1 THEN 'group' ELSE 'global' END AS rung FROM fits WHERE r <= 12)"""


@register("ladder_recommender", with_(POP, PREFS, LADDER) + "SELECT * FROM ladder")
def q_ladder(spark, sf):
    return recommend.ladder_recommender(ad.transactions(spark, sf), ad.articles(spark, sf), ad.customers(spark, sf), ad.HISTORY_BEFORE)


@register("hybrid_recommender", with_(POP, PREFS, LADDER) + """
, parts AS (SELECT customer_id, article_id, CAST(0.4 AS DOUBLE) * (13 - rank) AS s FROM ladder
            UNION ALL SELECT customer_id, article_id, CAST(0.6 AS DOUBLE) * (13 - rank) FROM content),
bl AS (SELECT customer_id, article_id, round(sum(s) * 1e6) / 1e6 AS score FROM parts GROUP BY 1, 2)
SELECT customer_id, article_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, article_id) AS rank FROM bl) x
WHERE rank <= 12""")
def q_hybrid(spark, sf):
    return recommend.hybrid_recommender(ad.transactions(spark, sf), ad.articles(spark, sf),
                                        ad.customers(spark, sf), ad.HISTORY_BEFORE)


MAP_SQL = """act AS (SELECT DISTINCT customer_id, article_id FROM tx WHERE {fw}),
hits AS (SELECT a.customer_id, r.rank FROM act a JOIN {recs} r ON {join}),
hc AS (SELECT customer_id, rank, count(*) OVER (PARTITION BY customer_id ORDER BY rank
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM hits),
apn AS (SELECT customer_id, sum(cum / rank) AS num FROM hc GROUP BY customer_id),
na AS (SELECT customer_id, count(*) AS n FROM act GROUP BY customer_id)
SELECT {avg} AS map_at_12, count(*) AS customers FROM na LEFT JOIN apn ON na.customer_id = apn.customer_id"""


@register("map_at_12", with_(POP, TOP) + ", " + MAP_SQL.format(
    fw=FW, recs="top", join="a.article_id = r.article_id",
    avg=R("avg(coalesce(num, 0.0) / least(n, 12))")))
def q_map(spark, sf):
    tx = ad.transactions(spark, sf)
    top = recommend.popularity_recommender(tx, 12, ad.HISTORY_BEFORE)
    return recommend.map_at_k_global(top, recommend.actual_purchases(tx, ad.FINAL_WEEK_START, ad.FINAL_WEEK_END))


@register("map_at_12_content", with_(POP, PREFS) + ", " + MAP_SQL.format(
    fw=FW, recs="content", join="a.customer_id = r.customer_id AND a.article_id = r.article_id",
    avg=R("avg(coalesce(num, 0.0) / least(n, 12))")))
def q_map_content(spark, sf):
    tx = ad.transactions(spark, sf)
    recs = recommend.content_recommender(tx, ad.articles(spark, sf), ad.HISTORY_BEFORE)
    return recommend.map_at_k(recs, recommend.actual_purchases(tx, ad.FINAL_WEEK_START, ad.FINAL_WEEK_END))


@register("als_recommender")
def q_als(spark, sf):
    return recommend.als_recommender(ad.transactions(spark, sf), ad.HISTORY_BEFORE, 12)


# ---------------------------------------------------------------- segmentation and next purchase

@register("kmeans_segments")
def q_kmeans(spark, sf):
    assigned, sil = segment.kmeans_segments(churn_features_df(spark, sf), k=6)
    return segment.segment_profile(assigned).withColumn("silhouette", F.lit(float(sil)))


@register("segment_selection")
def q_segment_selection(spark, sf):
    """6, 7 and 8 segments over purchase, basket and channel behaviour, compared by silhouette and within-segment squares."""
    columns = [*segment.RFM_COLUMNS, "purchase_frequency", "online_ratio", "weekend_ratio"]
    assigned, comparison = segment.choose_segments(churn_features_df(spark, sf), columns=columns)
    return comparison.withColumn("customers", assigned.agg(F.count(F.lit(1))).scalar())


NP = """days AS (SELECT customer_id, t_dat, lead(t_dat) OVER (PARTITION BY customer_id ORDER BY t_dat) AS nxt
  FROM (SELECT DISTINCT customer_id, t_dat FROM tx) d),
rows_ AS (SELECT date_diff('day', t_dat, nxt) AS target FROM days WHERE nxt IS NOT NULL),
med AS (SELECT median(target) AS m FROM rows_)"""


@register("next_purchase_baseline", with_(NP) + f"""
SELECT {R('avg(abs(m - target))')} AS mae, {R('sqrt(avg((m - target) * (m - target)))')} AS rmse,
       {R('avg(CAST(abs(m - target) <= 7.0 AS DOUBLE)) * 100.0')} AS pct_within_7d, count(*) AS rows,
       {R('m')} AS median_days FROM rows_, med GROUP BY m""")
def q_np_baseline(spark, sf):
    return segment.median_baseline(segment.next_purchase_rows(ad.transactions(spark, sf)))


NPI = """ds AS (SELECT customer_id, t_dat, count(*) AS items FROM tx GROUP BY 1, 2),
gs AS (SELECT *, date_diff('day', lag(t_dat) OVER w, t_dat) AS gap, lead(t_dat) OVER w AS nxt, min(t_dat) OVER w AS first_day,
       row_number() OVER w AS day_number FROM ds WINDOW w AS (PARTITION BY customer_id ORDER BY t_dat)),
sofar AS (SELECT a.customer_id, a.t_dat, avg(b.gap) AS mean_gap, median(b.gap) AS median_gap, stddev_samp(b.gap) AS std_gap
  FROM gs a JOIN gs b ON a.customer_id = b.customer_id AND b.t_dat <= a.t_dat GROUP BY 1, 2),
grp AS (SELECT t.customer_id, t.t_dat, a.product_group_name AS g, count(*) AS n FROM tx t JOIN art a ON t.article_id = a.article_id
  WHERE a.product_group_name IS NOT NULL GROUP BY 1, 2, 3),
cat AS (SELECT customer_id, t_dat, g FROM (
  SELECT d.customer_id, d.t_dat, x.g, row_number() OVER (PARTITION BY d.customer_id, d.t_dat ORDER BY sum(x.n) DESC, x.g) AS r
  FROM ds d JOIN grp x ON d.customer_id = x.customer_id AND x.t_dat <= d.t_dat GROUP BY 1, 2, 3) WHERE r = 1)"""


@register("next_purchase_inputs", with_(NPI) + f"""
SELECT gs.customer_id, gs.t_dat, CAST(date_diff('day', gs.t_dat, nxt) AS INTEGER) AS target, CAST(coalesce(gap, -1) AS DOUBLE) AS prev_gap,
       {R('coalesce(mean_gap, -1)')} AS mean_gap_so_far, CAST(items AS DOUBLE) AS items, CAST(dayofweek(gs.t_dat) + 1 AS DOUBLE) AS dow,
       CAST(month(gs.t_dat) AS DOUBLE) AS month, CAST(day_number AS DOUBLE) AS day_number,
       {R('coalesce(median_gap, -1)')} AS median_gap, {R('coalesce(std_gap, -1)')} AS std_gap,
       CASE WHEN gap > 180 THEN 'dormant' WHEN gap > 60 THEN 'at_risk' WHEN date_diff('day', first_day, gs.t_dat) < 90 THEN 'new'
            ELSE 'loyal' END AS lifecycle, cat.g AS category
FROM gs JOIN sofar ON gs.customer_id = sofar.customer_id AND gs.t_dat = sofar.t_dat
LEFT JOIN cat ON gs.customer_id = cat.customer_id AND gs.t_dat = cat.t_dat WHERE nxt IS NOT NULL""")
def q_np_inputs(spark, sf):
    return segment.next_purchase_inputs(ad.transactions(spark, sf), ad.articles(spark, sf))


@register("next_purchase_regression")
def q_np_rf(spark, sf):
    return segment.next_purchase_regression(segment.next_purchase_inputs(ad.transactions(spark, sf), ad.articles(spark, sf)))
