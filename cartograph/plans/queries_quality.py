"""Checked queries: sources, filters, data quality, cleaning and splits."""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartograph.functions.joins import materialize
from cartograph.functions.scalars import money_sum
from cartograph.operators import clean, filters, quality
from cartograph.operators import features as feat
from cartograph.plans.churn_store import build_churn_store
from cartograph.plans.oracle import D, FEATURE_DOUBLES, M, R, churn_feature_ctes, with_
from cartograph.plans.queries_core import CUT, END, churn_features_df
from cartograph.plans.registry import register
from cartograph.session import ensure_checkpoint_dir
from cartograph.sources import adapters as ad
from cartograph.sources import readers, writers
from cartograph.sources.schemas import CHURN_FEATURE_COLUMNS

TX_COLS = [("t_dat", False), ("customer_id", True), ("article_id", True), ("price", True),
           ("sales_channel_id", True)]
CUST_COLS = [("customer_id", True), ("FN", True), ("Active", True), ("club_member_status", False),
             ("fashion_news_frequency", False), ("age", True), ("postal_code", False)]
ART_COLS = [("article_id", True), ("prod_name", False), ("product_type_name", False),
            ("product_group_name", False), ("colour_group_name", False), ("garment_group_name", False)]


def _q(name: str) -> str:
    return f'"{name}"'


def _null_sql(table: str, src: str, cols, nan: bool) -> str:
    parts = []
    for c, numeric in cols:
        cond = f"{_q(c)} IS NULL" + (f" OR isnan(CAST({_q(c)} AS DOUBLE))" if (numeric and nan) else "")
        parts.append(f"SELECT '{table}' AS table_name, '{c}' AS column_name, "
                     f"CAST(count_if({cond}) AS BIGINT) AS null_count, "
                     f"{R(f'count_if({cond}) * 100.0 / count(*)')} AS null_pct FROM {src}")
    return "\nUNION ALL\n".join(parts)


CLEAN_CTES = churn_feature_ctes(CUT, END) + [
    """med AS (SELECT club_member_status, median(age) AS m FROM feat
               WHERE age IS NOT NULL AND club_member_status IS NOT NULL GROUP BY 1)""",
    """a1 AS (SELECT f.*, coalesce(f.age, med.m) AS age1 FROM feat f
              LEFT JOIN med ON f.club_member_status = med.club_member_status)""",
    "gmed AS (SELECT quantile_disc(age1, 0.5) AS gm FROM a1 WHERE age1 IS NOT NULL)",
    "imp AS (SELECT * EXCLUDE (age, age1), coalesce(age1, (SELECT gm FROM gmed)) AS age FROM a1)",
    """cleaned AS (SELECT * REPLACE (coalesce(club_member_status, 'ACTIVE') AS club_member_status,
                  coalesce(fashion_news_frequency, 'NONE') AS fashion_news_frequency) FROM imp
                  WHERE customer_id IS NOT NULL AND days_since_last_purchase IS NOT NULL
                    AND total_purchases IS NOT NULL AND is_churned IS NOT NULL)""",
]
HASH_BUCKET_SQL = "(CAST(('0x' || substr(md5('42:' || CAST(customer_id AS VARCHAR)), 1, 8)) AS UBIGINT) % 100)"
SPLIT_SQL = (f"CASE WHEN {HASH_BUCKET_SQL} < 70 THEN 'train' "
             f"WHEN {HASH_BUCKET_SQL} < 85 THEN 'validation' ELSE 'test' END")


def _cleaned_sql_select(extra_where: str = "") -> str:
    cols = ", ".join(R(c) + f" AS {c}" if c in FEATURE_DOUBLES else c for c in CHURN_FEATURE_COLUMNS)
    return f"SELECT {cols} FROM cleaned {extra_where}"


def cleaned_df(spark, sf):
    return clean.clean_churn_features(churn_features_df(spark, sf))


# ---------------------------------------------------------------- sources

@register("total_row_count", with_() + """
SELECT CAST((SELECT count(*) FROM art) + (SELECT count(*) FROM cust) + (SELECT count(*) FROM tx) AS BIGINT)
  AS total_rows""")
def q_total_rows(spark, sf):
    return readers.total_row_count({"articles": ad.articles(spark, sf), "customers": ad.customers(spark, sf),
                                    "transactions": ad.transactions(spark, sf)})


@register("dataset_profile", with_() + """
SELECT 'articles' AS table_name, count(*) AS row_count, 6 AS column_count FROM art
UNION ALL SELECT 'customers', count(*), 7 FROM cust
UNION ALL SELECT 'transactions', count(*), 5 FROM tx""")
def q_profile(spark, sf):
    return readers.dataset_profile({"articles": ad.articles(spark, sf), "customers": ad.customers(spark, sf),
                                    "transactions": ad.transactions(spark, sf)})


def _store_dir(spark, name):
    """A fresh folder in shared storage for each call, so that no result is overwritten by a later one."""
    return os.path.join(ensure_checkpoint_dir(spark), "cartograph-store", f"{name}-{uuid.uuid4().hex}")


def _all_splits(spark, base, version):
    """The three splits read back, each row with the name of its split."""
    parts = [readers.read_feature_split(spark, base, name, version).withColumn("split", F.lit(label))
             for name, label in (("train", "train"), ("val", "validation"), ("test", "test"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


SPLITS_SQL = with_(*CLEAN_CTES) + _cleaned_sql_select().replace(" FROM cleaned", f", {SPLIT_SQL} AS split FROM cleaned")


@register("write_feature_splits", SPLITS_SQL)
def q_write_splits(spark, sf):
    """Round trip: write the hash split under a version tag, read all three splits back."""
    base = _store_dir(spark, f"features-{os.path.basename(sf)}")
    writers.write_feature_splits(*clean.hash_split(cleaned_df(spark, sf)), base, version="v1")
    return _all_splits(spark, base, "v1")


@register("build_churn_store", SPLITS_SQL)
def q_build_store(spark, sf):
    """The whole batch run: facts, features, cleaning, split, versioned Parquet; all three splits read back."""
    base = _store_dir(spark, f"store-{os.path.basename(sf)}")
    build_churn_store(ad.transactions(spark, sf), ad.customers(spark, sf), base, "v1", CUT, ad.HORIZON_DAYS, money_scale=2)
    return _all_splits(spark, base, "v1")


@register("read_feature_split", with_(*CLEAN_CTES) + _cleaned_sql_select(f"WHERE {SPLIT_SQL} = 'test'"))
def q_read_split(spark, sf):
    base = _store_dir(spark, f"features-read-{os.path.basename(sf)}")
    writers.write_feature_splits(*clean.hash_split(cleaned_df(spark, sf)), base, version="v2")
    return readers.read_feature_split(spark, base, "test", "v2")


@register("write_partitioned", with_() + f"""
SELECT CAST(year(t_dat) AS INTEGER) AS year, CAST(month(t_dat) AS INTEGER) AS month,
       count(*) AS row_count, {R(M('price'))} AS revenue FROM tx GROUP BY 1, 2""")
def q_write_partitioned(spark, sf):
    """Year/month layout, all months read back."""
    path = _store_dir(spark, f"tx-partitioned-{os.path.basename(sf)}")
    writers.write_partitioned(ad.transactions(spark, sf), path)
    return writers.read_partitioned(spark, path).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"), money_sum("price", 2).alias("revenue"))


@register("read_partitioned", with_() + f"""
SELECT CAST(year(t_dat) AS INTEGER) AS year, CAST(month(t_dat) AS INTEGER) AS month,
       count(*) AS row_count, {R(M('price'))} AS revenue
FROM tx WHERE t_dat BETWEEN {D('2000-03-15')} AND {D('2001-02-10')} GROUP BY 1, 2""")
def q_read_partitioned(spark, sf):
    """The layout read with partition pruning on a date range."""
    path = _store_dir(spark, f"tx-pruned-{os.path.basename(sf)}")
    writers.write_partitioned(ad.transactions(spark, sf), path)
    return writers.read_partitioned(spark, path, "2000-03-15", "2001-02-10").groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("row_count"), money_sum("price", 2).alias("revenue"))


CREATED = "2024-01-01T00:00:00"


@register("feature_store_metadata", with_(*CLEAN_CTES) + f"""
SELECT '{CREATED}' AS creation_date, (SELECT count(DISTINCT customer_id) FROM cleaned) AS total_customers,
       {len(CHURN_FEATURE_COLUMNS)} AS total_features, CAST(i AS INTEGER) AS position, f AS feature
FROM (SELECT unnest(range(1, {len(CHURN_FEATURE_COLUMNS) + 1})) AS i, unnest({CHURN_FEATURE_COLUMNS}) AS f) x""")
def q_metadata(spark, sf):
    return writers.feature_store_metadata(spark, cleaned_df(spark, sf).select(*CHURN_FEATURE_COLUMNS), created=CREATED)


# ---------------------------------------------------------------- filters

@register("three_way_time_split", with_() + f"""
SELECT CASE WHEN t_dat <= {D(ad.SPLIT_TRAIN_END)} THEN 'train'
            WHEN t_dat <= {D(ad.SPLIT_VAL_END)} THEN 'validation' ELSE 'test' END AS split,
       count(*) AS row_count, count(DISTINCT customer_id) AS customers,
       min(t_dat) AS first_day, max(t_dat) AS last_day
FROM tx GROUP BY 1""")
def q_three_way(spark, sf):
    parts = filters.three_way_time_split(ad.transactions(spark, sf), ad.SPLIT_TRAIN_END, ad.SPLIT_VAL_END)
    out = None
    for name, df in zip(("train", "validation", "test"), parts):
        s = df.agg(F.lit(name).alias("split"), F.count(F.lit(1)).alias("row_count"),
                   F.count_distinct("customer_id").alias("customers"),
                   F.min("t_dat").alias("first_day"), F.max("t_dat").alias("last_day"))
        out = s if out is None else out.unionByName(s)
    return out


@register("inclusive_window", with_() + f"""
SELECT * FROM tx WHERE t_dat BETWEEN {D(ad.FINAL_WEEK_START)} AND {D(ad.FINAL_WEEK_END)}""")
def q_inclusive(spark, sf):
    return filters.inclusive_window(ad.transactions(spark, sf), ad.FINAL_WEEK_START, ad.FINAL_WEEK_END)


@register("column_subset", with_() + """
SELECT customer_id, age, club_member_status, fashion_news_frequency FROM cust""")
def q_subset(spark, sf):
    return filters.column_subset(ad.customers(spark, sf),
                                 ["customer_id", "age", "club_member_status", "fashion_news_frequency"])


@register("drop_sparse_columns", with_() + """
SELECT customer_id, club_member_status, fashion_news_frequency, age, postal_code FROM cust""")
def q_drop_sparse(spark, sf):
    return filters.drop_sparse_columns(ad.customers(spark, sf), 0.65)


@register("drop_critical_nulls", with_() + """
SELECT * FROM cust WHERE age IS NOT NULL AND club_member_status IS NOT NULL""")
def q_drop_critical(spark, sf):
    return filters.drop_critical_nulls(ad.customers(spark, sf), ["age", "club_member_status"])


@register("not_null_filter", with_() + """
SELECT customer_id, age, club_member_status FROM cust
WHERE age IS NOT NULL AND club_member_status IS NOT NULL""")
def q_not_null(spark, sf):
    return filters.not_null_filter(ad.customers(spark, sf), ["age", "club_member_status"]).select(
        "customer_id", "age", "club_member_status")


@register("membership_filter", with_() + """
SELECT customer_id, fashion_news_frequency FROM cust
WHERE fashion_news_frequency IN ('Regularly', 'Monthly')""")
def q_membership(spark, sf):
    return filters.membership_filter(ad.customers(spark, sf), "fashion_news_frequency",
                                     values=["Regularly", "Monthly"]).select(
        "customer_id", "fashion_news_frequency")


@register("clip_upper", with_() + """
SELECT customer_id, CAST(CASE WHEN count(*) > 100 THEN 100 ELSE count(*) END AS BIGINT) AS total_purchases,
       CAST(CASE WHEN count(*) > 40 THEN 40 ELSE count(*) END AS BIGINT) AS purchases_capped_40
FROM tx GROUP BY customer_id""")
def q_clip(spark, sf):
    per = ad.transactions(spark, sf).groupBy("customer_id").agg(F.count(F.lit(1)).alias("total_purchases"))
    per = filters.clip_upper(per, "total_purchases", 40, out="purchases_capped_40")
    return filters.clip_upper(per, "total_purchases", 100)


@register("safe_ratio", with_() + f"""
SELECT customer_id,
       {R('count(*) / count(DISTINCT t_dat)')} AS items_per_day,
       {R(f"count(*) / (date_diff('day', min(t_dat), {D(CUT)}) + 1)")} AS purchases_per_tenure_day
FROM tx WHERE t_dat < {D(CUT)} GROUP BY customer_id""")
def q_safe_ratio(spark, sf):
    from cartograph.functions.scalars import safe_ratio
    train, _ = feat.temporal_split(ad.transactions(spark, sf), CUT)
    per = train.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("t_dat").alias("d"),
        F.datediff(F.lit(CUT).cast("date"), F.min("t_dat")).alias("tenure"))
    return per.select("customer_id", safe_ratio("n", "d").alias("items_per_day"),
                      safe_ratio("n", "tenure", plus_one=True).alias("purchases_per_tenure_day"))


@register("scale_to_max_pct", with_() + f"""
SELECT sales_channel_id, count(*) AS transaction_count, count(DISTINCT customer_id) AS unique_customers,
       {R('count(*) * 100.0 / max(count(*)) OVER ()')} AS transaction_count_pct_of_max,
       {R('count(DISTINCT customer_id) * 100.0 / max(count(DISTINCT customer_id)) OVER ()')}
         AS unique_customers_pct_of_max
FROM tx GROUP BY sales_channel_id""")
def q_scale_max(spark, sf):
    per = ad.transactions(spark, sf).groupBy("sales_channel_id").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.count_distinct("customer_id").alias("unique_customers"))
    return filters.scale_to_max_pct(per, ["transaction_count", "unique_customers"])


# ---------------------------------------------------------------- quality

@register("null_profile", with_() + "\nUNION ALL\n".join([
    _null_sql("articles", "art", ART_COLS, True), _null_sql("customers", "cust", CUST_COLS, True),
    _null_sql("transactions", "tx", TX_COLS, True)]))
def q_null_profile(spark, sf):
    return (quality.null_profile(ad.articles(spark, sf), "articles")
            .unionByName(quality.null_profile(ad.customers(spark, sf), "customers"))
            .unionByName(quality.null_profile(ad.transactions(spark, sf), "transactions")))


@register("missing_profile", with_() + f"""
SELECT table_name, column_name, null_count AS missing_count, null_pct AS missing_pct,
       CASE WHEN null_pct > 50 THEN 'high' WHEN null_pct > 10 THEN 'medium' ELSE 'low' END AS severity
FROM ({_null_sql('customers', 'cust', CUST_COLS, False)}) p WHERE null_count > 0""")
def q_missing(spark, sf):
    return quality.missing_profile(ad.customers(spark, sf), "customers")


@register("duplicate_keys", with_() + """
SELECT 'lineitem' AS table_name, 'l_orderkey' AS key_column, count(*) AS total_rows,
       CAST(count(DISTINCT l_orderkey) + max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS unique_keys,
       CAST(count(*) - count(DISTINCT l_orderkey) - max(CASE WHEN l_orderkey IS NULL THEN 1 ELSE 0 END) AS BIGINT)
         AS duplicates
FROM lineitem
UNION ALL
SELECT 'customers', 'customer_id', count(*), CAST(count(DISTINCT customer_id) AS BIGINT),
       CAST(count(*) - count(DISTINCT customer_id) AS BIGINT) FROM cust""")
def q_duplicates(spark, sf):
    return (quality.duplicate_keys(ad.table(spark, sf, "lineitem"), "l_orderkey", "lineitem")
            .unionByName(quality.duplicate_keys(ad.customers(spark, sf), "customer_id", "customers")))


@register("date_range", with_() + f"""
SELECT min(t_dat) AS min_date, max(t_dat) AS max_date,
       CAST(date_diff('day', min(t_dat), max(t_dat)) AS INTEGER) AS days_span,
       {R("date_diff('day', min(t_dat), max(t_dat)) / 365.0")} AS years_span FROM tx""")
def q_date_range(spark, sf):
    return quality.date_range(ad.transactions(spark, sf))


_ORPHAN_C = "SELECT DISTINCT customer_id FROM tx WHERE customer_id NOT IN (SELECT customer_id FROM rcust)"
_ORPHAN_A = "SELECT DISTINCT article_id FROM tx WHERE article_id NOT IN (SELECT article_id FROM rart)"
REF_CTES = ["rcust AS (SELECT * FROM cust WHERE customer_id % 10 <> 0)",
            "rart AS (SELECT * FROM art WHERE article_id % 25 <> 0)"]


@register("orphan_customers", with_(*REF_CTES) + _ORPHAN_C)
def q_orphan_c(spark, sf):
    return quality.orphan_keys(ad.transactions(spark, sf), ad.reference_customers(spark, sf), "customer_id")


@register("orphan_articles", with_(*REF_CTES) + _ORPHAN_A)
def q_orphan_a(spark, sf):
    return quality.orphan_keys(ad.transactions(spark, sf), ad.reference_articles(spark, sf), "article_id")


@register("referential_integrity", with_(*REF_CTES) + f"""
SELECT 'orphan_customers' AS check_name, (SELECT count(*) FROM ({_ORPHAN_C})) AS orphan_keys
UNION ALL SELECT 'orphan_articles', (SELECT count(*) FROM ({_ORPHAN_A}))""")
def q_ri(spark, sf):
    return quality.referential_integrity(ad.transactions(spark, sf), ad.reference_customers(spark, sf),
                                         ad.reference_articles(spark, sf))


@register("value_distribution", with_() + """
SELECT * FROM (SELECT 'product_group_name' AS attribute, product_group_name AS value, count(*) AS count
               FROM art GROUP BY 2 ORDER BY count DESC, value ASC NULLS LAST LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'club_member_status', club_member_status, count(*) AS count
               FROM cust GROUP BY 2 ORDER BY count DESC, 2 ASC NULLS LAST LIMIT 10)
UNION ALL
SELECT * FROM (SELECT 'sales_channel_id', CAST(sales_channel_id AS VARCHAR), count(*) AS count
               FROM tx GROUP BY 2 ORDER BY count DESC, 2 ASC NULLS LAST LIMIT 10)""")
def q_value_dist(spark, sf):
    parts = [(ad.articles(spark, sf), "product_group_name"), (ad.customers(spark, sf), "club_member_status"),
             (ad.transactions(spark, sf), "sales_channel_id")]
    out = None
    for df, c in parts:
        v = quality.value_distribution(df, c, 10).select(
            F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value"), "count")
        out = v if out is None else out.unionByName(v)
    return out


@register("validation_report", with_(*REF_CTES) + f"""
SELECT table_name, 'null_count' AS check_name, column_name, CAST(null_count AS DOUBLE) AS value FROM (
{_null_sql("articles", "rart", ART_COLS, True)}
UNION ALL {_null_sql("customers", "rcust", CUST_COLS, True)}
UNION ALL {_null_sql("transactions", "tx", TX_COLS, True)})
UNION ALL SELECT 'articles', 'duplicates', 'article_id', CAST(count(*) - count(DISTINCT article_id) AS DOUBLE) FROM rart
UNION ALL SELECT 'customers', 'duplicates', 'customer_id', CAST(count(*) - count(DISTINCT customer_id) AS DOUBLE) FROM rcust
UNION ALL SELECT 'transactions', 'days_span', 't_dat', CAST(date_diff('day', min(t_dat), max(t_dat)) AS DOUBLE) FROM tx
UNION ALL SELECT 'transactions', 'orphan_customers', 'customer_id', CAST((SELECT count(*) FROM ({_ORPHAN_C})) AS DOUBLE)
UNION ALL SELECT 'transactions', 'orphan_articles', 'article_id', CAST((SELECT count(*) FROM ({_ORPHAN_A})) AS DOUBLE)""")
def q_validation(spark, sf):
    return quality.validation_report(ad.reference_articles(spark, sf), ad.reference_customers(spark, sf),
                                     ad.transactions(spark, sf))


@register("distinct_keys", with_() + "SELECT DISTINCT customer_id, t_dat FROM tx")
def q_distinct_keys(spark, sf):
    return quality.distinct_keys(ad.transactions(spark, sf), ["customer_id", "t_dat"])


# ---------------------------------------------------------------- cleaning and splits

@register("impute_age", with_(*CLEAN_CTES) + f"""
SELECT customer_id, club_member_status, {R('age')} AS age FROM imp""")
def q_impute_age(spark, sf):
    return clean.impute_age(churn_features_df(spark, sf)).select("customer_id", "club_member_status", "age")


@register("impute_mode", with_(*churn_feature_ctes(CUT, END)) + """
SELECT customer_id, coalesce(club_member_status, 'ACTIVE') AS club_member_status,
       coalesce(fashion_news_frequency, 'NONE') AS fashion_news_frequency FROM feat""")
def q_impute_mode(spark, sf):
    return clean.impute_mode(churn_features_df(spark, sf)).select(
        "customer_id", "club_member_status", "fashion_news_frequency")


@register("clean_churn_features", with_(*CLEAN_CTES) + _cleaned_sql_select())
def q_clean(spark, sf):
    return cleaned_df(spark, sf)


@register("clean_churn_counts", with_(*CLEAN_CTES) + """
SELECT (SELECT count(*) FROM feat) AS initial_rows,
       (SELECT CAST(count_if(age IS NULL) AS BIGINT) FROM feat) AS age_nulls_before,
       (SELECT count(*) FROM cleaned) AS final_rows,
       (SELECT CAST(count_if(age IS NULL) AS BIGINT) FROM cleaned) AS age_nulls_after,
       (SELECT count(*) FROM feat) - (SELECT count(*) FROM cleaned) AS dropped""")
def q_clean_counts(spark, sf):
    raw = churn_features_df(spark, sf)
    return clean.cleaning_counts(raw, clean.clean_churn_features(raw))


@register("random_split_70_15_15", with_(*CLEAN_CTES) + """
SELECT count(*) AS rows, CAST(0 AS BIGINT) AS in_several, true AS repeatable, true AS shares_in_bounds FROM cleaned""")
def q_random_split(spark, sf):
    """What holds of any seeded split: it covers the rows, its parts are disjoint, the seed repeats it, and
    each share is within five standard deviations of 70, 15 and 15 %."""
    cleaned = materialize(cleaned_df(spark, sf))

    def split():
        parts = zip(("train", "validation", "test"), clean.random_split(cleaned))
        return reduce(DataFrame.unionByName, [p.select("customer_id", F.lit(n).alias("split")) for n, p in parts])

    both = split().join(split().withColumnRenamed("split", "again"), "customer_id", "full")
    n = F.count(F.lit(1))
    bounds = [F.abs(F.count_if(F.col("split") == name) - n * share) <= 5 * F.sqrt(n * share * (1 - share))
              for name, share in (("train", 0.70), ("validation", 0.15), ("test", 0.15))]
    return both.agg(n.alias("rows"), (n - F.count_distinct("customer_id")).alias("in_several"),
                    F.every(F.col("split").eqNullSafe(F.col("again"))).alias("repeatable"),
                    (bounds[0] & bounds[1] & bounds[2]).alias("shares_in_bounds"))


@register("hash_split_70_15_15", with_(*CLEAN_CTES) + f"""
SELECT customer_id, {SPLIT_SQL} AS split FROM cleaned""")
def q_hash_split(spark, sf):
    return cleaned_df(spark, sf).select("customer_id", clean.hash_split_label("customer_id").alias("split"))


@register("split_churn_rates", with_(*CLEAN_CTES) + f"""
SELECT {SPLIT_SQL} AS split, count(*) AS rows, {R('avg(CAST(is_churned AS DOUBLE)) * 100.0')} AS churn_pct
FROM cleaned GROUP BY 1""")
def q_split_rates(spark, sf):
    tr, va, te = clean.hash_split(cleaned_df(spark, sf))
    return clean.split_churn_rates({"train": tr, "validation": va, "test": te})
