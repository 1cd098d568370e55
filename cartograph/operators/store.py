"""Features documented for the 40-column feature store and its planned
extensions (multi-horizon labels, rolling cutoffs, decay, lifecycle, RFM scores).

Bounds that the documentation leaves open are parameters marked [ours].
Every per-customer measure is a grouping on the customer key (partial
aggregation first); "most frequent value" picks use ``min(struct(-count, value))``
instead of a window, so a hot customer is reduced before any shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.dates import add_days, as_date, is_weekend
from cartograph.functions.joins import broadcast_bounded, materialize
from cartograph.functions.ranking import global_row_number
from cartograph.functions.scalars import clip_upper, money_stddev, money_sum, money_unscale, safe_ratio, stddev_of_moments
from cartograph.operators.features import DEFAULT_CUTOFF, DEFAULT_FILLS, purchase_gaps
from cartograph.operators.partials import WITH_PRICES, articles_of, customer_partials, days_of, interval_summary, merged_prefix
from cartograph.sources.schemas import CHURN_FEATURE_COLUMNS

# Fixed values / [ours] bounds.
RISK_BOUNDS = (30, 60, 90)             # Active ≤30 < Moderate ≤60 < High ≤90 < Churned
LIFECYCLE = {"new_days": 30, "at_risk_days": 60, "churned_days": 90, "reactivation_days": 180}
SEGMENT_BOUNDS = {"new_tenure": 90, "at_risk_recency": 60, "dormant_recency": 180}
HALF_LIFE_DAYS = 30.0
BULK_BASKET = 5
AGE_CAP = 100


def _train(tx: DataFrame, cutoff: str, date_col: str = "t_dat") -> DataFrame:
    return tx.filter(F.col(date_col) < as_date(cutoff))


def rfm_extended(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF, money_scale: int | None = None) -> DataFrame:
    """Extended monetary / frequency measures per customer (training window)."""
    t = _train(tx, cutoff)
    c = as_date(cutoff)
    per = t.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_purchases"), money_sum("price", money_scale).alias("total_spend"),
        F.count_distinct("article_id").alias("unique_products_bought"),
        F.max("price").alias("max_single_purchase"), F.min("price").alias("min_single_purchase"),
        money_stddev("price", money_scale).alias("price_std_dev"), F.min("t_dat").alias("_first"),
        F.count("price").alias("_priced"))
    since_first = F.datediff(c, F.col("_first"))
    return per.select(
        "customer_id", "max_single_purchase", "min_single_purchase", "price_std_dev",
        since_first.alias("days_since_first_purchase"),
        (F.col("total_purchases") / (since_first + 1)).alias("purchases_per_day"),
        safe_ratio("total_spend", "_priced").alias("spend_per_purchase"),
        (F.col("unique_products_bought") / F.col("total_purchases")).alias("products_per_purchase"))


ATTRS = ["product_group_name", "colour_group_name", "garment_group_name"]


def _customer_article(t: DataFrame, articles: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """(customer, article) item counts joined to article attributes — the fact
    table is reduced before the join.  Built with the same attribute list by
    every caller, so one plan can reuse its exchange for all of them."""
    attrs = list(dict.fromkeys([a for a in ATTRS if a in articles.columns] + list(extra)))
    ca = t.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("n"))
    return ca.join(articles.select("article_id", *attrs), "article_id", "left")


def _spread_customer_article(t: DataFrame, articles: DataFrame) -> DataFrame:
    """``_customer_article`` in parts of about PAIRS rows, whatever the session's shuffle partitions.

    ``attribute_counts`` combines one part in a task, in a map of at most as many
    rows for each attribute; parts are dealt by the pair, so a customer or an
    article with very many of them is in all parts.
    """
    pairs = materialize(t.groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("n")))
    attrs = [a for a in ATTRS if a in articles.columns]
    joined = pairs.join(articles.select("article_id", *attrs), "article_id", "left")
    return joined.repartition(pairs.count() // PAIRS + 1, "customer_id", "article_id")


def attribute_counts(bought: DataFrame, items: str, attrs: Sequence[str] = ATTRS) -> DataFrame:
    """(customer_id, kind, value, cnt, products): a customer's items and articles for each value of each attribute.

    ``kind`` is the attribute's place in ``attrs``; null is a value.  One row of
    ``bought`` (customer, article) becomes one for each attribute, combined in
    its task before the shuffle, so that distinct counts and most frequent
    values of all attributes come from one aggregate.
    """
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(a).alias("value")) for i, a in enumerate(attrs)])
    return bought.select("customer_id", F.col(items).alias("_items"), F.inline(kinds)).groupBy("customer_id", "kind", "value").agg(
        F.sum("_items").alias("cnt"), F.count(F.lit(1)).alias("products"))


def _values(kind: int):
    """How many values of an attribute a customer has, in an aggregate of ``attribute_counts``."""
    return F.count_if((F.col("kind") == kind) & F.col("value").isNotNull())


def _most_frequent(kind: int):
    """(neg, v): minus the count, and the value of an attribute that a customer has most often; ties → smallest."""
    return F.min(F.when((F.col("kind") == kind) & F.col("value").isNotNull(),
                        F.struct((-F.col("cnt")).alias("neg"), F.col("value").alias("v"))))


PAIRS = 1 << 18  # (customer, article) rows that one task combines
CATEGORY, COLOR, GARMENT = range(3)  # places in ATTRS


def category_diversity(tx: DataFrame, articles: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    counts = attribute_counts(_spread_customer_article(_train(tx, cutoff), articles), "n")
    return counts.groupBy("customer_id").agg(
        _values(CATEGORY).alias("unique_categories"), _values(COLOR).alias("unique_colors"),
        _values(GARMENT).alias("unique_garment_groups"))


def preferred_value(tx: DataFrame, articles: DataFrame, attr: str, name: str,
                    cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Most frequent attribute value per customer and its item count; ties → smallest value."""
    ca = _customer_article(_train(tx, cutoff), articles, [attr])
    per_value = ca.filter(F.col(attr).isNotNull()).groupBy("customer_id", attr).agg(F.sum("n").alias("cnt"))
    best = per_value.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("cnt")).alias("neg"), F.col(attr).alias("v"))).alias("b"))
    return best.select("customer_id", F.col("b.v").alias(name), (-F.col("b.neg")).alias(f"{name}_count"))


def top_category(tx, articles, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    return preferred_value(tx, articles, "product_group_name", "preferred_category", cutoff)


def top_color(tx, articles, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    return preferred_value(tx, articles, "colour_group_name", "preferred_color", cutoff)


def top3_categories(tx: DataFrame, articles: DataFrame, cutoff: str = DEFAULT_CUTOFF, k: int = 3) -> DataFrame:
    """The k most frequent product groups per customer (count desc, name asc).

    The collected list holds one entry per category the customer bought —
    bounded by the category domain, not by the customer's item count.
    """
    ca = _customer_article(_train(tx, cutoff), articles)
    pv = ca.filter(F.col("product_group_name").isNotNull()).groupBy("customer_id", "product_group_name").agg(
        F.sum("n").alias("cnt"))
    lst = pv.groupBy("customer_id").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("cnt")).alias("neg"), F.col("product_group_name").alias("v")))).alias("l"))
    return lst.select("customer_id", F.transform(F.slice("l", 1, k), lambda s: s["v"]).alias("top_categories"))


def channel_counts(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    t = _train(tx, cutoff)
    out = t.groupBy("customer_id").agg(
        F.count_if(F.col("sales_channel_id") == 1).alias("store_purchases"),
        F.count_if(F.col("sales_channel_id") == 2).alias("online_purchases"),
        F.count(F.lit(1)).alias("total_channel_purchases"))
    return out.withColumn("online_preference_ratio", F.col("online_purchases") / F.col("total_channel_purchases"))


def preferred_channel(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Most frequent channel per customer; ties → the smaller channel id."""
    per = _train(tx, cutoff).groupBy("customer_id", "sales_channel_id").agg(F.count(F.lit(1)).alias("cnt"))
    best = per.groupBy("customer_id").agg(
        F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("sales_channel_id").alias("v"))).alias("b"))
    return best.select("customer_id", F.col("b.v").alias("preferred_channel"))


def temporal_features(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    t = _train(tx, cutoff)
    out = t.groupBy("customer_id").agg(
        F.count_if(is_weekend("t_dat")).alias("weekend_purchases"), F.count(F.lit(1)).alias("_n"),
        F.month(F.max("t_dat")).alias("last_purchase_month"))
    return out.select("customer_id", "weekend_purchases", "last_purchase_month",
                      (F.col("weekend_purchases") / F.col("_n")).alias("weekend_purchase_ratio"))


def interval_extended(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF, no_gap_fill: float = -1.0) -> DataFrame:
    """avg/min/max/std of gaps for every training customer; −1 when there is no gap,
    std 0 when there is exactly one."""
    t = _train(tx, cutoff)
    g = purchase_gaps(t).groupBy("customer_id").agg(
        F.avg("days_between").alias("avg_days_between_purchases"),
        F.min("days_between").cast("double").alias("min_days_between_purchases"),
        F.max("days_between").cast("double").alias("max_days_between_purchases"),
        F.stddev_samp("days_between").alias("std_days_between_purchases"))
    base = t.select("customer_id").distinct()
    out = base.join(g, "customer_id", "left")
    return out.select(
        "customer_id",
        *[F.coalesce(F.col(c), F.lit(no_gap_fill)).alias(c) for c in
          ("avg_days_between_purchases", "min_days_between_purchases", "max_days_between_purchases")],
        F.when(F.col("avg_days_between_purchases").isNull(), F.lit(no_gap_fill))
         .otherwise(F.coalesce(F.col("std_days_between_purchases"), F.lit(0.0)))
         .alias("std_days_between_purchases"))


def recency(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    t = _train(tx, cutoff)
    c = as_date(cutoff)
    return t.groupBy("customer_id").agg(F.max("t_dat").alias("last_purchase_date"),
                                        F.min("t_dat").alias("first_purchase_date")).select(
        "customer_id", F.datediff(c, F.col("last_purchase_date")).alias("days_since_last_purchase"),
        F.datediff(c, F.col("first_purchase_date")).alias("days_since_first_purchase"))


def recency_churn_label(days_since_last, threshold: int = 90):
    return (F.col(days_since_last) > threshold).cast("int") if isinstance(days_since_last, str) else \
        (days_since_last > threshold).cast("int")


def churn_risk_level(days_since_last: str = "days_since_last_purchase", bounds=RISK_BOUNDS):
    d = F.col(days_since_last)
    a, m, h = bounds
    return (F.when(d <= a, "Active").when(d <= m, "Moderate").when(d <= h, "High").otherwise("Churned"))


def lifecycle_flags(df: DataFrame, bounds: dict | None = None) -> DataFrame:
    b = {**LIFECYCLE, **(bounds or {})}
    r, f = F.col("days_since_last_purchase"), F.col("days_since_first_purchase")
    return df.select(
        "customer_id",
        (f < b["new_days"]).cast("int").alias("is_new_customer"),
        (F.col("total_purchases") / F.greatest(f, F.lit(1))).alias("purchase_velocity"),
        (r > b["at_risk_days"]).cast("int").alias("is_at_risk"),
        (r > b["churned_days"]).cast("int").alias("is_churned_recency"),
        (r > b["reactivation_days"]).cast("int").alias("reactivation_needed"))


def lifecycle_segment(df: DataFrame, bounds: dict | None = None) -> DataFrame:
    b = {**SEGMENT_BOUNDS, **(bounds or {})}
    r, f = F.col("days_since_last_purchase"), F.col("days_since_first_purchase")
    seg = (F.when(r > b["dormant_recency"], "dormant").when(r > b["at_risk_recency"], "at_risk")
            .when(f < b["new_tenure"], "new").otherwise("loyal"))
    return df.select("customer_id", seg.alias("lifecycle_segment"))


def spending_trend(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF, window_days: int = 90,
                   money_scale: int | None = None) -> DataFrame:
    """Spend in the last ``window_days`` before the cutoff minus the window before that [ours].

    Every training customer has a row; without a purchase in either window both are 0.
    """
    c = as_date(cutoff)
    lo = as_date(add_days(cutoff, -2 * window_days))
    mid = as_date(add_days(cutoff, -window_days))
    d = F.col("t_dat")
    out = tx.filter(d < c).groupBy("customer_id").agg(
        money_sum(F.when(d >= mid, F.col("price")), money_scale).alias("recent_spend"),
        money_sum(F.when((d >= lo) & (d < mid), F.col("price")), money_scale).alias("previous_spend"))
    out = out.fillna(0.0, ["recent_spend", "previous_spend"])
    return out.withColumn("spending_trend", F.col("recent_spend") - F.col("previous_spend"))


def purchases_per_month(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Items per active month (months with at least one purchase) [ours]."""
    t = _train(tx, cutoff)
    return t.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_purchases"),
        F.count_distinct(F.year("t_dat") * 100 + F.month("t_dat")).alias("months_active")).withColumn(
        "purchases_per_month", F.col("total_purchases") / F.col("months_active"))


def basket_features(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF, bulk: int = BULK_BASKET) -> DataFrame:
    """Basket = a customer's items on one day [ours]: mean and max size, bulk-buyer flag."""
    b = _train(tx, cutoff).groupBy("customer_id", "t_dat").agg(F.count(F.lit(1)).alias("basket"))
    return b.groupBy("customer_id").agg(
        F.avg("basket").alias("avg_basket_size"), F.max("basket").alias("max_basket_size")).withColumn(
        "is_bulk_buyer", (F.col("max_basket_size") > bulk).cast("int"))


def engagement_flags(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id", F.coalesce((F.col("club_member_status") == "ACTIVE").cast("int"), F.lit(0))
        .alias("is_active_member"),
        F.coalesce((F.col("fashion_news_frequency") != "NONE").cast("int"), F.lit(0)).alias("subscribes_to_news"))


def category_concentration(tx: DataFrame, articles: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Share of a customer's items in the most frequent product group, and groups per item.

    One scan: both follow from the items by (customer, group), items without a
    group included.  Ids are unique in ``articles``; a null customer has no row.
    """
    bought = _spread_customer_article(_train(tx, cutoff).where(F.col("customer_id").isNotNull()), articles)
    per = attribute_counts(bought, "n", ATTRS[:1]).groupBy("customer_id").agg(
        F.sum("cnt").alias("_n"), _most_frequent(CATEGORY).alias("_top"), _values(CATEGORY).alias("_groups"))
    return per.select("customer_id", (F.coalesce(-F.col("_top.neg"), F.lit(0)) / F.col("_n")).alias("top_category_share"),
                      (F.col("_groups") / F.col("_n")).alias("browsing_diversity"))


def category_recency(tx: DataFrame, articles: DataFrame, cutoff: str = DEFAULT_CUTOFF) -> DataFrame:
    """Days since the last purchase in each product group (long form)."""
    t = _train(tx, cutoff)
    ca = t.groupBy("customer_id", "article_id").agg(F.max("t_dat").alias("_last"))
    j = ca.join(articles.select("article_id", "product_group_name"), "article_id", "left")
    return j.groupBy("customer_id", "product_group_name").agg(
        F.datediff(as_date(cutoff), F.max("_last")).alias("days_since_last_in_category"))


def category_recency_wide(long: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Wide form for a given list of major categories (one column each)."""
    return long.groupBy("customer_id").pivot("product_group_name", list(categories)).agg(
        F.min("days_since_last_in_category"))


def peak_months(tx: DataFrame, k: int = 3) -> DataFrame:
    """The k calendar months with the highest mean monthly volume (≤ 12 rows)."""
    monthly = tx.groupBy(F.year("t_dat").alias("y"), F.month("t_dat").alias("month")).agg(
        F.count(F.lit(1)).alias("n"))
    avg = monthly.groupBy("month").agg(F.avg("n").alias("avg_n"))
    return avg.orderBy(F.col("avg_n").desc(), F.col("month").asc()).limit(k).select("month")


def peak_month_flag(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF, k: int = 3) -> DataFrame:
    """1 if the customer's last training purchase falls in a peak month."""
    peaks = broadcast_bounded(peak_months(tx, k).withColumn("_peak", F.lit(1)))
    lm = _train(tx, cutoff).groupBy("customer_id").agg(F.month(F.max("t_dat")).alias("month"))
    return lm.join(peaks, "month", "left").select(
        "customer_id", F.coalesce(F.col("_peak"), F.lit(0)).alias("is_peak_month"))


def multi_horizon_labels(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF,
                         horizons: Sequence[int] = (30, 60, 90)) -> DataFrame:
    """churn_{h}_days for each horizon, in one conditional aggregate."""
    c = as_date(cutoff)
    end = as_date(add_days(cutoff, max(horizons)))
    d = F.col("t_dat")
    t = tx.filter(d < end)
    aggs = [F.max(F.when(d < c, 1).otherwise(0)).alias("_in_train")]
    for h in horizons:
        aggs.append(F.max(F.when((d >= c) & (d < as_date(add_days(cutoff, h))), 1).otherwise(0)).alias(f"_a{h}"))
    out = t.groupBy("customer_id").agg(*aggs).filter(F.col("_in_train") == 1)
    return out.select("customer_id", *[(F.lit(1) - F.col(f"_a{h}")).cast("int").alias(f"churn_{h}_days")
                                      for h in horizons])


def cutoff_expand(tx: DataFrame, cutoffs: Sequence[str], horizon_days: int = 0,
                  date_col: str = "t_dat") -> DataFrame:
    """Each row once per cutoff with ``t_dat < cutoff + horizon`` (a generator over
    a literal list, so no join and no shuffle; rows multiply by ≤ len(cutoffs))."""
    arr = F.array(*[F.lit(c).cast("date") for c in sorted(cutoffs)])
    keep = F.filter(arr, lambda c: F.col(date_col) < F.date_add(c, horizon_days))
    return tx.select("*", F.explode(keep).alias("cutoff"))


def rolling_cutoff_features(tx: DataFrame, customers: DataFrame, cutoffs: Sequence[str], horizon_days: int = 90,
                            fills: dict | None = None, money_scale: int | None = None) -> DataFrame:
    """``cutoff`` and the 19-column churn row at every cutoff, from one scan of the facts.

    Facts become (customer, day) and (customer, article) partials once.  Between
    neighbouring cutoffs a customer has one interval summary, and the state at a
    cutoff is the merge of those before it, so days are not repeated for each
    cutoff.  An article counts from its first purchase on.  The label looks at
    the first day of the next summary only.
    """
    fills = {**DEFAULT_FILLS, **(fills or {})}
    cutoffs = sorted(set(cutoffs))
    known = F.array(*[as_date(c) for c in cutoffs])

    def period(day: str):
        """Cutoffs that ``day`` is not before."""
        return F.size(F.filter(known, lambda c: c <= F.col(day)))

    partials = customer_partials(tx.where(F.col("t_dat") < as_date(add_days(cutoffs[-1], horizon_days))), money_scale)
    state = merged_prefix(interval_summary(days_of(partials).withColumn("period", period("t_dat")), "period"), "period")
    # A state holds from the first cutoff after its period to the one before the customer's next summary.
    until = F.when(F.col("next_day").isNull(), len(cutoffs)).otherwise(period("next_day"))
    at = (state.where((F.col("period") < len(cutoffs)) & (F.col("period") < until))
          .withColumn("place", F.explode(F.sequence("period", until - 1)))
          .withColumn("cutoff", F.get(known, F.col("place"))))
    fresh = (articles_of(partials).groupBy("customer_id", period("first_day").alias("period"))
             .agg(F.count(F.lit(1)).alias("fresh")).where(F.col("period") < len(cutoffs)))
    upto = Window.partitionBy("customer_id").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    # First purchases are purchases: a period with new articles has a summary, one without adds none.
    at = at.join(fresh.withColumn("unique_products", F.sum("fresh").over(upto))
                 .withColumn("next_fresh", F.lead("period").over(Window.partitionBy("customer_id").orderBy("period")))
                 .select("customer_id", F.explode(F.sequence("period", F.coalesce(F.col("next_fresh"), F.lit(len(cutoffs))) - 1))
                         .alias("place"), "unique_products"), ["customer_id", "place"], "left")
    n, total, squares = (F.col(c).cast("double") for c in ("gaps", "gap_sum", "gap_squares"))
    spread = F.when(n > 1, F.sqrt(F.greatest((n * squares - total * total) / (n * (n - 1)), F.lit(0.0))))
    tenure = F.date_diff("cutoff", "first_day")
    demo = customers.select("customer_id", "age", "club_member_status", "fashion_news_frequency")
    row = at.join(demo, "customer_id", "left").withColumn("total_spend", money_unscale(F.col("spend"), money_scale)).select(
        "cutoff", "customer_id", F.col("last_day").alias("last_purchase_date"), F.col("first_day").alias("first_purchase_date"),
        F.col("items").alias("total_purchases"), F.col("days").alias("unique_shopping_days"),
        F.coalesce("unique_products", F.lit(0)).alias("unique_products"), "total_spend",
        safe_ratio("total_spend", "priced").alias("avg_order_value"),
        F.date_diff("cutoff", "last_day").alias("days_since_last_purchase"), tenure.alias("customer_tenure_days"),
        (F.col("items") / (tenure + 1)).alias("purchase_frequency"),
        F.coalesce(total / F.nullif(n, F.lit(0.0)), F.lit(fills["avg_days_between_purchases"])).alias("avg_days_between_purchases"),
        F.coalesce(spread, F.lit(fills["std_days_between_purchases"])).alias("std_days_between_purchases"),
        (F.col("online_items") / F.col("items")).alias("online_ratio"),
        (F.col("weekend_items") / F.col("items")).alias("weekend_ratio"),
        F.when(F.col("next_day") < F.date_add("cutoff", horizon_days), 0).otherwise(1).alias("is_churned"),
        "age", "club_member_status", "fashion_news_frequency")
    return row.select("cutoff", *CHURN_FEATURE_COLUMNS)


def stack_cutoffs(frames: dict | Sequence[DataFrame]) -> DataFrame:
    """unionByName of feature sets: by cutoff, which then tags each, or sets that have their cutoffs."""
    tagged = ([df.select(F.lit(c).cast("date").alias("cutoff"), *df.columns) for c, df in frames.items()]
              if isinstance(frames, dict) else list(frames))
    return reduce(DataFrame.unionByName, tagged)


def time_decayed_features(tx: DataFrame, cutoff: str = DEFAULT_CUTOFF,
                          half_life_days: float = HALF_LIFE_DAYS) -> DataFrame:
    """Exponentially weighted item count and spend: weight 2^(−age/half-life) [ours]."""
    t = _train(tx, cutoff)
    w = F.exp(F.lit(-math.log(2.0) / half_life_days) * F.datediff(as_date(cutoff), F.col("t_dat")))
    return t.groupBy("customer_id").agg(F.sum(w).alias("decayed_purchases"),
                                        F.sum(w * F.col("price")).alias("decayed_spend"))


def _ntile_from_rank(rank, n, buckets: int):
    """ntile(buckets) from a 1-based rank and the row count (SQL NTILE semantics)."""
    q = F.floor(n / buckets)
    r = n - q * buckets
    big = (q + 1) * r
    return F.when(rank <= big, F.ceil(rank / (q + 1))).otherwise(r + F.ceil((rank - big) / q)).cast("int")


def ntile_rfm_scores(rfm: DataFrame, buckets: int = 5, key: str = "customer_id") -> DataFrame:
    """R, F, M quintile scores (5 = best) with exact NTILE semantics.

    Each score needs a global order; ranks come from ``global_row_number``
    (range shuffle + partition offsets), never a single-task window.  The
    input is read four times, so it is materialised once.
    """
    rfm = materialize(rfm.select(key, "days_since_last_purchase", "total_purchases", "total_spend"))
    n = rfm.agg(F.count(F.lit(1))).scalar()
    r = global_row_number(rfm.select(key, "days_since_last_purchase"),
                          [F.col("days_since_last_purchase").desc(), F.col(key).asc()], "_rr")
    f = global_row_number(rfm.select(key, "total_purchases"),
                          [F.col("total_purchases").asc(), F.col(key).asc()], "_fr")
    m = global_row_number(rfm.select(key, "total_spend"), [F.col("total_spend").asc(), F.col(key).asc()], "_mr")
    out = (r.select(key, _ntile_from_rank(F.col("_rr"), n, buckets).alias("r_score"))
            .join(f.select(key, _ntile_from_rank(F.col("_fr"), n, buckets).alias("f_score")), key)
            .join(m.select(key, _ntile_from_rank(F.col("_mr"), n, buckets).alias("m_score")), key))
    return out


def rfm_named_segments(scores: DataFrame) -> DataFrame:
    """Rule table over R/F/M scores [ours bounds], first match wins."""
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    seg = (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when(f >= 4, "Loyal Customers")
            .when((m >= 4) & (f <= 2), "Big Spenders")
            .when((r >= 4) & (f <= 2), "New Customers")
            .when((r <= 2) & (f >= 3), "At-Risk")
            .when((r <= 2) & (f <= 2) & (m <= 2), "Lost")
            .otherwise("Others"))
    return scores.withColumn("segment", seg)


def feature_store_40(tx: DataFrame, customers: DataFrame, articles: DataFrame, cutoff: str = DEFAULT_CUTOFF,
                     churn_days: int = 90, money_scale: int | None = None) -> DataFrame:
    """The documented 40-column feature-store row (recency-based label, −1 gap fill,
    age capped at 100).

    The facts are scanned once, into stored (customer, day) and (customer,
    article) partials.  Sums, prices, channels and gaps come from the days, with
    one shuffle by customer; products, preferences and diversity from the
    articles.  Ids are unique in ``articles``; a null customer has no row.
    """
    c = as_date(cutoff)
    partials = customer_partials(_train(tx, cutoff).where(F.col("customer_id").isNotNull()), money_scale, WITH_PRICES)
    gap = F.date_diff("t_dat", F.lag("t_dat").over(Window.partitionBy("customer_id").orderBy("t_dat")))
    base = days_of(partials).withColumn("gap", gap).groupBy("customer_id").agg(
        F.max("t_dat").alias("last_purchase_date"), F.min("t_dat").alias("first_purchase_date"),
        F.sum("items").alias("total_purchases"), F.count(F.lit(1)).alias("unique_shopping_days"),
        money_unscale(F.sum("spend"), money_scale).alias("total_spend"), F.sum("priced").alias("_priced"),
        F.max("highest").alias("max_single_purchase"), F.min("lowest").alias("min_single_purchase"),
        stddev_of_moments(F.sum("priced"), F.sum("spend"), F.sum("spend_squares"), money_scale).alias("price_std_dev"),
        F.sum("store_items").alias("store_purchases"), F.sum("online_items").alias("online_purchases"),
        F.sum(F.when(is_weekend("t_dat"), F.col("items")).otherwise(0)).alias("weekend_purchases"),
        *[F.coalesce(of("gap").cast("double"), F.lit(-1.0)).alias(f"{name}_days_between_purchases")
          for name, of in (("avg", F.avg), ("min", F.min), ("max", F.max))],
        F.when(F.count("gap") == 0, F.lit(-1.0)).otherwise(F.coalesce(F.stddev_samp("gap"), F.lit(0.0)))
         .alias("std_days_between_purchases"))
    bought = articles_of(partials).join(articles.select("article_id", *ATTRS), "article_id", "left")
    tastes = attribute_counts(bought, "items").groupBy("customer_id").agg(
        F.sum(F.when(F.col("kind") == CATEGORY, F.col("products"))).alias("_products"),
        _most_frequent(CATEGORY).alias("_category"), _most_frequent(COLOR).alias("_color"),
        *[_values(i).alias(f"_values{i}") for i in range(len(ATTRS))])
    demo = customers.select("customer_id", "club_member_status", clip_upper("age", AGE_CAP).alias("age"),
                            "fashion_news_frequency")
    since_last = F.datediff(c, F.col("last_purchase_date"))
    since_first = F.datediff(c, F.col("first_purchase_date"))

    def per_item(x):
        return F.col(x) / F.col("total_purchases")

    out = (base.join(tastes, "customer_id", "left").join(demo, "customer_id", "left")
           .withColumn("unique_products_bought", F.coalesce("_products", F.lit(0)))
           .withColumns({
               "avg_order_value": safe_ratio("total_spend", "_priced"),
               "spend_per_purchase": safe_ratio("total_spend", "_priced"),
               "days_since_last_purchase": since_last, "days_since_first_purchase": since_first,
               "customer_tenure_days": F.datediff("last_purchase_date", "first_purchase_date"),
               "purchases_per_day": F.col("total_purchases") / (since_first + 1),
               "products_per_purchase": per_item("unique_products_bought"),
               "preferred_category": F.col("_category.v"), "preferred_category_count": -F.col("_category.neg"),
               "preferred_color": F.col("_color.v"), "preferred_color_count": -F.col("_color.neg"),
               "total_channel_purchases": F.col("total_purchases"),
               "online_preference_ratio": per_item("online_purchases"),
               "unique_categories": F.coalesce("_values0", F.lit(0)), "unique_colors": F.coalesce("_values1", F.lit(0)),
               "unique_garment_groups": F.coalesce("_values2", F.lit(0)),
               "last_purchase_month": F.month("last_purchase_date"),
               "weekend_purchase_ratio": per_item("weekend_purchases"),
               "is_churned": (since_last > churn_days).cast("int"),
               "churn_risk_level": churn_risk_level_expr(since_last)}))
    return out.select(*STORE_40_COLUMNS)


def churn_risk_level_expr(days, bounds=RISK_BOUNDS):
    a, m, h = bounds
    return F.when(days <= a, "Active").when(days <= m, "Moderate").when(days <= h, "High").otherwise("Churned")


STORE_40_COLUMNS = [
    "club_member_status", "customer_id", "last_purchase_date", "first_purchase_date", "total_purchases",
    "unique_shopping_days", "unique_products_bought", "total_spend", "avg_order_value", "max_single_purchase",
    "min_single_purchase", "price_std_dev", "days_since_last_purchase", "days_since_first_purchase",
    "customer_tenure_days", "purchases_per_day", "spend_per_purchase", "products_per_purchase",
    "preferred_category", "preferred_category_count", "preferred_color", "preferred_color_count",
    "store_purchases", "online_purchases", "total_channel_purchases", "online_preference_ratio",
    "unique_categories", "unique_colors", "unique_garment_groups", "weekend_purchases", "last_purchase_month",
    "weekend_purchase_ratio", "avg_days_between_purchases", "min_days_between_purchases",
    "max_days_between_purchases", "std_days_between_purchases", "is_churned", "churn_risk_level", "age",
    "fashion_news_frequency",
]
