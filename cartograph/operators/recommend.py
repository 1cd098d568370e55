"""Recommenders and their evaluation (MAP@k).

* popularity (global, per category) and recency-weighted popularity: top-k lists;
* content-based: per customer the k best articles of the preferred category,
  articles of the preferred colour first, then by popularity (exact, with a
  candidate set bounded by the category × colour domain, not by the data);
* ALS (implicit feedback) on the interaction matrix;
* a ladder of popularity lists (group and colour, group, global), by what is
  known of a customer;
* hybrid: weighted blend of the ladder's and the content ranks;
* MAP@k of per-customer lists or of one global list against a later window.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.dates import as_date
from cartograph.functions.joins import broadcast_bounded, join_small, materialize
from cartograph.functions.ranking import global_row_number, top_k_per_group
from cartograph.functions.scalars import round6
from cartograph.operators.store import preferred_value

K = 12
USER_BLOCK, ITEM_BLOCK = 8192, 4096  # factors scored against one another at once
RATINGS = 1 << 23  # of a block of the ALS at most, and never less than its 10 blocks: a task holds a block and the factors it needs
MORE_USERS, MORE_ITEMS, CELLS = 4, 16, 64  # of many users or items, so many blocks are one cell's, if CELLS cells remain


def _before(tx: DataFrame, before: str | None) -> DataFrame:
    return tx if before is None else tx.filter(F.col("t_dat") < as_date(before))


def interaction_matrix(tx: DataFrame, before: str | None = None) -> DataFrame:
    """customer × article × item count."""
    return _before(tx, before).groupBy("customer_id", "article_id").agg(F.count(F.lit(1)).alias("purchase_count"))


def popularity(tx: DataFrame, before: str | None = None) -> DataFrame:
    return _before(tx, before).groupBy("article_id").agg(F.count(F.lit(1)).alias("popularity"))


def popularity_recommender(tx: DataFrame, k: int = K, before: str | None = None) -> DataFrame:
    """The global top-k list (article_id, rank); ties by article id."""
    top = popularity(tx, before).orderBy(F.col("popularity").desc(), F.col("article_id").asc()).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("popularity").desc(),
                                                                    F.col("article_id").asc())))


def category_popularity_recommender(tx: DataFrame, articles: DataFrame, k: int = K,
                                    before: str | None = None, group_col: str = "product_group_name") -> DataFrame:
    """Top-k per product group (exact; hot groups are split before ranking)."""
    pop = popularity(tx, before).join(articles.select("article_id", group_col), "article_id")
    return top_k_per_group(pop, [group_col], [F.col("popularity").desc(), F.col("article_id").asc()], k,
                           salt_key="article_id")


def recency_weighted_popularity(tx: DataFrame, before: str, k: int = K, half_life_days: float = 30.0) -> DataFrame:
    """Top-k articles by Σ 2^(−age/half-life) over purchases before ``before``, on the score rounded to
    6 places (so that the order of summation cannot change the list); ties by id."""
    w = F.exp(F.lit(-math.log(2.0) / half_life_days) * F.datediff(as_date(before), F.col("t_dat")))
    s = _before(tx, before).groupBy("article_id").agg(round6(F.sum(w)).alias("score"))
    top = s.orderBy(F.col("score").desc(), F.col("article_id").asc()).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col("score").desc(),
                                                                    F.col("article_id").asc())))


def content_recommender(tx: DataFrame, articles: DataFrame, before: str | None = None, k: int = K) -> DataFrame:
    """(customer_id, article_id, rank): the preferred category's articles, preferred
    colour first, then popularity, then id.

    Candidates of a (category, colour) pair are the pair's top k and the
    category's top 2k with a colour and 2k without one (these come last), which
    provably contain the answer: at most 5k rows a pair.
    """
    end = before or "9999-12-31"
    pc = preferred_value(tx, articles, "product_group_name", "cat", end).select("customer_id", "cat")
    pl = preferred_value(tx, articles, "colour_group_name", "col", end).select("customer_id", "col")
    prefs = materialize(pc.join(pl, "customer_id"))  # per customer; read by the combos and the final join
    pop = popularity(tx, before).join(
        articles.select("article_id", F.col("product_group_name").alias("cat"),
                        F.col("colour_group_name").alias("acol")), "article_id")
    per_cc = top_k_per_group(pop, ["cat", "acol"], [F.col("popularity").desc(), F.col("article_id").asc()], k,
                             name="_r", salt_key="article_id").drop("_r")
    combos = prefs.select("cat", "col").distinct()
    # A pair's answer is within its own colour's top k and the category's top 2k (at most k of these have
    # its colour): k + 4k candidates a pair, whatever the number of colours.
    # Articles without a colour rank after all others, so they are counted apart.
    per_c = top_k_per_group(pop.withColumn("_plain", F.col("acol").isNull()), ["cat", "_plain"],
                            [F.col("popularity").desc(), F.col("article_id").asc()], 2 * k, name="_r", salt_key="article_id").drop("_r")
    own = combos.join(per_cc, (combos["cat"] == per_cc["cat"]) & (combos["col"] == per_cc["acol"])).select(
        combos["cat"], "col", "article_id", "popularity", "acol")
    any_colour = combos.join(per_c, "cat").select("cat", "col", "article_id", "popularity", "acol")
    cand = own.unionByName(any_colour).distinct()
    w = Window.partitionBy("cat", "col").orderBy((F.col("acol") == F.col("col")).desc(),
                                                 F.col("popularity").desc(), F.col("article_id").asc())
    ranked = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    # Broadcast where its bytes allow it; else a hot (category, colour) pair is split by adaptive execution.
    return join_small(prefs, ranked.select("cat", "col", "article_id", "rank"), ["cat", "col"], "inner").select(
        "customer_id", "article_id", "rank")


RUNGS = ("group and colour", "group", "global")


def ladder_recommender(tx: DataFrame, articles: DataFrame, customers: DataFrame, before: str | None = None, k: int = K,
                       known: DataFrame | None = None) -> DataFrame:
    """(customer_id, article_id, rank, rung): popularity lists from the narrowest that is known of a customer.

    The list of the customer's group and colour is filled up from the group's and
    that from the global one, without repeats; ``rung`` names the list an article
    comes from.  ``known`` is (customer_id, cat, col), either possibly null; by
    default the customer's most frequent group and colour before ``before``.
    Customers of whom nothing is known get the global list.

    Lists are made for each known (group, colour), of at most 3k candidates; hot
    groups are split before they are ranked.
    """
    end = before or "9999-12-31"
    if known is None:
        group = preferred_value(tx, articles, "product_group_name", "cat", end).select("customer_id", "cat")
        colour = preferred_value(tx, articles, "colour_group_name", "col", end).select("customer_id", "col")
        known = group.join(colour, "customer_id", "full")
    prefs = materialize(customers.select("customer_id").distinct().join(known, "customer_id", "left"))
    order = [F.col("popularity").desc(), F.col("article_id").asc()]
    pop = materialize(popularity(tx, before).join(articles.select(
        "article_id", F.col("product_group_name").alias("cat"), F.col("colour_group_name").alias("col")), "article_id", "left"))
    both = top_k_per_group(pop.where("cat is not null and col is not null"), ["cat", "col"], order, k, name="place", salt_key="article_id")
    each = top_k_per_group(pop.where("cat is not null"), ["cat"], order, k, name="place", salt_key="article_id")
    top = pop.orderBy(*order).limit(k).withColumn("place", F.row_number().over(Window.orderBy(*order)))
    pairs = prefs.select("cat", "col").distinct()  # as many as known groups and colours
    everywhere = top.agg(F.sort_array(F.collect_list(F.struct("place", "article_id")))).scalar()
    steps = [pairs.join(both, ["cat", "col"]).select("cat", "col", F.lit(0).alias("step"), "place", "article_id"),
             pairs.join(each.drop("col"), "cat").select("cat", "col", F.lit(1).alias("step"), "place", "article_id"),
             pairs.select("cat", "col", F.lit(2).alias("step"), F.inline(everywhere)).select("cat", "col", "step", "place", "article_id")]
    first = F.min(F.struct("step", "place")).alias("at")
    lists = (steps[0].unionByName(steps[1]).unionByName(steps[2]).groupBy("cat", "col", "article_id").agg(first)
             .withColumn("rank", F.row_number().over(Window.partitionBy("cat", "col").orderBy("at.step", "at.place")))
             .where(F.col("rank") <= k)
             .select(F.struct("cat", "col").alias("pair"), "article_id", "rank", F.get(F.array(*map(F.lit, RUNGS)), F.col("at.step")).alias("rung")))
    # Joined on a structure, in which nulls are equal.
    return join_small(prefs.select("customer_id", F.struct("cat", "col").alias("pair")), lists, "pair", "inner").select(
        "customer_id", "article_id", "rank", "rung")


def hybrid_recommender(tx: DataFrame, articles: DataFrame, customers: DataFrame, before: str | None = None,
                       k: int = K, w_content: float = 0.6, w_popularity: float = 0.4, known: DataFrame | None = None) -> DataFrame:
    """Blend of rank scores (k+1−rank) from content and popularity lists.

    Every customer gets the popularity list that ``ladder_recommender`` gives
    for what is known of them, so customers without a purchase are covered too.
    """
    popular = ladder_recommender(tx, articles, customers, before, k, known).select(
        "customer_id", "article_id", (F.lit(w_popularity) * (k + 1 - F.col("rank"))).alias("s"))
    content = content_recommender(tx, articles, before, k).select(
        "customer_id", "article_id", (F.lit(w_content) * (k + 1 - F.col("rank"))).alias("s"))
    blended = popular.unionByName(content).groupBy("customer_id", "article_id").agg(F.sum("s").alias("score"))
    w = Window.partitionBy("customer_id").orderBy(round6(F.col("score")).desc(), F.col("article_id").asc())
    return blended.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def dense_ids(df: DataFrame, col: str, name: str) -> DataFrame:
    """Distinct values of ``col`` numbered 0..n−1 without collecting them (ALS needs int ids)."""
    d = df.select(col).distinct()
    return global_row_number(d, [F.col(col).asc()], name).withColumn(name, (F.col(name) - 1).cast("int"))


def _scored_cells(users: DataFrame, items: DataFrame, n_users: int, first: int, blocks: int, k: int) -> DataFrame:
    """(uid, best): the best of the given item blocks for every user, at most k, sorted (loss, article_id).

    ``users`` is (uid, features, length, worst), ``items`` (block, article_id, features, length).  Nothing
    above ``worst`` is returned (null: no limit), and users whom that leaves nothing are not.  Users are
    dealt into slices, blocks into cells; a user goes to those cells only whose longest item can reach
    ``worst``.  A cell multiplies matrices (numpy: Spark has no product of matrices outside of its models,
    and array functions take a hundred times as long): a quick product finds the pairs that can be among
    the best, whatever it rounds; these are summed one factor after another, the same in any block.
    """
    slices = max(min(n_users // USER_BLOCK, CELLS), n_users // (MORE_USERS * USER_BLOCK)) + 1
    together = min(max(blocks * slices // CELLS, 1), MORE_ITEMS)
    kind = items.schema["article_id"].dataType.simpleString()
    dealt = items.withColumn("cell", F.floor((F.col("block") - first) / together).cast("int"))
    longest = dealt.groupBy("cell").agg(F.max("length").alias("longest")).orderBy("cell").collect()  # a row for up to MORE_ITEMS blocks of items
    reached = F.filter(F.array(*[F.struct(F.lit(c["cell"]).alias("cell"), F.lit(c["longest"]).alias("longest")) for c in longest]),
                       lambda c: F.col("worst").isNull() | (F.col("length") * c["longest"] * F.lit(1 + 1e-9) >= -F.col("worst")))
    own = users.select("uid", "features", "length", "worst", F.pmod(F.xxhash64("uid"), F.lit(slices)).cast("int").alias("slice"),
                       F.explode(reached["cell"]).alias("cell"))
    others = dealt.select("article_id", "features", "length", "cell", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))

    def matrix(column) -> np.ndarray:
        flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        return flat.reshape(len(column), -1)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("uid", pa.int32()), ("best", pa.list_(pa.struct([("loss", pa.float64()), ("article_id", right["article_id"].type)])))])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        right = right.sort_by([("length", "descending"), ("article_id", "ascending")])
        by_id = np.empty(right.num_rows, dtype=np.int64)  # equal products in the order of ids
        by_id[pa.compute.sort_indices(right["article_id"]).to_numpy()] = np.arange(right.num_rows)
        factors, lengths, most = matrix(right["features"]), right["length"].to_numpy(), min(k, right.num_rows)
        limits = left["worst"].to_numpy().astype(np.float64)  # null: nan
        limits[np.isnan(limits)] = np.inf
        with np.errstate(divide="ignore", invalid="ignore"):
            need = np.nan_to_num(-limits / left["length"].to_numpy(), nan=-np.inf)  # the length from which an item can enter
        turn = np.argsort(need, kind="stable")  # users who need the same items go together
        left, limits = left.take(pa.array(turn)), limits[turn]
        own_lengths = left["length"].to_numpy()
        users_, places, losses = [], [], []
        for at in range(0, left.num_rows, 256):
            own_, limit, size = matrix(left["features"].slice(at, 256)), limits[at: at + 256].copy(), own_lengths[at: at + 256]
            held_i, held_j, held_loss = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0)
            for start in range(0, len(factors), ITEM_BLOCK):
                if not (size * lengths[start] * (1 + 1e-9) >= -limit).any():  # nor can a shorter one
                    break
                some = factors[start: start + ITEM_BLOCK]
                quick = own_ @ some.T
                slack = 1e-12 * size * lengths[start]  # far more than two orders of summation can differ by
                low = -limit - slack
                open_ = np.isinf(limit)
                if open_.any() and len(some) > most:
                    low[open_] = -np.partition(-quick[open_], most - 1, axis=1)[:, most - 1] - 2 * slack[open_]
                i, j = np.nonzero(quick >= low[:, None])
                loss = np.zeros(len(i))
                for f in range(factors.shape[1]):  # one factor after another: the same sum whatever the block
                    loss -= own_[i, f] * some[j, f]
                fit = loss <= limit[i]
                i, j, loss = (np.concatenate([a, b[fit]]) for a, b in ((held_i, i), (held_j, j + start), (held_loss, loss)))
                order = np.lexsort((by_id[j], loss, i))
                i, j, loss = i[order], j[order], loss[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                last = rank == k - 1  # from here on no larger loss can enter
                limit[i[last]] = loss[last]
                held_i, held_j, held_loss = i[rank < k], j[rank < k], loss[rank < k]
            users_.append(held_i + at)
            places.append(held_j)
            losses.append(held_loss)
        who, counts = np.unique(np.concatenate(users_), return_counts=True)
        best = pa.StructArray.from_arrays([pa.array(np.concatenate(losses)), right["article_id"].combine_chunks().take(pa.array(np.concatenate(places)))],
                                          ["loss", "article_id"])
        ends = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
        return pa.table([left["uid"].take(pa.array(who)).cast(pa.int32()), pa.ListArray.from_arrays(ends, best)], schema=schema)

    cells = own.groupBy("slice", "cell").cogroup(others.groupBy("slice", "cell")).applyInArrow(
        cell, f"uid int, best array<struct<loss:double,article_id:{kind}>>")
    merged = cells.groupBy("uid").agg(F.flatten(F.collect_list("best")).alias("best"))
    return merged.select("uid", F.slice(F.sort_array("best"), 1, k).alias("best"))


def best_products(users: DataFrame, items: DataFrame, k: int) -> tuple[DataFrame, float]:
    """((uid, pos, r), share): the k items with the largest product of factors for every user, over all items.

    ``users`` is (uid, features), ``items`` (article_id, features).  Items are sorted by the length of
    their factors into blocks of fixed size.  No product exceeds the two lengths' product, so a user is
    done when that with the longest item not yet seen is below the user's k-th best.  Blocks are taken
    in rounds of 1, 1, 2, 4, … of them, each only for the users that are not done.  ``r`` is (loss,
    article_id), ``share`` the part of all pairs that the rounds had, of which some were left out.  Exact: ties are searched too, and the
    bound is raised by more than rounding can take from it.
    """
    length = F.sqrt(F.aggregate(F.transform("features", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x))
    placed = global_row_number(items.select("article_id", "features", length.alias("length")),
                               [F.col("length").desc(), F.col("article_id").asc()], "place")
    block = F.floor((F.col("place") - 1) / ITEM_BLOCK).cast("int")
    placed = materialize(placed.withColumn("block", block).withColumn(
        "turn", F.when(F.col("block") == 0, 0).otherwise(F.floor(F.log2("block")).cast("int") + 1)))
    turns = (placed.groupBy("turn").agg(F.max("length").alias("longest"), F.count(F.lit(1)).alias("n"), F.min("block").alias("first"),
                                        F.max("block").alias("last")).orderBy("turn").collect())  # the logarithm of the blocks
    kind = f"array<struct<loss:double,article_id:{items.schema['article_id'].dataType.simpleString()}>>"
    left = materialize(users.select("uid", "features", length.alias("length"), F.array().cast(kind).alias("best")))
    done, all_users, scored = [], left.count(), 0
    n_users = all_users
    for i, turn in enumerate(turns):
        worst = F.get("best", F.lit(k - 1))["loss"].alias("worst")  # null with fewer than k
        found = _scored_cells(left.select("uid", "features", "length", worst), placed.where(F.col("turn") == turn["turn"]), n_users, turn["first"],
                              turn["last"] - turn["first"] + 1, k).withColumnRenamed("best", "more")
        merged = materialize(left.join(found, "uid", "left").withColumn(
            "best", F.slice(F.sort_array(F.concat("best", F.coalesce("more", F.array().cast(kind)))), 1, k)).drop("more"))
        scored += n_users * turn["n"]
        longest = turns[i + 1]["longest"] if i + 1 < len(turns) else None
        if longest is None:
            done.append(merged)
            break
        bound = F.col("length") * F.lit(longest) * F.lit(1 + 1e-9)
        open_ = (F.size("best") < k) | (bound >= -F.get("best", F.lit(k - 1))["loss"])
        done.append(merged.where(~open_))
        left = merged.where(open_)
        n_users = left.count()
        if not n_users:
            break
    n_items = sum(t["n"] for t in turns)
    lists = reduce(DataFrame.unionByName, done) if done else left.where("false")
    return (lists.select("uid", F.posexplode("best").alias("pos", "r")), scored / max(all_users * n_items, 1))


def als_lists(tx: DataFrame, before: str | None = None, k: int = K, rank: int = 10, max_iter: int = 10,
              reg: float = 0.1, alpha: float = 1.0, seed: int = 42) -> tuple[DataFrame, float]:
    """(``als_recommender``'s lists, the share of all customer and article pairs that was scored for them)."""
    from pyspark.ml.recommendation import ALS
    inter = materialize(interaction_matrix(tx, before))
    users = materialize(dense_ids(inter, "customer_id", "uid"))
    items = materialize(dense_ids(inter, "article_id", "iid"))
    data = materialize(inter.join(users, "customer_id").join(items, "article_id").select(
        "uid", "iid", F.col("purchase_count").cast("float").alias("rating")))
    blocks = max(10, math.ceil(data.count() / RATINGS))
    # Blocks stay on disk between their tasks, and each iteration removes the shuffle files of the last.
    model = ALS(userCol="uid", itemCol="iid", ratingCol="rating", implicitPrefs=True, rank=rank,
                maxIter=max_iter, regParam=reg, alpha=alpha, seed=seed, coldStartStrategy="drop", numUserBlocks=blocks, numItemBlocks=blocks,
                intermediateStorageLevel="DISK_ONLY", checkpointInterval=1).fit(data)
    factors = materialize(items.join(model.itemFactors, F.col("iid") == F.col("id")).select("article_id", "features"))
    best, share = best_products(materialize(model.userFactors.select(F.col("id").alias("uid"), "features")), factors, k)
    return best.join(users, "uid").select("customer_id", F.col("r.article_id").alias("article_id"),
                                          (F.col("pos") + 1).alias("rank"), (-F.col("r.loss")).alias("score")), share


def als_recommender(tx: DataFrame, before: str | None = None, k: int = K, **options) -> DataFrame:
    """Implicit-feedback ALS on item counts; top-k per customer (customer_id, article_id, rank, score).

    A customer's list is the best of all bought articles by the product of the
    factors, ties by article id; articles that cannot be in it are not scored.
    Ids are 32-bit in Spark's ALS, so at most 2.1 billion customers or articles.
    """
    return als_lists(tx, before, k, **options)[0]


def actual_purchases(tx: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct (customer, article) bought in [start, end]."""
    return tx.filter(F.col("t_dat").between(as_date(start), as_date(end))).select(
        "customer_id", "article_id").distinct()


def _map_from_hits(hits: DataFrame, actual: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("customer_id").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    prec = hits.withColumn("_cum", F.count(F.lit(1)).over(w)).groupBy("customer_id").agg(
        F.sum(F.col("_cum") / F.col("rank")).alias("_ap_num"))
    n_act = actual.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n"))
    ap = n_act.join(prec, "customer_id", "left").select(
        "customer_id", (F.coalesce(F.col("_ap_num"), F.lit(0.0)) / F.least(F.col("_n"), F.lit(k))).alias("ap"))
    return ap.agg(F.avg("ap").alias(f"map_at_{k}"), F.count(F.lit(1)).alias("customers"))


def map_at_k(recs: DataFrame, actual: DataFrame, k: int = K) -> DataFrame:
    """MAP@k of per-customer lists (customer_id, article_id, rank) over customers with purchases."""
    hits = recs.filter(F.col("rank") <= k).join(actual, ["customer_id", "article_id"], "left_semi")
    return _map_from_hits(hits, actual, k)


def map_at_k_global(ranked_list: DataFrame, actual: DataFrame, k: int = K) -> DataFrame:
    """MAP@k when every customer gets the same list (≤ k rows, broadcast)."""
    hits = actual.join(broadcast_bounded(ranked_list.select("article_id", "rank").filter(F.col("rank") <= k)),
                       "article_id")
    return _map_from_hits(hits.select("customer_id", "article_id", "rank"), actual, k)
