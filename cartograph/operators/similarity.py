"""Content recommendations by cosine similarity to what a customer bought.

An article is a sparse vector of its attribute values, each weighted by rarity,
ln(1 + articles / articles with the value).  A customer's profile is the sum of
the vectors of the items bought.  Articles with the same values are one class and
have the same cosine; within a class the more popular come first.

Search: an inverted index lists the classes of each value.  A customer's own
classes, and those that share the heaviest value that enough articles have, are
scored first; the score that the k-th article among them has is a limit.  A class has one
value of each attribute, so a class with value f scores at most what f adds and
the most that a value of each other attribute adds, over the profile's and the
list's shortest vector.  Only lists whose bound reaches the limit are read, and
of the attributes, in the order of what they can add, only as many as are needed
until the others together cannot reach it.  So long lists of common values are
read by few customers, and no article that belongs in a list is missed.

Scale: a customer's profile and the classes move, not their pairs.  Slices of
customers meet blocks of classes, and a cell gives k classes for each customer.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartograph.functions.joins import materialize
from cartograph.functions.ranking import top_k_per_group
from cartograph.operators.recommend import K, interaction_matrix, popularity

# [ours]: the attributes that describe an article.
ATTRIBUTES = ("product_type_name", "product_group_name", "colour_group_name", "garment_group_name")
_ROUNDING = 1e-6  # scores are compared at 6 decimals
CUSTOMERS, CLASSES = 4096, 65536  # that meet in one cell


def attribute_index(articles: DataFrame, attributes: Sequence[str] = ATTRIBUTES) -> tuple[DataFrame, DataFrame]:
    """(members, postings): (article_id, cls) and, for each class and value, (cls, attr, value, weight, norm).

    ``cls`` is the class's smallest article id; ``norm`` the length of its vector.
    Null values weigh nothing, and an article without any value is in no class.
    """
    known = articles.select("article_id", *attributes).dropDuplicates(["article_id"])
    classes = materialize(known.groupBy(*attributes).agg(F.min("article_id").alias("cls"), F.count(F.lit(1)).alias("size")))
    values = classes.select("cls", "size", F.inline(F.array(*[
        F.struct(F.lit(a).alias("attr"), F.col(a).cast("string").alias("value")) for a in attributes]))).where("value is not null")
    weight = F.log(1 + F.lit(known.agg(F.count(F.lit(1))).scalar()) / F.col("holders"))
    weights = values.groupBy("attr", "value").agg(F.sum("size").alias("holders")).select("attr", "value", weight.alias("weight"))
    postings = values.join(weights, ["attr", "value"]).select("cls", "size", "attr", "value", "weight")
    norms = postings.groupBy("cls").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))
    same = classes.select(F.struct(*attributes).alias("values"), "cls")  # in a structure nulls are equal
    members = known.select("article_id", F.struct(*attributes).alias("values")).join(same, "values").select("article_id", "cls")
    return members, materialize(postings.join(norms, "cls"))


def _class_rows(postings: DataFrame, lists: DataFrame, top: DataFrame) -> DataFrame:
    """One row a class: its values' numbers in the order of attributes, norm, size, and its first article by popularity."""
    values = F.transform(F.sort_array(F.collect_list(F.struct("attr", "list"))), lambda x: x["list"])
    first = top.where("place = 1").select("cls", "popularity", F.col("article_id").alias("first"))
    return (postings.join(lists.select("attr", "value", "list"), ["attr", "value"])
            .groupBy("cls", "size", "norm").agg(values.alias("lists")).join(first, "cls"))


def _asked(reads: DataFrame, own: DataFrame, k: int) -> DataFrame:
    """(customer_id, reads, own, k): the lists that a customer reads, classes that are scored too, and how many are wanted."""
    listed = reads.groupBy("customer_id").agg(F.collect_list("list").alias("reads"))
    return listed.join(own.groupBy("customer_id").agg(F.collect_list("cls").alias("own")), "customer_id").withColumn("k", F.lit(k))


def _scores(asked: DataFrame, profile: DataFrame, classes: DataFrame) -> DataFrame:
    """(customer_id, cls, size, popularity, first, score): of the classes asked for, the k best of each customer.

    Slices of customers meet blocks of classes in cells.  A cell indexes its classes by value and scores only
    those in the lists read; k of them leave it, so no row is made for a pair.  The score is the cosine at 6
    decimals; of equal ones the class with the more popular first article comes first, then the smaller id of these.
    """
    rows = materialize(profile.groupBy("customer_id").agg(
        F.first("length").alias("length"), F.collect_list(F.struct("list", "adds")).alias("values")).join(asked, "customer_id").select(
        "customer_id", "length", "reads", "own", "k", F.col("values.list").alias("lists"), F.col("values.adds").alias("adds")))
    slices = rows.count() // CUSTOMERS + 1
    blocks = classes.count() // CLASSES + 1
    left = rows.select("*", F.pmod(F.xxhash64("customer_id"), F.lit(slices)).cast("int").alias("slice"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    right = classes.select("*", F.pmod(F.xxhash64("cls"), F.lit(blocks)).cast("int").alias("block"),
                           F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    kinds = {"customer_id": profile, "cls": classes, "size": classes, "popularity": classes, "first": classes}
    made = ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c, df in kinds.items()) + ", score double"

    names = list(kinds)

    def numbers(column, kind) -> tuple[np.ndarray, np.ndarray]:
        """The lists' items in one array, and where each list begins and ends."""
        held = column.combine_chunks()
        ends = np.cumsum([0, *(held.value_lengths().to_numpy(zero_copy_only=False))])
        return held.flatten().to_numpy(zero_copy_only=False).astype(kind), ends

    def cell(customers: pa.Table, items: pa.Table) -> pa.Table:
        items = items.sort_by([("popularity", "descending"), ("first", "ascending")])
        n = items.num_rows
        held, at = numbers(items["lists"], np.int64)
        known, code = np.unique(held, return_inverse=True)
        of_item = np.repeat(np.arange(n), np.diff(at))
        slots = np.full((max(np.diff(at), default=0), n), len(known))  # the values of an item, filled up with one that adds nothing
        slots[np.arange(len(held)) - np.repeat(at[:-1], np.diff(at)), of_item] = code
        order = np.argsort(code, kind="stable")
        members, starts = of_item[order], np.searchsorted(code[order], np.arange(len(known) + 1))
        norms, places = items["norm"].to_numpy(), dict(zip(items["cls"].to_pylist(), range(n)))
        lists, ends = numbers(customers["lists"], np.int64)
        adds, _ = numbers(customers["adds"], np.float64)
        reads, upto = numbers(customers["reads"], np.int64)
        lengths, wanted = customers["length"].to_numpy(), customers["k"].to_numpy()
        place = np.searchsorted(known, lists)
        here = np.append(known, -1)[place] == lists
        read = np.searchsorted(known, reads)
        read_here = np.append(known, -1)[read] == reads
        gain = np.zeros(len(known) + 1)
        rows_, found, scores = [], [], []
        for i, mine in enumerate(customers["own"].to_pylist()):
            own_ = slice(ends[i], ends[i + 1])
            codes, values = place[own_][here[own_]], adds[own_][here[own_]]
            read_ = slice(upto[i], upto[i + 1])
            near = np.unique(np.concatenate([*(members[starts[c]:starts[c + 1]] for c in read[read_][read_here[read_]]),
                                             np.array([places[c] for c in mine if c in places], np.int64)]))
            gain[codes] = values
            total = np.zeros(len(near))
            for slot in slots:  # one attribute after another: the same sum whatever the block
                total += gain[slot[near]]
            gain[codes] = 0.0
            score = np.floor(total / lengths[i] / norms[near] * 1e6 + 0.5) / 1e6
            best = np.lexsort((near, -score))[:wanted[i]]
            rows_.append(np.full(len(best), i))
            found.append(near[best])
            scores.append(score[best])
        at_ = pa.array(np.concatenate(rows_ or [np.empty(0)]).astype(np.int64))
        of = pa.array(np.concatenate(found or [np.empty(0)]).astype(np.int64))
        return pa.table([customers["customer_id"].take(at_), *(items[c].take(of) for c in ("cls", "size", "popularity", "first")),
                         pa.array(np.concatenate(scores or [np.empty(0)]))], names=[*names, "score"])

    return left.groupBy("slice", "block").cogroup(right.groupBy("slice", "block")).applyInArrow(cell, made)


def similarity_recommender(tx: DataFrame, articles: DataFrame, before: str | None = None, k: int = K,
                           attributes: Sequence[str] = ATTRIBUTES) -> DataFrame:
    """(customer_id, article_id, score, rank): the k articles most like what the customer bought.

    Ordered by the cosine at 6 decimals, then popularity, then article id.
    Articles that share no value with the profile are never listed, and
    customers whose purchases have no known value have no list.
    """
    members, postings = attribute_index(articles, attributes)
    members = materialize(members)
    bought = materialize(interaction_matrix(tx, before).join(members, "article_id")
                         .groupBy("customer_id", "cls").agg(F.sum("purchase_count").alias("n")))
    lists = materialize(postings.groupBy("attr", "value").agg(
        F.min("norm").alias("shortest"), F.sum("size").alias("holders"), F.first("weight").alias("weight")).withColumn("list", F.monotonically_increasing_id()))
    popular = members.join(popularity(tx, before), "article_id", "left").select(
        "article_id", "cls", F.coalesce("popularity", F.lit(0)).alias("popularity"))
    top = materialize(top_k_per_group(popular, ["cls"], [F.col("popularity").desc(), F.col("article_id").asc()], k, name="place", salt_key="article_id"))
    classes = materialize(_class_rows(postings, lists, top))
    counted = bought.join(postings, "cls").groupBy("customer_id", "attr", "value").agg(F.sum("n").alias("n"))
    # ``adds`` is what a class with the value gains: its weight times the profile's.
    of_customer = Window.partitionBy("customer_id")
    profile = materialize(counted.join(lists, ["attr", "value"]).withColumn("adds", F.col("n") * F.col("weight") * F.col("weight")).withColumn(
        "length", F.sqrt(F.sum(F.pow(F.col("n") * F.col("weight"), 2)).over(of_customer))).select(
        "customer_id", "attr", "list", "adds", "length", "shortest", "holders"))

    heaviest = profile.groupBy("customer_id").agg(
        F.max(F.struct(F.col("holders") >= k, "adds", "attr", "list")).alias("best")).select("customer_id", "best.list")
    # Any classes give a valid limit: the k bought most often.
    own = materialize(top_k_per_group(bought, ["customer_id"], [F.col("n").desc(), F.col("cls").asc()], k, salt_key="cls").select("customer_id", "cls"))
    first = materialize(_scores(_asked(heaviest, own, k), profile, classes))
    held = F.sum("size").over(Window.partitionBy("customer_id").orderBy(F.col("score").desc())
                              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    limits = first.withColumn("held", held).where(F.col("held") >= k).groupBy("customer_id").agg(F.max("score").alias("limit"))

    shortest_of_all = postings.agg(F.min("norm")).scalar()
    most = profile.groupBy("customer_id", "attr").agg(F.max("adds").alias("most"), F.first("length").alias("length"))
    later = Window.partitionBy("customer_id").orderBy(F.col("most").desc(), "attr").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    reach = (F.col("limit") - _ROUNDING) * F.col("length")
    # Attributes whose own and all lesser ones' most reach the limit together: a class without the others' values needs one of these.
    needed = (most.withColumn("rest", F.sum("most").over(later)).withColumn("all", F.sum("most").over(of_customer))
              .join(limits, "customer_id", "left").withColumn("limit", F.coalesce("limit", F.lit(0.0)))
              .where(F.col("rest") >= reach * shortest_of_all))
    to_read = (profile.join(needed.drop("length"), ["customer_id", "attr"])
               .where(F.col("adds") + F.col("all") - F.col("most") >= reach * F.col("shortest"))
               .select("customer_id", "list"))
    found = first.unionByName(_scores(_asked(to_read, own, k), profile, classes)).distinct()
    # A class is in the list only where fewer than k articles have a higher score, and of equal ones only as one of the first k.
    by_score = Window.partitionBy("customer_id").orderBy(F.col("score").desc())
    by_place = Window.partitionBy("customer_id").orderBy(F.col("score").desc(), F.col("popularity").desc(), F.col("first").asc())
    tied = F.sum("size").over(Window.partitionBy("customer_id", "score"))
    upto = F.sum("size").over(by_score.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    best = (found.withColumn("higher", upto - tied).withColumn("at", F.row_number().over(by_place))
            .where((F.col("higher") < k) & (F.col("at") <= k)).select("customer_id", "cls", "score"))
    order = Window.partitionBy("customer_id").orderBy(F.col("score").desc(), F.col("popularity").desc(), F.col("article_id").asc())
    return (best.join(top, "cls").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("customer_id", "article_id", "score", "rank"))
