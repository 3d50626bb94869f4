"""Collaborative filtering: neighbour items, unseen ranking, records, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions import columns as C
from beaconry.operators.neighbours import neighbours
from beaconry.session import cut


def dense_index(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of ``col`` numbered from 1 in order, without one global sort task.

    Values are range-partitioned and stored with the number of their range, so a lost
    executor cannot shift the ranges; only the range sizes are summed up in one task.
    """
    ids = df.select(col).dropna().distinct().repartitionByRange(col)
    ranged = cut(ids.withColumn("_b", F.spark_partition_id()))
    sizes = ranged.groupBy("_b").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(W.partitionBy(F.lit(0)).orderBy("_b").rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select("_b", F.coalesce(before, F.lit(0)).alias("_before"))
    inside = F.row_number().over(W.partitionBy("_b").orderBy(col))
    return (ranged.withColumn("_in", inside).join(offsets, "_b")
            .select(col, (F.col("_before") + F.col("_in")).cast("bigint").alias("pos")))


def neighbour_items(near: DataFrame, inter: DataFrame) -> DataFrame:
    """Items of each user's neighbours, with the neighbour's similarity."""
    theirs = inter.select(F.col("user_id").alias("neighbour"), "item_id")
    return near.select("user_id", "neighbour", "similarity").join(theirs, "neighbour")


def drop_seen(scores: DataFrame, inter: DataFrame) -> DataFrame:
    return scores.join(inter.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def cf_scores(inter: DataFrame, k: int = 5, near: DataFrame | None = None) -> DataFrame:
    """Unseen items by the summed similarity of the ``k`` nearest users that have them."""
    near = neighbours(inter, k) if near is None else near
    scores = neighbour_items(near, inter).groupBy("user_id", "item_id").agg(
        F.round(F.sum("similarity"), 10).alias("score"))
    return drop_seen(scores, inter)


def _zero_items(short: DataFrame, inter: DataFrame, scored: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The first unseen, unscored items by id for users whose scored list is shorter than ``n``.

    Such a user excludes ``seen + scored`` items, so the wanted ones lie in the first
    ``n + seen`` of the catalogue: each user meets that prefix only, not all items.
    """
    index = dense_index(items, "item_id")
    prefix = short.select("user_id", "n_scored",
                          F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_seen") + n)).alias("pos"))
    taken = inter.select("user_id", "item_id").unionByName(scored.select("user_id", "item_id"))
    w = W.partitionBy("user_id").orderBy("pos")
    return (prefix.join(index, "pos").join(taken, ["user_id", "item_id"], "left_anti")
            .withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
            .filter(F.col("_rn") + F.col("n_scored") <= n)
            .select("user_id", "item_id", F.lit(0.0).alias("score"),
                    (F.col("n_scored") + F.col("_rn")).cast("bigint").alias("rank")))


def cf_topn(inter: DataFrame, items: DataFrame, k: int = 5, n: int = 100, users: DataFrame | None = None,
            near: DataFrame | None = None) -> DataFrame:
    """The ``n`` best unseen items per user; items nobody near has stay in with score 0.

    Columns: user_id, item_id, score, rank. ``users`` adds users without any interaction.
    """
    w = W.partitionBy("user_id").orderBy(F.col("score").desc(), "item_id")
    # Read three times below: computed once.
    scored = cut(cf_scores(inter, k, near).withColumn("rank", F.row_number().over(w).cast("bigint"))
                 .filter(F.col("rank") <= n))
    seen = inter.groupBy("user_id").agg(F.count("*").alias("n_seen"))
    if users is not None:
        seen = users.select("user_id").distinct().join(seen, "user_id", "left").select(
            "user_id", F.coalesce("n_seen", F.lit(0).cast("bigint")).alias("n_seen"))
    got = scored.groupBy("user_id").agg(F.count("*").alias("n_scored"))
    short = (seen.join(got, "user_id", "left")
             .withColumn("n_scored", F.coalesce("n_scored", F.lit(0).cast("bigint")))
             .filter(F.col("n_scored") < n))
    return scored.select("user_id", "item_id", "score", "rank").unionByName(
        _zero_items(short, inter, scored, items, n))


def recommendation_records(topn: DataFrame, inter: DataFrame, as_of: str, n: int = 100, ttl_days: int = 7) -> DataFrame:
    """One record per user: list padded with NULLs to ``n``, counts, stamp and expiry."""
    lists = topn.groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "item_id"))), lambda x: x["item_id"]).alias("_l"))
    seen = inter.groupBy("user_id").agg(F.count("*").alias("num_previously_seen"))
    at = F.lit(as_of).cast("timestamp")
    return lists.join(seen, "user_id", "left").select(
        "user_id", F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        C.pad_list("_l", n).alias("ads"), F.size("_l").cast("bigint").alias("num_recommendations"),
        F.coalesce("num_previously_seen", F.lit(0).cast("bigint")).alias("num_previously_seen"),
        (F.unix_timestamp(at) + ttl_days * 86400).alias("ttl"))


def seen_overlap(records: DataFrame, inter: DataFrame) -> DataFrame:
    """Number of recommended items each user has already seen; users with none are left out."""
    recommended = records.select("user_id", F.explode("ads").alias("item_id")).dropna(subset=["item_id"]).distinct()
    return recommended.join(inter, ["user_id", "item_id"], "left_semi").groupBy("user_id").agg(
        F.count("*").alias("n_seen"))


def validate_recommendations(records: DataFrame, inter: DataFrame) -> DataFrame:
    """One row per issue: repeated items, or items already seen."""
    dup = records.filter(C.has_duplicates("ads")).select(
        F.col("user_id").cast("string").alias("user_id"), F.lit("duplicate items").alias("issue"))
    seen = seen_overlap(records, inter).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.col("n_seen").cast("string"), F.lit(" items already seen")).alias("issue"))
    return dup.unionByName(seen)


def recommendation_summary(records: DataFrame) -> DataFrame:
    n = F.col("num_recommendations")
    return records.agg(F.count("*").alias("n_users"), F.sum(n).alias("total_recommendations"),
                       F.avg(n).alias("avg_recommendations"), F.min(n).alias("min_recommendations"),
                       F.max(n).alias("max_recommendations"))


def feedback_interactions(inter: DataFrame, clicked: DataFrame) -> DataFrame:
    """Interactions with clicks and orders flowing back: union, each pair once."""
    return inter.select("user_id", "item_id").unionByName(clicked.select("user_id", "item_id")).distinct()
