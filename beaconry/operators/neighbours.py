"""User-user similarity on shared items.

Users with the same item set are one profile, so copies cost nothing. Profiles that share an item meet by inverted
lists (see ``inverted``) or, where the catalogue is so narrow that most of them do, all pairs are counted by matrix products
(see ``dense``); the similarity of two users is shared / sqrt(n_u * n_v). For a fixed user the order by
similarity is the order by shared^2 / n_v, which is exact in doubles; equal values go to the lower user id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.operators import dense, inverted, partners
from beaconry.operators.tiles import fresh
from beaconry.session import cut

SEED_ITEMS = 3  # rarest items of a profile whose holders set its first bar
SEED_HOLDERS = 64
ROOM = 1 - 1e-12  # a bar is a rounded quotient: times the size it may come out above the very square it was made of


def interactions(events: DataFrame, kinds: list[str], item: str = "product_id") -> DataFrame:
    """Distinct (user, item) pairs of the given event kinds."""
    return (events.filter(F.col("event_type").isin(kinds))
            .select("user_id", F.col(item).alias("item_id")).dropna().distinct())


def profiles(inter: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(user, profile) and one row per profile: items with their holders, rare ones first, size, members, lowest member."""
    per_user = inverted.lists_by_rarity(inter, "user_id", "item_id")
    keyed = cut(per_user.withColumn("profile", F.sha2(F.to_json("items"), 256)))
    per_profile = keyed.groupBy("profile").agg(
        F.any_value("items").alias("items"), F.count("*").alias("members"), F.min("user_id").alias("lowest"))
    return keyed.select("user_id", "profile"), cut(
        per_profile.withColumn("n", F.size("items").cast("bigint")))


def _load(prof: DataFrame) -> int:
    """Entries of the lists that all profiles file, each under all of its items, on two sides."""
    return 2 * (prof.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0)


def _matrix_width(prof: DataFrame, by_matrix: bool | None) -> int | None:
    """The items of the catalogue where pairs are to be counted by matrices; ``by_matrix`` overrides the estimate."""
    if by_matrix is None:
        return dense.width_if_cheaper(prof)
    return prof.select(F.explode("items.item")).distinct().count() if by_matrix else None


def _best_profiles(keep: int, id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel: the ``keep`` most similar other profiles of each probing profile in a bucket, none below its bar.

    The running best of the bucket raise the bars from piece to piece.
    """
    def run(postings: pa.Table, probes: pa.Table) -> pa.Table:
        out = {"lowest": pa.array([], id_type), "n": pa.array([], pa.int64()), "other": pa.array([], id_type),
               "other_n": pa.array([], pa.int64()), "shared": pa.array([], pa.int64())}
        if not postings.num_rows or not probes.num_rows:
            return pa.table(out)
        post, ask = inverted.both_sides(postings, probes, "lowest")
        bars = np.zeros(1 + max(post.ids.max(), ask.ids.max()))
        np.maximum.at(bars, ask.ids, ask.table.column("bar").to_numpy())
        sizes = post.n.astype(float)
        who = whom = shared = np.zeros(0, dtype=np.int64)

        def alive(probe: np.ndarray, posting: np.ndarray) -> np.ndarray:
            most = np.minimum(ask.left[probe], post.left[posting]).astype(float)
            return most * most >= bars[ask.ids[probe]] * sizes[posting] * ROOM

        for a, b, c in inverted.common(post, ask, alive):
            near = c * c >= bars[ask.ids[a]] * sizes[b] * ROOM
            who, whom, shared = (np.concatenate(x) for x in ((who, a[near]), (whom, b[near]), (shared, c[near])))
            close = (shared * shared) / sizes[whom]
            order = np.lexsort((post.ids[whom], -close, ask.ids[who]))
            mine = ask.ids[who][order]
            place = np.arange(len(mine)) - np.searchsorted(mine, mine)
            full = order[place == keep - 1]
            np.maximum.at(bars, ask.ids[who[full]], close[full])
            best = order[place < keep]
            who, whom, shared = who[best], whom[best], shared[best]
        ids = (ask.table.column("lowest").take(pa.array(who)), post.table.column("lowest").take(pa.array(whom)))
        return pa.table({"lowest": ids[0], "n": pa.array(ask.n[who]), "other": ids[1], "other_n": pa.array(post.n[whom]), "shared": pa.array(shared)})

    return run


def _closeness():
    return (F.col("shared") * F.col("shared")).cast("double") / F.col("other_n")


def _plain(prof: DataFrame) -> DataFrame:
    return prof.select("lowest", "members", F.transform("items", lambda e: e["item"]).alias("items"))


def _best_others(k: int, id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel: as ``_best_profiles``, on a tile of two chunks of profiles."""
    def run(probes: pa.Table, postings: pa.Table) -> pa.Table:
        if not postings.num_rows or not probes.num_rows:
            none = {c: pa.array([], id_type if c in ("lowest", "other") else pa.int64()) for c in ("lowest", "n", "other", "other_n", "shared")}
            return pa.table(none)
        both = dense.Sets(probes, postings, "lowest")
        who, whom, shared = dense.best_others(both, k)
        ids = (probes.column("lowest").take(pa.array(who)), postings.column("lowest").take(pa.array(whom)))
        return pa.table({"lowest": ids[0], "n": pa.array(both.n[who]), "other": ids[1], "other_n": pa.array(both.other_n[whom]), "shared": pa.array(shared)})

    return run


def near_profiles(prof: DataFrame, k: int, holders: int = inverted.HOLDERS, by_matrix: bool | None = None) -> DataFrame:
    """Rows (lowest, n, other, other_n, shared): for each profile, named by its lowest member, the ``k`` most similar others that share an item.

    First the profiles under a few rare items, in small sub-buckets, give every profile a bar: the k-th best it has met. Then all
    probe the full lists, above their bars only. Members of the profile itself are neighbours already and lower ``k`` for its bar.
    Over a narrow catalogue, or with ``by_matrix``, the pairs of all profiles are counted in tiles instead.
    """
    id_type = prof.schema["lowest"].dataType.simpleString()
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    schema = f"lowest {id_type}, n bigint, other {id_type}, other_n bigint, shared bigint"
    items = _matrix_width(prof, by_matrix)
    if items:
        lists = _plain(prof)
        return dense.meet(lists, lists.where(F.col("members") <= k), "lowest", items, _best_others(k, arrow_type), schema)
    load = _load(prof)
    lists = prof.select("lowest", "members", "items")
    best = _best_profiles(k, arrow_type)
    rare = inverted.places(lists, SEED_ITEMS)
    seeds = _seeds(rare, best, schema, load)
    # pairs are met once, so a profile has at most k a rare item; it needs fewer others the more members it has, and who has enough asks no one
    bars = seeds.groupBy(F.col("lowest").alias("_of")).agg(F.sort_array(F.collect_list(_closeness()), False).alias("_met"))
    asking = fresh(lists).where(F.col("members") <= k).join(bars, F.col("lowest") == F.col("_of"), "left").withColumn(
        "bar", F.coalesce(F.get("_met", (k - F.col("members")).cast("int")), F.lit(0.0))).drop("_of", "_met")
    # even a profile that consists of the remaining items only would be no closer than their number
    probes = inverted.places(asking).where(F.size("items") - F.col("place") >= F.col("bar") * ROOM)
    return inverted.meet(inverted.places(lists), probes, "lowest", best, schema, load, holders)


def _seeds(rare: DataFrame, best: Callable[[pa.Table, pa.Table], pa.Table], schema: str, load: int) -> DataFrame:
    """Profiles meet those of their own small sub-bucket only."""
    subs = F.greatest(F.ceil(F.col("holders") / SEED_HOLDERS), F.lit(1))
    apart = rare.withColumn("item", F.concat_ws("~", F.col("item").cast("string"), F.pmod(F.xxhash64("lowest"), subs).cast("string"))).withColumn(
        "holders", F.lit(1).cast("bigint"))
    return inverted.meet(apart, apart.withColumn("bar", F.lit(0.0)), "lowest", best, schema, load)


def neighbours(inter: DataFrame, k: int | None = 5, holders: int = inverted.HOLDERS, by_matrix: bool | None = None) -> DataFrame:
    """The ``k`` most similar users of each user that share at least one item; with ``None`` all of them (see ``partners``).

    Columns: user_id, neighbour, shared, similarity, rank. Exact: a user's k neighbours lie in its own profile and the k
    best others, each giving its k + 1 lowest members.
    """
    members, prof = profiles(inter)
    if k is None:
        items = _matrix_width(prof, by_matrix)
        return partners.by_matrix(members, prof, items) if items else partners.by_lists(members, prof, _load(prof), holders)
    others = near_profiles(prof, k, holders, by_matrix)
    twins = prof.where("members > 1").select("lowest", "n", F.col("lowest").alias("other"), F.col("n").alias("other_n"), F.col("n").alias("shared"))
    w = W.partitionBy("lowest").orderBy(_closeness().desc(), "other")
    best = others.unionByName(fresh(twins)).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= k + 1)

    names = fresh(prof.select("profile", "lowest"))
    low = W.partitionBy("profile").orderBy("user_id")
    few = (members.withColumn("_rn", F.row_number().over(low)).filter(F.col("_rn") <= k + 1)
           .groupBy("profile").agg(F.collect_list("user_id").alias("few")).join(names, "profile")
           .select(F.col("lowest").alias("other"), "few"))
    cand = best.join(few, "other").select(
        "lowest", "shared", (-_closeness()).alias("far"),
        (F.col("shared") / F.sqrt((F.col("n") * F.col("other_n")).cast("double"))).alias("similarity"),
        F.explode("few").alias("neighbour"))
    # At most (k + 1)^2 candidates per profile.
    lists = cand.groupBy("lowest").agg(F.sort_array(F.collect_list(
        F.struct("far", "neighbour", "shared", "similarity"))).alias("cand"))
    by_profile = lists.join(fresh(names), "lowest").select("profile", "cand")
    own = members.join(by_profile, "profile").select(
        "user_id", F.posexplode(F.slice(F.filter("cand", lambda c: c["neighbour"] != F.col("user_id")), 1, k)))
    return own.select("user_id", F.col("col.neighbour").alias("neighbour"), F.col("col.shared").alias("shared"),
                      F.col("col.similarity").alias("similarity"), (F.col("pos") + 1).cast("bigint").alias("rank"))


def _row_sums(id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel: for each probing profile, sums over the users of the other profiles it meets in a bucket."""

    def run(postings: pa.Table, probes: pa.Table) -> pa.Table:
        if not postings.num_rows or not probes.num_rows:
            none = {c: pa.array([], pa.int64()) for c in ("users", "shared")} | {c: pa.array([], pa.float64()) for c in ("sim", "low", "high")}
            return pa.table({"lowest": pa.array([], id_type)} | none)
        post, ask = inverted.both_sides(postings, probes, "lowest")
        weight = post.table.column("members").to_numpy()
        rows = len(ask.n)
        users, shared, sim, low, high = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows), np.full(rows, np.inf), np.zeros(rows)
        for a, b, c in inverted.common(post, ask, lambda probe, posting: np.ones(len(probe), dtype=bool)):
            each = c / np.sqrt((ask.n[a] * post.n[b]).astype(float))
            users += np.bincount(a, weights=weight[b], minlength=rows).astype(np.int64)
            shared += np.bincount(a, weights=c * weight[b], minlength=rows).astype(np.int64)
            sim += np.bincount(a, weights=each * weight[b], minlength=rows)
            np.minimum.at(low, a, each)
            np.maximum.at(high, a, each)
        met = np.flatnonzero(users)
        return pa.table({"lowest": ask.table.column("lowest").take(pa.array(met)), "users": pa.array(users[met]), "shared": pa.array(shared[met]),
                         "sim": pa.array(sim[met]), "low": pa.array(low[met]), "high": pa.array(high[met])})

    return run


def _row_sums_by_matrix(id_type: pa.DataType) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel: as ``_row_sums``, on a tile of two chunks of profiles."""

    def run(probes: pa.Table, postings: pa.Table) -> pa.Table:
        if not postings.num_rows or not probes.num_rows:
            none = {c: pa.array([], pa.int64()) for c in ("users", "shared")} | {c: pa.array([], pa.float64()) for c in ("sim", "low", "high")}
            return pa.table({"lowest": pa.array([], id_type)} | none)
        both = dense.Sets(probes, postings, "lowest")
        sums = dense.row_sums(both, postings.column("members").to_numpy())
        met = np.flatnonzero(sums[0])
        return pa.table({"lowest": probes.column("lowest").take(pa.array(met))}
                        | {c: pa.array(x[met]) for c, x in zip(("users", "shared", "sim", "low", "high"), sums, strict=True)})

    return run


def overlap_summary(inter: DataFrame, holders: int = inverted.HOLDERS, by_matrix: bool | None = None) -> DataFrame:
    """Row sums of the user-user matrix, self excluded, without emitting its entries.

    Columns: user_id, overlapping_users, shared_items, similarity_sum, and the lowest and
    highest similarity among users sharing an item (NULL if none does).
    """
    members, prof = profiles(inter)
    id_type = prof.schema["lowest"].dataType.simpleString()
    arrow_type = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[id_type]
    schema = f"lowest {id_type}, users bigint, shared bigint, sim double, low double, high double"
    width = _matrix_width(prof, by_matrix)
    if width:
        lists = _plain(prof)
        met = dense.meet(lists, lists, "lowest", width, _row_sums_by_matrix(arrow_type), schema)
    else:
        rows = inverted.places(prof.select("lowest", "members", "items"))
        met = inverted.meet(rows, rows, "lowest", _row_sums(arrow_type), schema, _load(prof), holders)
    sums = (met.groupBy("lowest")
            .agg(F.sum("users").alias("users"), F.sum("shared").alias("shared"), F.sum("sim").alias("sim"),
                 F.min("low").alias("low"), F.max("high").alias("high")))
    # the other members of a profile share all its items
    twins = F.col("members") - 1
    per_profile = fresh(prof.select("profile", "n", "members", "lowest")).join(fresh(sums).withColumnRenamed("lowest", "_of"), F.col("lowest") == F.col("_of"), "left")
    per_profile = per_profile.select(
        "profile", (F.coalesce("users", F.lit(0)) + twins).alias("overlapping_users"),
        (F.coalesce("shared", F.lit(0)) + twins * F.col("n")).alias("shared_items"), (F.coalesce("sim", F.lit(0.0)) + twins).alias("similarity_sum"),
        F.when(twins > 0, F.least(F.coalesce("low", F.lit(1.0)), F.lit(1.0))).otherwise(F.col("low")).alias("lowest_similarity"),
        F.when(twins > 0, F.lit(1.0)).otherwise(F.col("high")).alias("highest_similarity"))
    return members.join(per_profile, "profile").drop("profile")


def similarity_stats(inter: DataFrame, n_users: int | None = None) -> DataFrame:
    """Lowest and highest similarity between two users, and the number of users.

    ``n_users`` counts users without any interaction too; a pair sharing nothing has 0.
    """
    s = overlap_summary(inter)
    active = s.agg(F.count("*").alias("_active"), F.sum("overlapping_users").alias("_pairs"),
                   F.min("lowest_similarity").alias("_low"), F.max("highest_similarity").alias("_high"))
    total = F.lit(n_users).cast("bigint") if n_users is not None else F.col("_active")
    full = F.col("_pairs") == total * (total - 1)
    return active.select(total.alias("n_users"),
                         F.when(full, F.col("_low")).otherwise(F.lit(0.0)).alias("min_similarity"),
                         F.coalesce(F.col("_high"), F.lit(0.0)).alias("max_similarity"))


def engagement_rate(inter: DataFrame, n_users: int | None = None, n_items: int | None = None) -> DataFrame:
    """Share of filled cells of the user-item matrix."""
    by_user = inter.groupBy("user_id").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("pairs"), F.count("*").alias("n_users"))
    by_item = inter.select("item_id").distinct().agg(F.count("*").alias("n_items"))
    # Two one-row tables side by side.
    both = by_user.withColumn("_k", F.lit(0)).join(F.broadcast(by_item.withColumn("_k", F.lit(0))), "_k").drop("_k")
    users = F.lit(n_users) if n_users is not None else F.col("n_users")
    items = F.lit(n_items) if n_items is not None else F.col("n_items")
    return both.select("pairs", users.alias("n_users"), items.alias("n_items"),
                       (F.col("pairs") / (users * items)).alias("engagement_rate"))
