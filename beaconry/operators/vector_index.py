"""A stored vector index: trained cells, members filed by cell, and a search of several cells per query.

Centroids are trained on a bounded sample of the campaigns' unit vectors; every campaign is filed under its nearest
centroid. The index is a folder with two tables, ``centroids`` and ``members``, and outlives the session that built it.
A query opens the cells whose centroids are nearest; how many is chosen when the index is built, from a bounded sample of users
whose exact answers are known. Users that end up with fewer campaigns than there are get the exact answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions import vectors as V
from beaconry.operators import campaigns as K
from beaconry.operators import tiles
from beaconry.session import cut

SAMPLE = 65_536  # campaigns that centroids are trained on, at most about so many
MOST_CELLS = 1024
ROUNDS = 10
ASKED = 512  # users that the number of opened cells is chosen by, at most about so many
RECALL = 0.95
SEED = 7


def _bounded(df: DataFrame, key: str, rows: int, most: int) -> DataFrame:
    """About ``most`` rows by a hash of the key, all of them where there are fewer."""
    return df.where(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int((1 << 20) * min(1.0, most / max(rows, 1))))


def unit_rows(x: np.ndarray) -> np.ndarray:
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def train(x: np.ndarray, cells: int, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Spherical k-means: ``cells`` unit centroids of the unit rows ``x``; an emptied cell takes the row worst placed."""
    centroids = x[np.random.default_rng(seed).choice(len(x), cells, replace=False)]
    for _ in range(rounds):
        score = x @ centroids.T
        own = score.argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        far = iter(np.argsort(score[np.arange(len(x)), own], kind="stable"))
        for c in np.flatnonzero(np.bincount(own, minlength=cells) == 0):
            sums[c] = x[next(far)]
        centroids = unit_rows(sums)
    return centroids


def _nearest_cells(centroids: np.ndarray, probes: int, rest: list[str]):
    """Rows with an embedding, once for each of the ``probes`` cells nearest to its first block."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, _ = tiles.vectors_of(b.column("embedding"), dim)
            near = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :probes]
            rows = pa.array(np.repeat(np.arange(b.num_rows), near.shape[1]))
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(rows) for c in rest), pa.array(near.ravel().astype(np.int32)),
                                              pa.array(np.tile(np.arange(near.shape[1], dtype=np.int32), b.num_rows))], names=[*rest, "cell", "place"])

    return run


def _celled(df: DataFrame, centroids: np.ndarray, probes: int, key: str) -> DataFrame:
    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "embedding").mapInArrow(_nearest_cells(centroids, probes, [key, "embedding"]),
                                                  f"{key} {kind}, embedding array<double>, cell int, place int")


def usable(df: DataFrame, key: str, dim: int) -> DataFrame:
    """Rows whose first block has a direction; what lies beyond the block is folded into one entry."""
    slim = K.with_vector(df, [key]).withColumn("embedding", K.first_block("embedding", dim))
    return slim.where(V.is_nonzero(F.slice("embedding", 1, dim)))


def build_index(campaigns: DataFrame, users: DataFrame, path: str, dim: int, k: int = 10, recall: float = RECALL) -> None:
    """Store an index of ``campaigns`` at ``path``; ``users`` stand for those that will ask."""
    spark = campaigns.sparkSession
    c = usable(campaigns, "campaign_id", dim)
    count = c.count()
    sample = _bounded(c, "campaign_id", count, SAMPLE).select("embedding").toArrow()  # bounded
    x = unit_rows(tiles.vectors_of(sample.column("embedding"), dim)[0])
    cells = max(1, min(MOST_CELLS, len(x), round(math.sqrt(count))))
    centroids = train(x, cells) if len(x) else np.zeros((0, dim))
    members = _celled(c, centroids, 1, "campaign_id").drop("place") if len(x) else c.withColumn("cell", F.lit(0))
    members.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/members")
    asked = _bounded(usable(users, "user_id", dim), "user_id", users.count(), ASKED)
    probes = _probes(asked, campaigns, spark.read.parquet(f"{path}/members") if len(x) else members, centroids, k, recall) if len(x) else 0
    rows = [(i, v.tolist(), probes, count) for i, v in enumerate(centroids)]
    spark.createDataFrame(rows, "cell int, centroid array<double>, probes int, members long").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")


def _probes(asked: DataFrame, campaigns: DataFrame, members: DataFrame, centroids: np.ndarray, k: int, recall: float) -> int:
    """The least number of cells that holds the share ``recall`` of the exact answers of a bounded set of users."""
    asked = cut(asked)
    exact = K.campaign_topk(asked, campaigns, k).join(members.select("campaign_id", F.col("cell").alias("of")), "campaign_id")
    every = _celled(asked, centroids, len(centroids), "user_id").select("user_id", "cell", "place")
    places = exact.join(every, (exact["user_id"] == every["user_id"]) & (F.col("of") == F.col("cell"))).groupBy("place").count().collect()
    at = np.zeros(len(centroids), dtype=np.int64)
    for r in places:  # one row a place
        at[r["place"]] = r["count"]
    return int(np.searchsorted(np.cumsum(at), recall * at.sum()) + 1) if at.sum() else len(centroids)


def read_centroids(spark: SparkSession, path: str) -> tuple[np.ndarray, int, int]:
    """Centroids (at most ``MOST_CELLS``), the number of cells to open and the number of members."""
    rows = spark.read.parquet(f"{path}/centroids").orderBy("cell").collect()
    return (np.array([r["centroid"] for r in rows]), rows[0]["probes"], rows[0]["members"]) if rows else (np.zeros((0, 0)), 0, 0)


def topped_up(found: DataFrame, users: DataFrame, campaigns: DataFrame, k: int, extra: Column) -> DataFrame:
    """``found`` (user_id, campaign_id, similarity_score, rank, one more column), with the exact answer for users that have fewer rows than they could.

    Also users whose vector has no direction are ranked so, as ``campaign_topk`` ranks them; ``extra`` fills the last column of such rows.
    """
    found = cut(found)
    whole = K.with_vector(campaigns, ["campaign_id"]).count()
    got = found.groupBy("user_id").agg(F.count("*").alias("_got")).withColumnRenamed("user_id", "_of")
    # ids decide who is short; vectors are read for those only
    short = cut(K.with_vector(users, ["user_id"]).select("user_id").join(got, F.col("user_id") == F.col("_of"), "left").where(
        F.coalesce("_got", F.lit(0)) < min(k, whole)).select(F.col("user_id").alias("_of")).distinct())
    n_short = short.count()
    if not n_short:
        return found
    who = F.broadcast(short) if n_short <= K.LOCAL_ROWS else short
    exact = K.campaign_topk(users.join(who, F.col("user_id").eqNullSafe(F.col("_of")), "left_semi"), campaigns, k).withColumn(found.columns[-1], extra)
    kept = found.join(who, F.col("user_id") == F.col("_of"), "left_anti")
    return kept.unionByName(exact.select(*found.columns))


def _opened(centroids: np.ndarray, probes: int, members: pa.Table, k: int):
    """The best members of the cells that a user opens, found where the user's row lies; ``candidates`` goes with the row's best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered = members.sort_by("campaign_id")
        cell = ordered.column("cell").to_numpy()
        cells = [(c, np.flatnonzero(cell == c)) for c in np.unique(cell)]
        whole = K._Block(ordered)
        blocks = [K._Block(ordered.take(pa.array(own))) for _, own in cells]
        for b in batches:
            x, _ = tiles.vectors_of(b.column("embedding"), centroids.shape[1])
            near = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :probes]
            for s, e in tiles.row_batches(b.num_rows, ordered.num_rows):
                score = np.full((e - s, ordered.num_rows), -np.inf)
                candidates = np.zeros(e - s, dtype=np.int64)
                for (c, own), block in zip(cells, blocks, strict=True):
                    asks = np.flatnonzero((near[s:e] == c).any(axis=1))
                    candidates[asks] += len(own)
                    for i, j, part in block.scores(b.column("embedding").take(pa.array(asks + s))):
                        part[np.isnan(part).any(axis=1)] = -np.inf  # as in a tile, where such a row has no best either
                        score[asks[i:j, None], own] = part
                rows, cols, place = tiles.best_columns(score.copy(), k)
                t = whole.picked(b.column("user_id"), rows + s, cols, score[rows, cols], place, "user_id").drop_columns(["rank"])
                yield from t.append_column("candidates", pa.array(np.where(place == 1, candidates[rows], 0))).to_batches()

    return run


def search(users: DataFrame, campaigns: DataFrame, path: str, dim: int, k: int = 10, probes: int | None = None) -> DataFrame:
    """Approximate ``campaign_topk`` from the index at ``path``: user_id, campaign_id, similarity_score, rank, candidates.

    Every user with a vector has min(k, campaigns with a vector) rows. ``candidates`` is the number of campaigns scored for the user;
    scores are exact cosines.
    """
    centroids, stored_probes, count = read_centroids(users.sparkSession, path)
    user_type = users.schema["user_id"].dataType.simpleString()
    schema = f"user_id {user_type}, campaign_id string, similarity_score double, scored bigint"
    if not len(centroids):
        return K.campaign_topk(users, campaigns, k).withColumn("candidates", F.lit(count).cast("bigint"))
    u = usable(users, "user_id", dim).where(F.col("user_id").isNotNull())
    probes = min(probes or stored_probes, len(centroids))
    members = users.sparkSession.read.parquet(f"{path}/members").select("campaign_id", "embedding", "cell")
    some = K._Side(members).local
    if some is not None:  # within the bounds of a campaign side no vector moves
        found = u.mapInArrow(_opened(centroids, probes, some, k), f"user_id {user_type}, campaign_id string, similarity_score double, candidates bigint")
        of_user = F.sum("candidates").over(W.partitionBy("user_id"))
        ranked = K._final_rank(found.withColumn("candidates", of_user), k).select("user_id", "campaign_id", "similarity_score", "rank", "candidates")
        return topped_up(ranked, users, campaigns, k, F.lit(count).cast("bigint"))
    asked = cut(_celled(u, centroids, probes, "user_id").drop("place"))
    empty = users.sparkSession.createDataFrame([], schema).toArrow()
    best = K._best("user_id", k)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        t = pa.concat_tables(list(best(K._Block(right), left))).drop_columns(["rank"])
        return t.append_column("scored", pa.array(np.full(t.num_rows, right.num_rows, dtype=np.int64)))

    found = tiles.cell_tiles(asked, members, ["cell"], "user_id", "campaign_id", K.USERS_PER_CHUNK, K.CAMPAIGNS_PER_CHUNK, tile, schema)
    sizes = members.groupBy("cell").agg(F.count("*").alias("_size"))
    opened = asked.join(sizes, "cell").groupBy(F.col("user_id").alias("_of")).agg(F.sum("_size").alias("candidates"))
    ranked = K._final_rank(found.select("user_id", "campaign_id", "similarity_score"), k)
    ranked = ranked.join(opened, F.col("user_id") == F.col("_of")).select("user_id", "campaign_id", "similarity_score", "rank", "candidates")
    return topped_up(ranked, users, campaigns, k, F.lit(count).cast("bigint"))
