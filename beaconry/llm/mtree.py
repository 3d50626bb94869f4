"""Exact top-k inner products by best-first search in paged M-trees.

Inner products become distances by one more coordinate: with M the greatest length of a block's vectors, (x, sqrt(M^2 - |x|^2)) all lie on
a sphere and |q - x|^2 = |q|^2 + M^2 - 2 <q, x>, so the nearest objects are those of the greatest product. A block of the base is
bulk-loaded into one tree, stored as a table of pages: up to ``PAGE`` entries with their routing or leaf objects, covering radii, distances
to the page's own routing object, and child pages. Equal vectors are one object with many ids.

A query opens pages in the order of the best product they can hold. Before any product is computed, the stored distances rule entries out:
with d the query's distance to the page's routing object, an entry p at distance d(p, parent) with radius r is at least
|d - d(p, parent)| - r away. What is left is computed, and what cannot reach the k best is closed.

Every query first searches the block its own row lies in; its k-th product there is the bar that all other blocks start from.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import prepare, stored

SCALE = 1024
PAGE = 128  # entries
VALUES = 1 << 19  # components of the vectors in one block
QUERIES = 1 << 18  # components of the queries that meet a block at once
SLACK = 1e-6  # of the squared lengths, far beyond rounding: bounds only rule out what is worse for certain
EXACT = 1 << 53
LONG = (1 << 63) - 1
PAGES = ("dim int, block int, page int, leaf boolean, length double, objects array<long>, ids array<array<long>>, "
         "radii array<double>, to_parent array<double>, children array<int>")


def build(ids: np.ndarray, x: np.ndarray, page: int = PAGE) -> list[dict]:
    """Pages of a tree over the rows of ``x``; the first is the root's."""
    objects, where = np.unique(x, axis=0, return_inverse=True)
    where = where.ravel()
    order = np.lexsort((ids, where))
    owners = np.split(ids[order], np.cumsum(np.bincount(where))[:-1])
    points = objects.astype(float)
    squares = (points * points).sum(axis=1)
    length = squares.max(initial=0.0)
    points = np.c_[points, np.sqrt(np.maximum(length - squares, 0))]
    pages: list[dict] = []

    def distances(some: np.ndarray, to: int) -> np.ndarray:
        return np.sqrt(((points[some] - points[to]) ** 2).sum(axis=1))

    def grow(some: np.ndarray, parent: int | None) -> tuple[int, float]:
        """A page over ``some`` objects under the routing object ``parent``: its number, and how far its objects are from that."""
        number = len(pages)
        pages.append({})
        apart = distances(some, parent) if parent is not None else np.zeros(len(some))
        if len(some) <= page:
            pages[number] = {"page": number, "leaf": True, "length": length, "objects": objects[some].ravel(), "ids": [owners[i].tolist() for i in some],
                             "radii": np.zeros(len(some)), "to_parent": apart, "children": []}
            return number, float(apart.max(initial=0))
        seeds = np.random.default_rng(len(some)).choice(some, min(page, -(-len(some) // page) + 1), replace=False)
        # the nearest seed, by products: all lie on one sphere
        nearest = np.argmax(points[some] @ points[seeds].T, axis=1)
        nearest[np.searchsorted(some, seeds)] = np.arange(len(seeds))
        radii, children = np.zeros(len(seeds)), []
        for i, seed in enumerate(seeds):
            child, radii[i] = grow(some[nearest == i], seed)
            children.append(child)
        pages[number] = {"page": number, "leaf": False, "length": length, "objects": objects[seeds].ravel(), "ids": [],
                         "radii": radii, "to_parent": apart[np.searchsorted(some, seeds)], "children": children}
        return number, float(apart.max(initial=0))

    grow(np.arange(len(objects)), None)
    return pages


def _build(page: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        x = table.column("x").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        pages = build(table.column("vec_id").to_numpy(), x, page)
        types = {"page": pa.int32(), "leaf": pa.bool_(), "length": pa.float64(), "objects": pa.list_(pa.int64()), "ids": pa.list_(pa.list_(pa.int64())),
                 "radii": pa.list_(pa.float64()), "to_parent": pa.list_(pa.float64()), "children": pa.list_(pa.int32())}
        columns = {"dim": pa.array([key[0].as_py()] * len(pages), pa.int32()), "block": pa.array([key[1].as_py()] * len(pages), pa.int32())}
        return pa.table(columns | {c: pa.array([p[c] for p in pages], t) for c, t in types.items()})

    return run


def products(objects: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products; those beyond a long are cut to its limits."""
    a, b = (float(np.abs(v.astype(float)).max(initial=0)) for v in (objects, q))
    if a * b * len(q) < EXACT:
        return (objects.astype(float) @ q.astype(float)).astype(np.int64)
    exact = objects.astype(object) @ q.astype(object)
    return np.array([max(-LONG - 1, min(LONG, int(v))) for v in exact], dtype=np.int64)


class Tree:
    """The pages of one block, opened by a best-first search."""

    def __init__(self, table: pa.Table, dim: int):
        self.length = table.column("length")[0].as_py()
        self.pages, self.computed = {}, 0
        columns = [table.column(c).to_pylist() for c in ("page", "leaf", "ids", "children")]
        arrays = [table.column(c).combine_chunks() for c in ("objects", "radii", "to_parent")]
        for i, (page, leaf, ids, children) in enumerate(zip(*columns, strict=True)):
            objects, radii, to_parent = (a[i].values.to_numpy() for a in arrays)
            objects = objects.reshape(-1, dim)
            small = float(np.abs(objects.astype(float)).max(initial=0))
            # products of small integers are exact in doubles
            self.pages[page] = (leaf, objects, objects.astype(float), small, radii, to_parent, ids if leaf else children)

    def search(self, q: np.ndarray, k: int, bar: int | None = None) -> tuple[list[int], list[int]]:
        """Scores and ids of the ``k`` best, ties to the smaller id, of those that reach ``bar``."""
        real = q.astype(float)
        square = float(real @ real)
        slack = SLACK * (square + self.length)
        exact = float(np.abs(real).max(initial=0)) * len(q)
        scores, owners = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        least = -math.inf if bar is None else float(bar)
        heap = [(-math.inf, 0, None)]
        while heap:
            promise, number, apart = heapq.heappop(heap)
            if -promise < least - slack:
                break
            leaf, objects, floats, small, radii, to_parent, below = self.pages[number]
            live = slice(None)
            if apart is not None:
                away = np.maximum(np.abs(apart - to_parent) - radii, 0)
                live = np.flatnonzero((square + self.length - away * away) / 2 >= least - slack)
                if not len(live):
                    continue
            near = floats[live] @ real
            self.computed += len(near)
            if leaf:
                score = near.astype(np.int64) if small * exact < EXACT else products(objects[live], q)
                ids = np.arange(len(floats))[live]
                reach = np.flatnonzero(score >= least) if least > -math.inf else np.arange(len(score))
                if not len(reach):
                    continue
                some = [below[ids[i]][:k] for i in reach]  # sorted: further ids of one object come after k equal ones
                scores = np.concatenate([scores, np.repeat(score[reach], [len(s) for s in some])])
                owners = np.concatenate([owners, np.fromiter((v for s in some for v in s), np.int64)])
                best = np.lexsort((owners, ~scores))[:k]
                scores, owners = scores[best], owners[best]
                if len(scores) == k:
                    least = max(least, float(scores[-1]))
            else:
                apart_now = np.sqrt(np.maximum(square + self.length - 2 * near, 0))
                away = np.maximum(apart_now - radii[live], 0)
                promises = (square + self.length - away * away) / 2
                for p, child, d in zip(promises.tolist(), np.asarray(below)[live].tolist(), apart_now.tolist(), strict=True):
                    if p >= least - slack:
                        heapq.heappush(heap, (-p, child, d))
        return scores.tolist(), owners.tolist()


FOUND = "query_id long, x array<long>, vec_id long, score long, computed long"


def _search(k: int):
    def run(pages: pa.Table, asked: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if pages.num_rows and asked.num_rows:
            q = asked.column("x").combine_chunks().flatten().to_numpy().reshape(asked.num_rows, -1)
            tree = Tree(pages, q.shape[1])
            held: dict[int, int] = {}
            for ids in pages.column("ids").to_pylist():
                for own in ids:
                    for v in own:
                        held[v] = held.get(v, 0) + 1
            bars = asked.column("bar").to_pylist()
            ids = asked.column("query_id").to_pylist()
            distinct, where = np.unique(q, axis=0, return_inverse=True)
            for at, i in enumerate(distinct):
                askers = np.flatnonzero(where.ravel() == at)
                # the askers' own rows are left out below
                more = max(held.get(ids[a], 0) for a in askers)
                bar = None if any(bars[a] is None for a in askers) else min(bars[a] for a in askers)
                before = tree.computed
                scores, owners = tree.search(i, k + more, bar)
                for a in askers:
                    mine = [(s, o) for s, o in zip(scores, owners, strict=True) if o != ids[a]][:k]
                    rows += [(ids[a], i, o, s, tree.computed - before) for s, o in mine]
        return pa.table({"query_id": pa.array([r[0] for r in rows], pa.int64()), "x": pa.array([r[1] for r in rows], pa.list_(pa.int64())),
                         "vec_id": pa.array([r[2] for r in rows], pa.int64()), "score": pa.array([r[3] for r in rows], pa.int64()),
                         "computed": pa.array([r[4] for r in rows], pa.int64())})

    return run


def integers(vectors: DataFrame, is_query: Column, scale: int = SCALE, values: int = VALUES) -> DataFrame:
    """Rows (vec_id, x, dim, block, blocks, asks): each usable vector once, as integers, dealt to blocks of a bounded number of components."""
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = stored(vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: F.floor(scale * v.cast("double")).cast("long")).alias("x"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.size("embedding").alias("dim"))
        .groupBy("vec_id", "x", "dim").agg(F.max("asks").alias("asks")), "integers")
    blocks = rows.groupBy(F.col("dim").alias("of")).agg(
        F.ceil(F.count("*") * F.col("dim") / values).cast("int").alias("blocks"),
        F.ceil(F.count_if("asks") * F.col("dim") / QUERIES).cast("int").alias("chunks"))
    place = lambda salt, n: F.pmod(F.xxhash64("vec_id", "x", F.lit(salt)), n).cast("int")
    return (rows.join(blocks, F.col("dim") == F.col("of")).drop("of")
            .withColumn("block", place("block", F.col("blocks"))).withColumn("chunk", place("chunk", F.greatest("chunks", F.lit(1)))))


def index(rows: DataFrame, page: int = PAGE) -> DataFrame:
    """The pages of the trees of all blocks, as a stored table."""
    return stored(rows.select("dim", "block", "vec_id", "x").groupBy("dim", "block").applyInArrow(_build(page), PAGES), "pages")


def largest_products(vectors: DataFrame, is_query: Column, k: int = 10, scale: int = SCALE, page: int = PAGE, values: int = VALUES) -> DataFrame:
    """Rows (query_id, rank, vec_id, score, computed): for each query the ``k`` rows of the greatest inner product of floor(scale * entry).

    Ties go to the smaller vec_id; ``computed`` is the number of products that the row's block took to find it. Vectors that are null, empty
    or hold null or non-finite components, and rows without id, take no part; vectors of another length than the query's are not its
    candidates. Equal rows count once; rows of the query's own id are no candidates, and an id with several vectors asks with each and
    keeps the best. Integers and products beyond a long are cut to its limits. A query without candidates gives no rows; other columns are ignored.
    """
    prepare(vectors.sparkSession)
    rows = integers(vectors, is_query, scale, values)
    pages = index(rows, page)
    queries = rows.where("asks").select(F.col("vec_id").alias("query_id"), "x", "dim", "block", "blocks", "chunk", "chunks")
    asked = queries.select("query_id", "x", "dim", "block", F.lit(None).cast("long").alias("bar"))
    home = stored(pages.groupBy("dim", "block").cogroup(asked.groupBy("dim", "block")).applyInArrow(_search(k), FOUND), "home")
    ranked = home.withColumn("place", F.row_number().over(Window.partitionBy("query_id", "x").orderBy(F.desc("score"), "vec_id")))
    bars = ranked.where(F.col("place") == k).select("query_id", "x", F.col("score").alias("bar"))
    elsewhere = (queries.join(bars, ["query_id", "x"], "left").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .where("other <> block").select("query_id", "x", "dim", F.col("other").alias("block"), "chunk", "bar"))
    meets = rows.where("asks").groupBy("dim").agg(F.max("chunks").alias("chunks"))
    spread = pages.join(meets, "dim").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    key = ["dim", "block", "chunk"]
    away = spread.groupBy(*key).cogroup(elsewhere.groupBy(*key)).applyInArrow(_search(k), FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id", "computed")
    return (home.unionByName(away).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score", "computed"))
