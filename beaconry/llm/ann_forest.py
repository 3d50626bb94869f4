"""Approximate nearest neighbours by a hash-prefix forest.

The base is dealt by a hash of vec_id into blocks of bounded size. In a block every tree gives each vector a long string of bits (signs
of random projections) and keeps the strings sorted. A query descends in every tree to the longest prefix that it shares with some
vector, and ascends in all trees together, one bit at a time, taking in the wider ranges until enough candidates are found. These are
ranked by their exact cosine. Queries are a stated set, compared with all blocks in chunks; the best of the blocks are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import prepare

TREES = 32
BITS = 32
BLOCK = 8192
CHUNK = 1024
SHARE = 0.45  # of a block that a query takes as candidates
SEED = 1729


def forest(vectors: np.ndarray, trees: int = TREES, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each tree the sorted bit strings and the order that sorts them."""
    out = []
    for keys in hashes(vectors, trees, seed):
        order = np.argsort(keys, kind="stable")
        out.append((keys[order], order))
    return out


def hashes(vectors: np.ndarray, trees: int, seed: int) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    planes = rng.standard_normal((trees, vectors.shape[1], BITS))
    return [np.packbits(vectors @ p > 0, axis=1).view(">u4").ravel().astype(np.int64) for p in planes]


def candidates(index: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, enough: int) -> np.ndarray:
    """Numbers of the vectors met by one query, whose bit strings are ``keys``, on the synchronous ascent."""
    size = len(index[0][0])
    met = np.zeros(size, dtype=bool)
    if enough >= size:
        return np.arange(size)
    # ranges of all trees at all depths at once
    depths = np.arange(BITS, -1, -1)
    low = (keys[:, None] >> (BITS - depths)) << (BITS - depths)
    high = low + (1 << (BITS - depths))
    spans = [(np.searchsorted(s, low[t]), np.searchsorted(s, high[t])) for t, (s, _) in enumerate(index)]
    wide = np.sum([b - a for a, b in spans], axis=0)
    for d in range(len(depths)):
        if wide[d] == 0:
            continue
        for (a, b), (_, order) in zip(spans, index, strict=True):
            if d and wide[d - 1]:
                met[order[a[d]:a[d - 1]]] = True
                met[order[b[d - 1]:b[d]]] = True
            else:
                met[order[a[d]:b[d]]] = True
        if np.count_nonzero(met) >= enough:
            break
    return np.flatnonzero(met)


def _search(k: int, trees: int, share: float):
    def run(base: pa.Table, asked: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if base.num_rows and asked.num_rows:
            ids, x = _matrix(base)
            queries, q = _matrix(asked)
            norms = np.sqrt((x * x).sum(axis=1))
            index = forest(x, trees)
            keys = np.stack(hashes(q, trees, SEED), axis=1)
            enough = max(4 * k, math.ceil(share * len(ids)))
            for i, query in enumerate(queries):
                some = candidates(index, keys[i], enough)
                some = some[ids[some] != query]
                score = (x[some] * q[i]).sum(axis=1) / (norms[some] * np.sqrt((q[i] * q[i]).sum()))
                best = np.lexsort((ids[some], -score))[:k]
                found["query_id"] += [query] * len(best)
                found["vec_id"] += ids[some][best].tolist()
                found["score"] += score[best].tolist()
        return pa.table({"query_id": pa.array(found["query_id"], pa.int64()), "vec_id": pa.array(found["vec_id"], pa.int64()),
                         "score": pa.array(found["score"], pa.float64())})

    return run


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, brought to a length of at most one so that no product overflows."""
    rows = table.column("embedding").combine_chunks()
    x = rows.flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
    largest = np.abs(x).max(axis=1, keepdims=True)
    ordinary = (largest > 1e-100) & (largest < 1e100)
    return table.column("vec_id").to_numpy(), np.where(ordinary, x, x / largest)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, trees: int = TREES, share: float = SHARE, block: int = BLOCK) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each query its ``k`` nearest found by cosine, ties to the smaller vec_id.

    Vectors that are null, empty, zero or hold null or non-finite components, and rows without id, take no part; vectors of another
    length than the query's are not its candidates. Equal rows count once; rows of the query's own id are no candidates. A query without
    candidates gives no rows. Other columns are ignored.
    """
    prepare(vectors.sparkSession)
    usable = (F.col("vec_id").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
              & F.exists("embedding", lambda v: v != 0))
    rows = vectors.where(usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.size("embedding").alias("dim")).dropDuplicates(["vec_id", "embedding"])
    count, asked = rows.agg(F.count("*"), F.count_if("asks")).first()
    blocks, chunks = max(1, math.ceil(count / block)), max(1, math.ceil(asked / CHUNK))
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    base = rows.select("vec_id", "embedding", "dim", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), every(chunks, "chunk"))
    queries = rows.where("asks").select("vec_id", "embedding", "dim", every(blocks, "block"),
                                        F.pmod(F.xxhash64("vec_id", F.lit("chunk")), F.lit(chunks)).cast("int").alias("chunk"))
    key = ["dim", "block", "chunk"]
    found = base.groupBy(*key).cogroup(queries.groupBy(*key)).applyInArrow(_search(k, trees, share), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
