"""Dot products of listed pairs of vectors.

A pair names a vector on either side. Joins would carry the first vector with every pair through the shuffle that finds the second; here
pairs and vectors meet in tiles of a chunk of either side, so a pair moves once, as keys, and a vector once per chunk of the other side.
Chunks come from hashes of the ids; a tile with too many pairs, as under a hot id, is dealt to several slices.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from beaconry.operators.tiles import chunk_count, chunk_of, co_run, cores_of, list_parts
from beaconry.session import cut

NUMBERS = 1 << 24  # vector entries of one chunk
PAIRS = 1 << 21  # pairs of one tile
PIECE = 1 << 17  # pairs looked up at once inside a task
CELLS = 1 << 20  # vector entries multiplied at once inside a task
NAMES = 1 << 20  # ids that are sent to all tasks at most


def named(vectors: DataFrame, pairs: DataFrame, key: str) -> DataFrame:
    """The vectors that some pair names under ``key``; up to ``NAMES`` names go to the vectors, beyond that both sides are shuffled."""
    names = cut(pairs.select(key).distinct())
    return vectors.join(F.broadcast(names) if names.count() <= NAMES else names, key, "left_semi")


def _finder(ids: np.ndarray) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """For keys: (place in the keys, place in ``ids``) of all that are equal, in the order of the keys."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]

    def find(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, stop = np.searchsorted(ids, keys), np.searchsorted(ids, keys, side="right")
        n = stop - start
        return np.repeat(np.arange(len(keys)), n), order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start, n)]

    return find


def _products(a: pa.ChunkedArray, b: pa.ChunkedArray, at: np.ndarray, bt: np.ndarray) -> np.ndarray:
    """Dot products, over the shorter length, of the lists ``at`` of ``a`` and ``bt`` of ``b``."""
    (a_off, a_val), (b_off, b_val) = list_parts(a), list_parts(b)
    length = np.minimum(np.diff(a_off)[at], np.diff(b_off)[bt])
    out = np.zeros(len(at))
    for n in np.unique(length[length > 0]):
        mine, theirs = (np.lib.stride_tricks.sliding_window_view(v, n) for v in (a_val, b_val))
        rows = np.flatnonzero(length == n)
        for piece in np.split(rows, np.arange(0, len(rows), max(1, CELLS // n))[1:]):
            x, y = mine[a_off[at[piece]]].astype(np.float64), theirs[b_off[bt[piece]]].astype(np.float64)
            out[piece] = np.einsum("ij,ij->i", x, y)
    return out


def _of_tile(left_id: str, right_id: str, schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Kernel: the pairs of a tile with the products of their vectors; an id that several vectors have gives a row for each."""

    def run(pairs: pa.Table, vectors: pa.Table) -> pa.Table:
        if not pairs.num_rows or not vectors.num_rows:
            return schema.empty_table()
        first = vectors.column("_first").to_numpy()
        left, right = vectors.filter(pa.array(first)), vectors.filter(pa.array(~first))
        find_left, find_right = (_finder(side.column("_id").to_numpy()) for side in (left, right))
        out = []
        for start in range(0, pairs.num_rows, PIECE):
            some = pairs.slice(start, PIECE)
            row, a = find_left(some.column(left_id).to_numpy())
            again, b = find_right(some.column(right_id).to_numpy()[row])
            row, a = row[again], a[again]
            norms = pc.multiply(left.column("norm").take(pa.array(a)), right.column("norm").take(pa.array(b)))
            kept = [some.column(c).take(pa.array(row)) for c in schema.names[:-2]]
            out.append(pa.table([*kept, pa.array(_products(left.column("embedding"), right.column("embedding"), a, b)), norms], schema=schema))
        return pa.concat_tables(out)

    return run


def _extent(vectors: DataFrame) -> tuple[int, int]:
    """Number of vectors and their greatest length."""
    rows, wide = vectors.agg(F.count("*"), F.max(F.size("embedding"))).first()  # one row
    return rows, max(1, wide or 1)


def dots(pairs: DataFrame, left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Columns of ``pairs``, ``product`` of the vectors under its ``left_id`` and ``right_id``, over the shorter length, and ``norms``.

    Either side has its id, ``embedding`` and ``norm``; ``norms`` is the product of both. As a join does, it leaves out pairs without vectors.
    """
    pairs, left, right = (df.dropna(subset=keys) for df, keys in ((pairs, [left_id, right_id]), (left, [left_id]), (right, [right_id])))
    (n_left, wide), (n_right, right_wide), n_pairs = _extent(left), _extent(right), pairs.count()
    across = chunk_count(n_right, max(1, NUMBERS // right_wide))
    down = max(chunk_count(n_left, max(1, NUMBERS // wide), cores_of(pairs)), math.ceil(n_pairs / PAIRS / across))
    placed = pairs.withColumn("_t", chunk_of(left_id, down) * across + chunk_of(right_id, across))
    # a tile is cut only where hot ids make it half as large again as it should be: at most one row per 1.5 PAIRS
    hot = cut(placed.groupBy("_t").agg(F.round(F.count("*") / PAIRS).cast("int").alias("_n")).where("_n > 1"))
    tiles = down * across + (hot.agg(F.sum(F.col("_n") - 1)).first()[0] or 0)
    # which slice a pair goes to is of no matter, but a repeated task must choose it again
    of_slice = F.pmod(F.xxhash64(*pairs.columns), F.col("_n")).cast("int")

    def sliced(df: DataFrame, place) -> DataFrame:
        return df.join(F.broadcast(hot), "_t", "left").withColumn("_n", F.coalesce("_n", F.lit(1))).withColumn("_s", place).drop("_n")

    def copies(df: DataFrame, key: str, first: bool) -> DataFrame:
        own, others = (down, across) if first else (across, down)
        other = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias("_o")
        df = df.select(F.lit(first).alias("_first"), F.col(key).alias("_id"), "embedding", "norm", chunk_of(key, own).alias("_c"), other)
        return df.withColumn("_t", F.col("_c") * across + F.col("_o") if first else F.col("_o") * across + F.col("_c")).drop("_c", "_o")

    vectors = copies(left, left_id, True).unionByName(copies(right, right_id, False))
    schema = T.StructType([*pairs.schema.fields, T.StructField("product", T.DoubleType()), T.StructField("norms", T.DoubleType())])
    # more tasks than tiles, so that hashing seldom puts two large tiles into one
    return co_run(sliced(placed, of_slice), sliced(vectors, F.explode(F.sequence(F.lit(0), F.col("_n") - 1))), ["_t", "_s"], 4 * tiles,
                  _of_tile(left_id, right_id, to_arrow_schema(schema)), schema)
