"""Pairing two large sides in bounded tiles.

Some results need every left row to meet every right row: nearest vectors, or users
sharing items. Instead of a join that emits the pairs, both sides are cut into hashed
chunks of bounded size, each chunk pair ("tile") is scored inside one task, and only a
few rows per left row leave it. Chunks come from a hash of the row id, so no popular
item, bucket or user can swell a tile, and nothing is dropped.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 22  # score matrix entries held at once inside a task
SMALL_CHUNK = 2048
MAX_TASKS = 50_000


def chunk_count(rows: int, per_chunk: int, cores: int = 1) -> int:
    """Chunks of at most ``per_chunk`` rows; smaller ones, down to ``SMALL_CHUNK``, while cores would idle."""
    enough = min(math.ceil(rows / SMALL_CHUNK), math.ceil(math.sqrt(6 * cores))) if cores > 1 else 1
    return max(1, math.ceil(rows / per_chunk), enough)


def cores_of(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def chunk_of(id_col: str, chunks) -> Column:
    """Chunk of a row; ``chunks`` may be a number or a column."""
    return F.pmod(F.xxhash64(id_col), chunks if isinstance(chunks, Column) else F.lit(chunks)).cast("int")


def list_parts(col: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and flat values of an Arrow list column."""
    arr = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    if isinstance(arr, pa.ChunkedArray):
        arr = pa.concat_arrays(arr.chunks) if arr.num_chunks else pa.array([], type=arr.type)
    offsets = arr.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = arr.values.to_numpy(zero_copy_only=False)
    return offsets, values


def vectors_of(col, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Matrix of list rows cut or zero-padded to ``width``, and each full row's length (norm)."""
    off, vals = list_parts(col)
    vals = vals.astype(np.float64)
    size = np.diff(off)
    n = len(size)
    rows = np.repeat(np.arange(n), size)
    span = vals[off[0]:off[-1]] if n else vals[:0]
    norms = np.sqrt(np.bincount(rows, weights=span * span, minlength=n)) if n else np.zeros(0)
    width = int(size.max(initial=0)) if width is None else width
    if n and (size == size[0]).all() and size[0] >= width:
        return span.reshape(n, size[0])[:, :width], norms
    out = np.zeros((n, width))
    at = np.arange(len(rows)) - np.repeat(off[:-1] - off[0], size) if n else rows
    keep = at < width
    out[rows[keep], at[keep]] = span[keep]
    return out, norms


def row_batches(rows: int, cols: int) -> Iterator[tuple[int, int]]:
    step = max(1, CELLS // max(cols, 1))
    for s in range(0, rows, step):
        yield s, min(rows, s + step)


def best_columns(score: np.ndarray, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, place) of the ``k`` best entries of each row above ``floor``.

    Equal scores go to the lower column. ``score`` is overwritten.
    """
    rows, cols, places = [], [], []
    every = np.arange(score.shape[0])
    for place in range(min(k, score.shape[1])):
        best = score.argmax(axis=1)
        hit = score[every, best] > floor
        if not hit.any():
            break
        rows.append(every[hit])
        cols.append(best[hit])
        places.append(np.full(int(hit.sum()), place + 1))
        score[every, best] = -np.inf
    if not rows:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(places)


class RunningBest:
    """The ``k`` best rows of each column over row batches that come in row order.

    Equal scores go to the lower row; only scores above 0 count.
    """

    def __init__(self, cols: int, k: int):
        self.k = k
        self.score = np.full((cols, k), -np.inf)
        self.row = np.zeros((cols, k), dtype=np.int64)
        self.extra = np.zeros((cols, k), dtype=np.int64)

    def add(self, score: np.ndarray, extra: np.ndarray, start: int) -> None:
        """``score`` and ``extra`` hold one row per left row; ``start`` is the number of the first."""
        flipped = np.ascontiguousarray(score.T)
        cols, rows, place = best_columns(flipped, self.k, 0.0)
        new = [np.full_like(self.score, -np.inf), np.zeros_like(self.row), np.zeros_like(self.extra)]
        new[0][cols, place - 1] = score[rows, cols]
        new[1][cols, place - 1] = rows + start
        new[2][cols, place - 1] = extra[rows, cols]
        both = np.concatenate([self.score, new[0]], axis=1)
        order = np.argsort(-both, axis=1, kind="stable")[:, :self.k]
        self.score = np.take_along_axis(both, order, axis=1)
        self.row = np.take_along_axis(np.concatenate([self.row, new[1]], axis=1), order, axis=1)
        self.extra = np.take_along_axis(np.concatenate([self.extra, new[2]], axis=1), order, axis=1)

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(column, row, extra) of what was kept."""
        cols, place = np.nonzero(self.score > 0)
        return cols, self.row[cols, place], self.extra[cols, place]


def shared_counts(left, right) -> Iterator[tuple[int, int, np.ndarray]]:
    """Numbers of common items for row batches of two list columns: (start, stop, matrix)."""
    l_off, l_val = list_parts(left)
    r_off, r_val = list_parts(right)
    n_left, n_right = len(l_off) - 1, len(r_off) - 1
    if n_left <= 0 or n_right <= 0:
        return
    l_val, r_val = l_val[l_off[0]:l_off[-1]], r_val[r_off[0]:r_off[-1]]
    l_off, r_off = l_off - l_off[0], r_off - r_off[0]
    known, codes = np.unique(np.concatenate([l_val, r_val]), return_inverse=True)
    l_code, r_code = codes[:len(l_val)], codes[len(l_val):]
    order = np.argsort(r_code, kind="stable")
    holder = np.repeat(np.arange(n_right), np.diff(r_off))[order]
    start = np.searchsorted(r_code[order], np.arange(len(known) + 1))
    pop = np.diff(start)
    l_row = np.repeat(np.arange(n_left), np.diff(l_off))
    for s, e in row_batches(n_left, n_right):
        counts = np.zeros((e - s) * n_right, dtype=np.int64)
        a, z = l_off[s], l_off[e]
        meets = pop[l_code[a:z]]
        piece = np.cumsum(meets) // CELLS  # entries of one piece meet about CELLS rows
        for p in np.unique(piece):
            sel = np.flatnonzero(piece == p) + a
            m = pop[l_code[sel]]
            if not m.sum():
                continue
            at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m) + np.repeat(start[l_code[sel]], m)
            cell = np.repeat(l_row[sel] - s, m) * n_right + holder[at]
            counts += np.bincount(cell, minlength=len(counts))
        yield s, e, counts.reshape(e - s, n_right)


def fresh(df: DataFrame) -> DataFrame:
    """The same columns under new ids, so that both sides of a co-group may share a source."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def co_run(a: DataFrame, b: DataFrame, keys: Sequence[str], tiles: int | None, fn, schema: str) -> DataFrame:
    """Co-group both sides by tile. With a known number of tiles each gets its own task,
    whatever the session's shuffle partitions are."""
    keys = list(keys)
    a, b = fresh(a), fresh(b)
    if tiles is not None:
        a, b = (df.repartition(min(tiles, MAX_TASKS), *keys) for df in (a, b))
    return a.groupBy(*keys).cogroup(b.groupBy(*keys)).applyInArrow(fn, schema)


def pair_tiles(left: DataFrame, right: DataFrame, left_id: str, right_id: str, left_chunks: int,
               right_chunks: int, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Run ``fn`` on every (left chunk, right chunk); each side is copied once per chunk of the other."""
    a = (left.withColumn("_l", chunk_of(left_id, left_chunks))
         .withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(right_chunks - 1)))))
    b = (right.withColumn("_r", chunk_of(right_id, right_chunks))
         .withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(left_chunks - 1)))))
    return co_run(a, b, ["_l", "_r"], left_chunks * right_chunks, fn, schema)


def self_tiles(df: DataFrame, id_col: str, chunks: int,
               fn: Callable[[bool, pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """Run ``fn(is_diagonal, left, right)`` on every unordered pair of chunks of one side.

    Tile (i, j) with i <= j; ``fn`` answers for both directions off the diagonal.
    """
    placed = df.withColumn("_c", chunk_of(id_col, chunks))
    a = placed.withColumn("_r", F.explode(F.sequence(F.col("_c"), F.lit(chunks - 1)))).withColumnRenamed("_c", "_l")
    b = placed.withColumn("_l", F.explode(F.sequence(F.lit(0), F.col("_c")))).withColumnRenamed("_c", "_r")

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(key[0].as_py() == key[1].as_py(), left, right)

    return co_run(a, b, ["_l", "_r"], chunks * (chunks + 1) // 2, run, schema)


def cell_tiles(left: DataFrame, right: DataFrame, cell: Sequence[str], left_id: str, right_id: str,
               left_rows: int, right_rows: int, fn: Callable[[pa.Table, pa.Table], pa.Table],
               schema: str) -> DataFrame:
    """As ``pair_tiles``, only between rows of the same cell; large cells get several chunks."""
    cell = list(cell)
    nl = left.groupBy(*cell).agg(F.ceil(F.count("*") / left_rows).cast("int").alias("_nl"))
    nr = right.groupBy(*cell).agg(F.ceil(F.count("*") / right_rows).cast("int").alias("_nr"))
    sizes = nl.join(nr, cell)
    a = (left.join(sizes, cell).withColumn("_l", chunk_of(left_id, F.col("_nl")))
         .withColumn("_r", F.explode(F.sequence(F.lit(0), F.col("_nr") - 1))).drop("_nl", "_nr"))
    b = (right.join(sizes, cell).withColumn("_r", chunk_of(right_id, F.col("_nr")))
         .withColumn("_l", F.explode(F.sequence(F.lit(0), F.col("_nl") - 1))).drop("_nl", "_nr"))
    return co_run(a, b, [*cell, "_l", "_r"], None, fn, schema)
