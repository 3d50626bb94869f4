"""Similarity join of item sets over a narrow catalogue, by products of 0/1 matrices.

Where a catalogue is narrow beside the lists, most lists share several items and inverted lists (see ``inverted``) meet the same
pair under each of them, with nothing to skip. Here two chunks of lists become matrices of lists x items, their product counts the
common items of all pairs of the tile at once, and only the best few or the sums of a list leave the task. Chunks come from a hash
of the list's id and hold a bounded number of matrix entries, so no popular item can swell a tile. All pairs are looked at: the
work grows with the square of the lists, the memory of a task does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.operators import tiles
from beaconry.operators.inverted import numbered

MOST_ITEMS = 4096  # a wider catalogue is left to inverted lists
ENTRIES = 1 << 24  # matrix entries of one chunk
LISTS_PER_CHUNK = 32_768
CELLS = 1 << 20  # pairs counted at once inside a task
COLUMNS = 2048
# Measured nanoseconds: a pair met under one item; a pair of two chunks, and what each item of the catalogue adds to it.
MEET_NS, PAIR_NS, ITEM_NS = 60.0, 4.0, 0.1


def width_if_cheaper(prof: DataFrame) -> int | None:
    """The number of items where all pairs by matrices cost less than the meetings under all items, else None."""
    held = prof.select(F.explode("items.item").alias("item")).groupBy("item").agg(F.count("*").alias("h"))
    meets = held.agg(F.count("*").alias("items"), F.sum(F.col("h").cast("double") * F.col("h")).alias("meets")).first()  # one row
    items = meets["items"]
    if not 0 < items <= MOST_ITEMS:
        return None
    lists = float(prof.count())
    return items if lists * lists * (PAIR_NS + ITEM_NS * items) < MEET_NS * meets["meets"] else None


def meet(postings: DataFrame, probes: DataFrame, key: str, items: int, fn, schema: str) -> DataFrame:
    """Run ``fn(probes, postings)`` on every pair of chunks; both sides have a column ``items``."""
    chunks = tiles.chunk_count(postings.count(), max(1, min(LISTS_PER_CHUNK, ENTRIES // items)), tiles.cores_of(postings))
    return tiles.pair_tiles(probes, postings, key, key, chunks, chunks, fn, schema)


class Sets:
    """Two sides of a tile as matrices of 0 and 1 over the items of both."""

    def __init__(self, probes: pa.Table, postings: pa.Table, key: str):
        self.ids, self.other_ids = numbered(probes.column(key), postings.column(key))
        parts = [tiles.list_parts(t.column("items")) for t in (probes, postings)]
        parts = [(off - off[0], values[off[0]:off[-1]]) for off, values in parts]
        known, codes = np.unique(np.concatenate([v for _, v in parts]), return_inverse=True)
        cut = len(parts[0][1])
        self.mine, self.n = self._matrix(parts[0][0], codes[:cut], len(known))
        self.others, self.other_n = self._matrix(parts[1][0], codes[cut:], len(known))
        order = np.argsort(self.other_ids, kind="stable")
        at = np.minimum(np.searchsorted(self.other_ids[order], self.ids), len(order) - 1)
        #: each probe's own column, -1 where it is in another tile
        self.own = np.where(self.other_ids[order[at]] == self.ids, order[at], -1)

    @staticmethod
    def _matrix(offsets: np.ndarray, codes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        n = np.diff(offsets)
        out = np.zeros((len(n), width), dtype=np.float32)
        out[np.repeat(np.arange(len(n)), n), codes] = 1
        return out, n

    def without_own(self, block: np.ndarray, s: int, columns: tuple[int, int], value: float, place: np.ndarray | None = None) -> None:
        """Put ``value`` where a probe of the rows from ``s`` meets itself; ``place`` gives the columns in another order."""
        own = self.own[s:s + len(block)]
        at = np.where(own >= 0, own if place is None else place[own], -1)
        row = np.flatnonzero((at >= columns[0]) & (at < columns[1]))
        block[row, at[row] - columns[0]] = value


def _spans(size: int, step: int) -> Iterator[tuple[int, int]]:
    for s in range(0, size, step):
        yield s, min(s + step, size)


def best_others(both: Sets, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probe, posting, shared items) of the ``k`` most similar others of each probe, by shared^2 / size, then id.

    Products in single precision over columns scaled by 1 / sqrt(size) only pick who comes into question, with room for their
    rounding; shared items are then counted exactly.
    """
    scale = 1 / np.sqrt(np.maximum(both.other_n, 1))
    scaled = np.ascontiguousarray((both.others * scale[:, None].astype(np.float32)).T)
    room = 1 - (both.mine.shape[1] + 8) * 1.2e-7
    least = 0.5 * float(scale.min(initial=1.0))  # below the score of one shared item
    found = []
    for s, e in _spans(len(both.n), max(1, CELLS // COLUMNS)):
        bar = np.full(e - s, least, dtype=np.float32)
        who = whom = shared = np.zeros(0, dtype=np.int64)
        for c, d in _spans(len(both.other_n), COLUMNS):
            score = both.mine[s:e] @ scaled[:, c:d]
            both.without_own(score, s, (c, d), -1.0)
            if c == 0 and d > k:  # the first columns alone give a bar
                bar = np.maximum(bar, np.partition(score, d - k, axis=1)[:, d - k] * np.float32(room))
            row, col = np.divmod(np.flatnonzero(score >= bar[:, None]), d - c)
            if not len(row):
                continue
            common = np.concatenate([np.einsum("ij,ij->i", both.mine[s + row[i:j]], both.others[c + col[i:j]])
                                     for i, j in _spans(len(row), max(1, CELLS // both.mine.shape[1]))])
            who, whom, shared = (np.concatenate(x) for x in ((who, row), (whom, col + c), (shared, np.rint(common).astype(np.int64))))
            close = (shared * shared) / both.other_n[whom]
            order = np.lexsort((both.other_ids[whom], -close, who))
            mine = who[order]
            place = np.arange(len(mine)) - np.searchsorted(mine, mine)
            full = order[place == k - 1]
            bar[who[full]] = np.maximum(bar[who[full]], (np.sqrt(close[full]) * room).astype(np.float32))
            best = order[place < k]
            who, whom, shared = who[best], whom[best], shared[best]
        found.append((who + s, whom, shared))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def row_sums(both: Sets, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per probe over the others that share an item: weight, shared items x weight, similarity x weight, least and highest similarity."""
    rows = len(both.n)
    own = both.own >= 0
    mine = both.mine.astype(np.float64)
    own_weight = np.where(own, weight[np.maximum(both.own, 0)], 0)
    # sums over all columns are those of the products with one summed column, less what a probe shares with itself
    shared = np.rint(mine @ (weight @ both.others.astype(np.float64))).astype(np.int64) - own_weight * both.n
    sim = (mine @ ((weight / np.sqrt(np.maximum(both.other_n, 1))) @ both.others.astype(np.float64))) / np.sqrt(np.maximum(both.n, 1)) - own_weight
    users, low, high = np.full(rows, weight.sum()), np.full(rows, np.inf), np.zeros(rows)
    # lists of one size stand together: among them the similarity goes by the shared items alone
    order = np.argsort(both.other_n, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    size, heavy = both.other_n[order], weight[order]
    sides = np.concatenate([[0], np.flatnonzero(np.diff(size)) + 1, [len(size)]])
    for a, z in zip(sides[:-1], sides[1:], strict=True):
        for c, d in ((a + i, a + j) for i, j in _spans(z - a, COLUMNS)):
            columns = np.ascontiguousarray(both.others[order[c:d]].T)
            for s, e in _spans(rows, max(1, CELLS // (d - c))):
                common = both.mine[s:e] @ columns
                both.without_own(common, s, (c, d), 0.0, place)
                root = np.sqrt((both.n[s:e] * size[c]).astype(np.float64))
                np.maximum(high[s:e], common.max(axis=1) / root, out=high[s:e])
                row, col = np.divmod(np.flatnonzero(common == 0), d - c)
                users[s:e] -= np.bincount(row, weights=heavy[c + col], minlength=e - s).astype(np.int64)
                common[row, col] = np.inf
                np.minimum(low[s:e], common.min(axis=1) / root, out=low[s:e])
    return users, shared, sim, low, high
