"""Similarity join of item sets by inverted lists.

Every list (here: a profile, the item set some users share) files one row under each of its items; rows met under one item are pairs that
share it. Items have a fixed order, rare before popular, and a pair counts at its first common item only, so no pair is met
twice. There the common items can be at most those from that item on, on either side; a pair whose best case stays below the bar of the
probing list is never looked at, and a list whose bar lies above what its remaining items can reach stops probing: popular items come last
and are mostly skipped.

The rows of an item with many holders are dealt to sub-buckets of bounded size, and a probe goes to all of them. Items and
sub-buckets are gathered into buckets of a bounded load, so a task works on many lists at once and only sums or the best few leave it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconry.operators.tiles import cores_of, fresh, list_parts

HOLDERS = 4096  # rows of one item that a probe meets at once
LOAD = 4_000_000  # list entries in one bucket
CELLS = 1 << 20  # entries compared at once inside a task


def lists_by_rarity(pairs: DataFrame, key: str, item: str) -> DataFrame:
    """One row per ``key``: its distinct items as (holders, item), rare items first."""
    holders = pairs.groupBy(F.col(item).alias("_item")).agg(F.count("*").alias("holders"))
    return (pairs.join(holders, F.col(item) == F.col("_item"))
            .groupBy(key).agg(F.sort_array(F.collect_set(F.struct("holders", F.col(item).alias("item")))).alias("items")))


def places(lists: DataFrame, upto: int | None = None) -> DataFrame:
    """A row for each item of each list, up to ``upto`` items a list, with its place (from 0) among the list's items."""
    entries = "items" if upto is None else F.slice("items", 1, upto)
    return (lists.select("*", F.posexplode(entries).alias("place", "_e"))
            .withColumns({"item": F.col("_e.item"), "holders": F.col("_e.holders"), "items": F.transform("items", lambda e: e["item"])}).drop("_e"))


def _buckets(rows: DataFrame, count: int) -> DataFrame:
    return rows.withColumn("_g", F.pmod(F.xxhash64("item", "_sub"), F.lit(count)).cast("int")).drop("holders")


def meet(postings: DataFrame, probes: DataFrame, key: str, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str,
         load: int, holders: int = HOLDERS) -> DataFrame:
    """Run ``fn(postings, probes)`` on every bucket; rows under one item and sub-bucket (column ``code``) are to be paired.

    ``load`` is the number of list entries on both sides, or an estimate; ``holders`` bounds the rows of a sub-bucket.
    """
    posted, asked = deal(postings, probes, key, load, holders)
    return fresh(posted).groupBy("_g").cogroup(fresh(asked).groupBy("_g")).applyInArrow(fn, schema)


def deal(postings: DataFrame, probes: DataFrame, key: str, load: int, holders: int = HOLDERS) -> tuple[DataFrame, DataFrame]:
    """Both sides with the bucket ``_g`` of each row; a probe stands in every sub-bucket of its item."""
    buckets = max(math.ceil(load / LOAD), 2 * cores_of(postings))
    subs = F.greatest(F.ceil(F.col("holders") / holders), F.lit(1)).cast("int")
    posted = _buckets(postings.withColumn("_sub", F.pmod(F.xxhash64(key), subs).cast("int")), buckets)
    asked = _buckets(probes.withColumn("_sub", F.explode(F.sequence(F.lit(0), subs - 1))), buckets)
    return posted, asked


def type_of(df: DataFrame, key: str) -> tuple[str, pa.DataType]:
    """The type of an id column, for Spark and for Arrow."""
    name = df.schema[key].dataType.simpleString()
    return name, {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[name]


def numbered(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Columns of any type as numbers of their values, in the order of the values and alike in all columns."""
    values = [c.to_numpy(zero_copy_only=False) for c in columns]
    _, codes = np.unique(np.concatenate(values), return_inverse=True)
    return np.split(codes, np.cumsum([len(v) for v in values])[:-1])


class Lists:
    """One side of a bucket: rows with their item, place and whole list in numbers."""

    def __init__(self, table: pa.Table, ids: np.ndarray, items: np.ndarray, offsets: np.ndarray, key: np.ndarray):
        self.table, self.ids, self.items, self.offsets, self.key = table, ids, items, offsets, key
        self.n = np.diff(offsets)
        self.left = self.n - table.column("place").to_numpy()  # items from the row's own on


def both_sides(postings: pa.Table, probes: pa.Table, key: str) -> tuple[Lists, Lists]:
    tables = (postings, probes)
    ids = numbered(*(t.column(key) for t in tables))
    parts = [list_parts(t.column("items")) for t in tables]
    _, codes = np.unique(np.concatenate([v[o[0]:o[-1]] for o, v in parts]), return_inverse=True)
    cut = parts[0][0][-1] - parts[0][0][0]
    own = numbered(*(t.column("item") for t in tables))
    subs = [t.column("_sub").to_numpy() for t in tables]
    wide = 1 + max((int(s.max()) for s in subs if len(s)), default=0)
    return tuple(Lists(t, i, c, o - o[0], k * wide + s)
                 for t, i, c, (o, _), k, s in zip(tables, ids, (codes[:cut], codes[cut:]), parts, own, subs, strict=True))


class _Lookup:
    """Shared items by looking up the probing list's items among the (list, item) pairs of the postings: for wide catalogues."""

    def __init__(self, postings: Lists, probes: Lists, codes: int):
        self.probes, self.codes = probes, codes
        self.cost = probes.n
        self.held = np.sort(np.repeat(np.arange(len(postings.n)), postings.n) * codes + postings.items)

    def __call__(self, probe: np.ndarray, posting: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.probes.n[probe]
        begin = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(begin, size)
        wanted = np.repeat(posting, size) * self.codes + self.probes.items[np.repeat(self.probes.offsets[probe], size) + step]
        hit = self.held[np.minimum(np.searchsorted(self.held, wanted), len(self.held) - 1)] == wanted
        first = np.minimum.reduceat(np.where(hit, step, np.iinfo(np.int64).max), begin)
        here = np.flatnonzero(first == size - self.probes.left[probe])
        return here, np.add.reduceat(hit.astype(np.int64), begin)[here]


class _Bits:
    """Shared items by sets of bits: for catalogues of few items beside the lists' lengths."""

    def __init__(self, postings: Lists, probes: Lists, codes: int):
        words = -(-codes // 64)
        self.cost = np.full(len(probes.n), words)
        self.theirs, self.ours = self._sets(postings, words, postings.n), self._sets(probes, words, probes.n)
        self.before = self._sets(probes, words, probes.n - probes.left)

    @staticmethod
    def _sets(lists: Lists, words: int, upto: np.ndarray) -> np.ndarray:
        row = np.repeat(np.arange(len(upto)), upto)
        item = lists.items[np.arange(upto.sum()) - np.repeat(np.cumsum(upto) - upto, upto) + np.repeat(lists.offsets[:-1], upto)]
        out = np.zeros((words, len(upto)), dtype=np.uint64)
        np.bitwise_or.at(out, (item // 64, row), np.uint64(1) << (item % 64).astype(np.uint64))
        return out

    def __call__(self, probe: np.ndarray, posting: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        here = np.arange(len(probe))
        for before, theirs in zip(self.before, self.theirs, strict=True):
            here = here[before[probe[here]] & theirs[posting[here]] == 0]
        probe, posting = probe[here], posting[here]
        return here, sum(np.bitwise_count(a[probe] & b[posting]).astype(np.int64) for a, b in zip(self.ours, self.theirs, strict=True))


def common(postings: Lists, probes: Lists, alive: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(probe, posting, shared items) of the pairs of different lists that meet at their first common item and pass ``alive(probe, posting)``."""
    order = np.argsort(postings.key, kind="stable")
    sorted_keys = postings.key[order]
    start, stop = np.searchsorted(sorted_keys, probes.key), np.searchsorted(sorted_keys, probes.key, side="right")
    codes = 1 + max(int(postings.items.max(initial=0)), int(probes.items.max(initial=0)))
    shared_at_first = (_Bits if codes / 64 <= 4 * probes.n.mean() else _Lookup)(postings, probes, codes)
    piece = np.cumsum((stop - start) * (1 + shared_at_first.cost)) // CELLS
    for rows in np.split(np.arange(len(piece)), np.flatnonzero(np.diff(piece)) + 1):
        meets = stop[rows] - start[rows]
        probe = np.repeat(rows, meets)
        posting = order[np.arange(meets.sum()) - np.repeat(np.cumsum(meets) - meets, meets) + np.repeat(start[rows], meets)]
        live = (probes.ids[probe] != postings.ids[posting]) & alive(probe, posting)
        probe, posting = probe[live], posting[live]
        if len(probe):
            here, shared = shared_at_first(probe, posting)
            yield probe[here], posting[here], shared
