"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.session import cut, scratch_path, tune

# Words are runs of other characters than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
GAP_BYTES = np.zeros(256, dtype=bool)
GAP_BYTES[[0x20, *range(0x09, 0x0E)]] = True


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of every operator here: Arrow batches small enough for long texts."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared scratch folder and read it back: later steps start from files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """As ``stored``, filed under ``buckets`` hashes of ``key``: joins and co-groups by it read the files as they lie, without a shuffle."""
    path = scratch_path(df.sparkSession, label)
    name = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it


def give_back() -> None:
    """Return freed memory to the system: workers live on from stage to stage, and their executor counts all they hold."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def text_blocks(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with about ``most`` bytes in column ``text``, and these texts as UTF-8 (null: empty)."""
    for batch in batches:
        texts = [t.encode() if t is not None else b"" for t in batch.column("text").to_pylist()]
        start = held = 0
        for i, text in enumerate(texts):
            held += len(text)
            if held >= most or i + 1 == len(texts):
                yield batch.slice(start, i + 1 - start), texts[start:i + 1]
                start, held = i + 1, 0
    give_back()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers (the finaliser of SplitMix64, a fixed public function)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASE = 0x9E3779B97F4A7C15 | 5  # odd: it has an inverse modulo 2^64
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, BASE, dtype=np.uint64), np.full(size, pow(BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS[0][:n], _POWERS[1][:n]


class RollingHash:
    """64-bit hashes of any slices of a byte array after one pass over it; ``lower`` folds A-Z."""

    def __init__(self, data: np.ndarray, lower: bool = False):
        up, self._down = _powers(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((_LOWER if lower else _TABLE)[data] * up[:-1], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def every(self, width: int) -> np.ndarray:
        """The hash of the slice of ``width`` bytes from every place that has one."""
        n = max(len(self._sums) - width, 0)
        return mixed((self._sums[width:] - self._sums[:n]) * self._down[:n] + np.uint64(width))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~GAP_BYTES[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


LONG_WORD = 64  # bytes; polynomials modulo 2^64 clash on certain words of a thousand letters


def shingle_sets(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``size`` words, A-Z folded.

    Fewer words make one shingle of them all; no words, none.
    """
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    starts, ends = word_spans(data)
    words = RollingHash(data, lower=True).of(starts, ends)
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        words[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes().lower(), digest_size=8).digest(), "little")
    limits = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in texts)]))
    for lo, hi in zip(limits[:-1], limits[1:], strict=True):
        if lo == hi:
            yield np.zeros(0, dtype=np.uint64)
            continue
        own = words[lo:hi]
        k = min(size, len(own))
        out = own[:len(own) - k + 1].copy()
        for j in range(1, k):
            out = mixed(out * np.uint64(BASE) + own[j:len(own) - k + 1 + j])
        yield np.unique(out)


def connected(edges: DataFrame, key: str = "string") -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (id, root), root being the smallest id reachable.

    Every round hooks each node's root to the smallest root next to it and halves the paths by one self join, so the
    rounds grow with the logarithm of the longest chain. Nothing but one count per round reaches the driver.
    """
    both = cut(edges.select(F.col("a").cast(key), F.col("b").cast(key)).where("a <> b")
               .unionByName(edges.select(F.col("b").cast(key).alias("a"), F.col("a").cast(key).alias("b")).where("a <> b")).distinct())
    state = cut(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("near"))
                .select("id", F.least("id", "near").alias("root")))
    while True:
        # the smallest root among the neighbours of all members goes to the member and to its present root
        met = (both.join(state.select(F.col("id").alias("b"), F.col("root").alias("seen")), "b")
               .groupBy(F.col("a").alias("id")).agg(F.min("seen").alias("seen")))
        hooked = state.join(met, "id").select("id", "root", F.least("root", "seen").alias("seen"))
        lowest = hooked.groupBy(F.col("root").alias("at")).agg(F.min("seen").alias("low"))
        moved = (hooked.join(lowest.select(F.col("at").alias("root"), "low"), "root")
                 .select("id", F.col("root").alias("was"), F.least("seen", "low").alias("root")))
        jump = moved.select(F.col("id").alias("root"), F.col("root").alias("next"))
        new = cut(moved.join(jump, "root", "left").select("id", "was", F.least("root", F.coalesce("next", "root")).alias("root")))
        state = new.select("id", "root")
        if new.where("root <> was").isEmpty():
            return state
