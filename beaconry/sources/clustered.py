"""A key-clustered table: files hold disjoint key ranges, so a set of keys opens few of them.

Rows are dealt to files by key range and sorted inside, with a Parquet bloom filter on the key. A small table beside the
files, one row a file, gives each file's least and greatest key. A look-up places the keys among these ranges and reads only the
files met; inside them row groups are left out by their statistics and filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGES = "_ranges"
ROWS = 1_000_000  # of one file


def write_clustered(df: DataFrame, path: str, key: str, files: int | None = None, rows: int = ROWS) -> None:
    """Write ``df`` in ``files`` key ranges (by default, of about ``rows`` rows each). Rows of one key may share a file with others, never two files."""
    spark = df.sparkSession
    files = files or max(1, -(-df.count() // rows))
    (df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite")
     .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.max.bytes", str(1 << 20)).parquet(path))
    stored = spark.read.schema(df.schema).parquet(path)
    ranges = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    ranges.coalesce(1).write.mode("overwrite").parquet(f"{path}/{RANGES}")  # one row a file


def files_of(spark: SparkSession, path: str, keys: DataFrame, key: str) -> list[str]:
    """The files whose ranges hold any of the keys. NULL is no key; ranges, one a file, go to every task."""
    ranges = spark.read.parquet(f"{path}/{RANGES}").where("low IS NOT NULL").orderBy("low", "high").collect()
    if not ranges:
        return []
    low, high = (np.array([r[c] for r in ranges]) for c in ("low", "high"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[int] = set()
        for b in batches:
            k = b.column(0).to_numpy(zero_copy_only=False)
            at = np.searchsorted(low, k, side="right") - 1
            inside = (at >= 0) & (k <= high[np.maximum(at, 0)])
            met.update(np.unique(at[inside]).tolist())
        yield pa.RecordBatch.from_arrays([pa.array(sorted(met), pa.int64())], names=["at"])

    places = keys.select(key).dropna().mapInArrow(place, "at long").distinct().collect()  # at most one a file
    return sorted(ranges[r["at"]]["file"] for r in places)


def clustered_lookup(spark: SparkSession, path: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of the wanted keys from a table of ``write_clustered``; other files are not opened."""
    schema = spark.read.parquet(path).schema
    files = files_of(spark, path, keys, key)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).join(keys.select(key).distinct(), key, "left_semi")
