"""Keyed writes without MERGE: whole-item replace, attribute update, and a keyed table with staged commits."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.sources.tables import keep_latest, path_exists

BUCKETS = 64
COMMITS = "_commits"


def merge_rows(base: DataFrame, delta: DataFrame) -> DataFrame:
    """Old rows plus new rows, by column name; a column only one side has is NULL in the other."""
    return base.unionByName(delta, allowMissingColumns=True)


def upsert_replace(base: DataFrame, delta: DataFrame, key: Sequence[str],
                   order: Sequence[Column | str]) -> DataFrame:
    """Whole-item replace. Delta beats base; inside one side the first in ``order`` wins."""
    both = merge_rows(base.withColumn("_new", F.lit(0)), delta.withColumn("_new", F.lit(1)))
    return keep_latest(both, key, [F.col("_new").desc(), *order]).drop("_new")


def upsert_merge(base: DataFrame, delta: DataFrame, key: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Set the named attributes from delta, keep the others, create missing items.

    ``delta`` holds one row per key.
    """
    d = delta.select(*key, *[F.col(c).alias(f"_d_{c}") for c in cols], F.lit(True).alias("_hit"))
    joined = base.join(d, list(key), "full_outer")
    out = []
    for c in [*base.columns, *[c for c in cols if c not in base.columns]]:
        if c in cols:
            old = F.col(c) if c in base.columns else F.lit(None)
            out.append(F.when(F.col("_hit"), F.col(f"_d_{c}")).otherwise(old).alias(c))
        else:
            out.append(F.col(c))
    return joined.select(*out)


def key_bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


class KeyedTable:
    """A stored table of one row per key whose state is named by its last commit.

    Rows lie in folders ``files/<version>/_bucket=<n>``. A commit is one small file, ``_commits/<number>.json``: the
    schema, the number of key buckets, and the version whose folder holds each filled bucket. New folders
    are written first and the commit file is put in place by one rename at the end, so readers see the state before or after
    a write and never a part of it. A writer that fails leaves folders that no commit names. The rename refuses a number that
    is taken, so of two writers that started from one state the second fails instead of undoing the first.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm_path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self._jvm_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def commits(self) -> list[int]:
        if not path_exists(self.spark, f"{self.path}/{COMMITS}"):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(self._jvm_path(f"{self.path}/{COMMITS}"))]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self, number: int | None = None) -> dict | None:
        """The commit of this number, the last by default; None before the first."""
        known = self.commits()
        if not known:
            return None
        number = known[-1] if number is None else number
        text = "\n".join(r[0] for r in self.spark.read.text(f"{self.path}/{COMMITS}/{number:010d}.json").collect())  # one small file
        return {**json.loads(text), "number": number}

    def read(self, buckets: Sequence[int] | None = None, state: dict | None = None) -> DataFrame:
        """The rows of a state (the last by default), of some buckets only if asked; other folders are not opened."""
        state = state or self.state()
        if state is None:
            raise ValueError(f"{self.path} holds no table")
        schema = T.StructType.fromJson(state["schema"])
        wanted = [f"{self.path}/files/{v}/_bucket={b}" for b, v in state["folders"].items() if buckets is None or int(b) in buckets]
        if not wanted:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*sorted(wanted))

    def stage(self, rows: DataFrame, buckets: Column) -> tuple[str, list[int]]:
        """Write rows as a new version that no commit names yet: its name and the buckets it fills."""
        version = uuid.uuid4().hex
        folder = f"{self.path}/files/{version}"
        # a bucket's rows meet in few files; a large bucket is split by size
        rows.withColumn("_bucket", buckets).hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(folder)
        names = [s.getPath().getName() for s in self.fs.listStatus(self._jvm_path(folder))]
        return version, sorted(int(n.split("=")[1]) for n in names if n.startswith("_bucket="))

    def commit(self, state: dict, after: int) -> None:
        """Make ``state`` the one after commit number ``after`` (-1: the first)."""
        body = json.dumps({k: state[k] for k in ("schema", "buckets", "folders")}).encode()
        staged = self._jvm_path(f"{self.path}/{COMMITS}/.{uuid.uuid4().hex}.tmp")
        out = self.fs.create(staged, False)
        out.write(bytearray(body))
        out.close()
        target = self._jvm_path(f"{self.path}/{COMMITS}/{after + 1:010d}.json")
        if self.fs.exists(target) or not self.fs.rename(staged, target):
            self.fs.delete(staged, False)
            raise RuntimeError(f"{self.path} was changed by another writer")

    def drop_unused(self, keep: int = 2) -> int:
        """Delete the folders that none of the last ``keep`` commits names: what old states and failed writers left."""
        if not self.commits():
            return 0
        used = {v for n in self.commits()[-keep:] for v in self.state(n)["folders"].values()}
        old = [s.getPath() for s in self.fs.listStatus(self._jvm_path(f"{self.path}/files")) if s.getPath().getName() not in used]
        for p in old:
            self.fs.delete(p, True)
        return len(old)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The last committed state of a keyed table; empty, with its columns, if it holds no rows."""
    return KeyedTable(spark, path).read()


def stored_buckets(spark: SparkSession, path: str) -> int | None:
    """The number of key buckets a table was laid out with; NULL without a table."""
    state = KeyedTable(spark, path).state()
    return state and state["buckets"]


def upsert_table(path: str, delta: DataFrame, key: Sequence[str],
                 order: Sequence[Column | str], buckets: int | None = None) -> None:
    """Replace items of a stored table, rewriting only the key buckets the delta touches, in one commit.

    The number of buckets is a property of the table (64 unless given at first); another number later is an
    error, since a key would then have two places. Untouched buckets are neither read nor written. The table is created with the
    first delta's columns, also by an empty one; columns that come later are NULL in older rows.
    """
    spark = delta.sparkSession
    table = KeyedTable(spark, path)
    state = table.state()
    if state is None and path_exists(spark, path) and not path_exists(spark, f"{table.path}/files"):
        raise ValueError(f"{path} holds a table of unknown layout")
    if state is not None and buckets not in (None, state["buckets"]):
        raise ValueError(f"{path} is laid out in {state['buckets']} buckets, not {buckets}")
    size = state["buckets"] if state else buckets or BUCKETS
    place = key_bucket(key, size)
    if state is None:
        rows = keep_latest(delta, key, order)
    else:
        # At most ``buckets`` small numbers reach the driver; they choose the folders.
        hit = [r[0] for r in delta.select(place.alias("_bucket")).distinct().collect()]
        rows = upsert_replace(table.read(hit, state), delta, key, order)
    version, filled = table.stage(rows, place)
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
    folders = {**(state["folders"] if state else {}), **{str(b): version for b in filled}}
    table.commit({"schema": schema.jsonValue(), "buckets": size, "folders": folders}, state["number"] if state else -1)
