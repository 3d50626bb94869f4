"""Batch sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.functions.columns import as_col

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             mode: str = "PERMISSIVE") -> DataFrame:
    """CSV with header. Without a schema Spark infers one (a second pass over the file)."""
    reader = (spark.read.option("header", True).option("mode", mode).option("encoding", "UTF-8")
              .option("escape", '"').option("multiLine", False))
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_csv_quarantine(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the schema, and the raw text of those that do not.

    Pruning is off, so a row is judged by all its columns whatever is selected later.
    Spark refuses a scan that asks for the raw text only; write both results, or select a
    data column, before counting them.
    """
    wide = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"')
          .option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).schema(wide).csv(path))
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).withColumnRenamed(CORRUPT, "raw")
    return good, bad


def sample_scan(df: DataFrame, n: int, key: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by key (a bounded scan for try-outs)."""
    return df.orderBy(*key).limit(n)


def lookup(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Items of the wanted keys; the keys may be many, so this is a join, not a loop."""
    return df.join(keys.select(*on).distinct(), list(on), "left_semi")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), files: int | None = None) -> None:
    out = df if files is None else df.coalesce(files)
    writer = out.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV; array, struct and map columns become JSON text."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    cols = [F.to_json(F.col(f.name), {"ignoreNullFields": "false"}).alias(f.name) if isinstance(f.dataType, nested)
            else F.col(f.name) for f in df.schema.fields]
    df.select(*cols).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme Spark would use, so that executors resolve it as the driver does."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString()


def ensure_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Create an empty table when the path is missing; return the table."""
    if not path_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def foreach_partition_sink(df: DataFrame, writer: Callable[[list[Row], str], None], chunk: int = 500) -> None:
    """Hand rows to an external store from the executors, ``chunk`` rows per call.

    Each chunk comes with a name made of partition and number, the same when a lost task runs again, so equal
    chunks stay apart and a repeated one can replace itself.
    """
    def send(rows: Iterable[Row]) -> None:
        part = TaskContext.get().partitionId()
        number, batch = 0, []
        for row in rows:
            batch.append(row)
            if len(batch) == chunk:
                writer(batch, f"{part:06d}-{number:06d}")
                number, batch = number + 1, []
        if batch:
            writer(batch, f"{part:06d}-{number:06d}")

    df.foreachPartition(send)


def item_json(df: DataFrame, name: str = "item") -> DataFrame:
    """Each row as one JSON item; NULL attributes are left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def keep_latest(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``. The per-task limit runs before the shuffle."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*key).orderBy(*[as_col(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
