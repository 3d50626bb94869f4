"""Writers that executors call with chunks of rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from beaconry.sources.tables import qualified


def parquet_chunks(path: str, schema: T.StructType | None = None) -> Callable[[list[Row], str], None]:
    """Each chunk becomes one Parquet file under the chunk's name.

    With ``schema`` all files have the table's types, whatever the rows of a chunk hold; without, types are inferred
    chunk by chunk.
    """
    target = qualified(SparkSession.active(), path)
    fields = to_arrow_schema(schema) if schema is not None else None

    def write(rows: list[Row], name: str) -> None:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs

        table = pa.Table.from_pylist([r.asDict(recursive=True) for r in rows], schema=fields)
        store, root = fs.FileSystem.from_uri(target)
        store.create_dir(root, recursive=True)
        pq.write_table(table, f"{root}/{name}.parquet", filesystem=store)

    return write
