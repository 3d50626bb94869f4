"""A Python data source that writes chunks of rows as files, with one commit a job.

``df.write.format("chunks").option("path", ...).option("chunk", 500).mode("append").save()``. Tasks write into a staging
folder of the job and report what they wrote; the job's commit moves the reported files into place, so files of lost
attempts never count. A job that fails is aborted: its staging folder goes and the table is as before.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from beaconry.sources.tables import qualified

CHUNK = 500


@dataclass
class Written(WriterCommitMessage):
    """Names of the files that one successful task attempt has staged."""

    names: list[str] = field(default_factory=list)


def open_store(target: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(target)


class ChunkWriter(DataSourceArrowWriter):
    def __init__(self, target: str, schema: StructType, chunk: int, overwrite: bool):
        self.target, self.schema, self.chunk, self.overwrite = target, schema, chunk, overwrite
        self.job = f"_staging-{uuid.uuid4().hex}"
        # made before any task: one that is still at work when the job is given up finds it gone and cannot bring it back
        store, root = open_store(target)
        store.create_dir(f"{root}/{self.job}", recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        store, root = open_store(self.target)
        fields = to_arrow_schema(self.schema)
        task, out, held = TaskContext.get(), Written(), []

        def flush(rows: int) -> None:
            # the attempt's own name: a second attempt never meets the files of the first
            name = f"{task.partitionId():06d}-{len(out.names):06d}-{self.job[-8:]}-{task.taskAttemptId()}.parquet"
            table = pa.Table.from_batches(held)
            pq.write_table(table.slice(0, rows).cast(fields), f"{root}/{self.job}/{name}", filesystem=store)
            out.names.append(name)
            held[:] = table.slice(rows).to_batches()

        for batch in iterator:
            held.append(batch)
            while sum(b.num_rows for b in held) >= self.chunk:
                flush(self.chunk)
        if any(b.num_rows for b in held):
            flush(self.chunk)
        return out

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = open_store(self.target)
        old = []
        if self.overwrite:
            found = store.get_file_info(fs.FileSelector(root, allow_not_found=True))
            old = [f.path for f in found if f.is_file and f.base_name.endswith(".parquet")]
        store.create_dir(root, recursive=True)
        for message in messages:
            for name in message.names if message else ():
                store.move(f"{root}/{self.job}/{name}", f"{root}/{name}")
        for path in old:
            store.delete_file(path)
        self._clear(store, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clear(*open_store(self.target))

    def _clear(self, store, root: str) -> None:
        from pyarrow import fs

        for last in (False,) * 20 + (True,):
            try:
                if store.get_file_info(f"{root}/{self.job}").type == fs.FileType.Directory:
                    store.delete_dir(f"{root}/{self.job}")
                return
            except OSError:  # a task that is still at work has added a file meanwhile
                if last:
                    raise
                time.sleep(0.1)


class ChunkSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "chunks"

    def writer(self, schema: StructType, overwrite: bool) -> ChunkWriter:
        return ChunkWriter(self.options["path"], schema, int(self.options.get("chunk", CHUNK)), overwrite)


def write_chunks(df: DataFrame, path: str, chunk: int = CHUNK, mode: str = "append") -> None:
    """Write ``df`` as files of at most ``chunk`` rows each; all of them appear with the job's commit, or none."""
    spark = df.sparkSession
    spark.dataSource.register(ChunkSource)
    df.write.format("chunks").option("path", qualified(spark, path)).option("chunk", str(chunk)).mode(mode).save()
