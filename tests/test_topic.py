"""The topic branches, run against a stub of the connector: a Python data source that keeps topics in a folder."""

import json
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, SimpleDataSourceStreamReader, WriterCommitMessage

from beaconry.sources import messages
from beaconry.streaming import clicks as S


def stub():
    """The servers option names a folder; the options a connector needs are checked by using them."""

    class Topic(DataSource):
        @classmethod
        def name(cls):
            return "topic_stub"

        def schema(self):
            return "key binary, value binary, topic string"

        def _root(self, option):
            return str(Path(self.options["kafka.bootstrap.servers"]) / self.options[option])

        def writer(self, schema, overwrite):
            assert not overwrite and schema.fieldNames() == ["value"]
            return Writer(self._root("topic"))

        def streamWriter(self, schema, overwrite):
            return StreamWriter(self._root("topic"))

        def simpleStreamReader(self, schema):
            assert self.options["startingoffsets"] == "earliest"
            return Reader(self._root("subscribe"))

    def put(root, rows):
        import json as j
        import uuid as u
        from pathlib import Path as P

        P(root).mkdir(parents=True, exist_ok=True)
        (P(root) / f"{u.uuid4().hex}.json").write_text(j.dumps([r["value"] for r in rows]))
        return WriterCommitMessage()

    class Writer(DataSourceWriter):
        def __init__(self, root):
            self.root = root

        def write(self, iterator):
            return put(self.root, iterator)

    class StreamWriter(DataSourceStreamWriter):
        def __init__(self, root):
            self.root = root

        def write(self, iterator):
            return put(self.root, iterator)

        def commit(self, messages, batchId):
            pass

        def abort(self, messages, batchId):
            pass

    class Reader(SimpleDataSourceStreamReader):
        def __init__(self, root):
            self.root = root

        def _rows(self):
            import json as j
            from pathlib import Path as P

            files = sorted(P(self.root).glob("*.json"), key=lambda p: (p.stat().st_mtime_ns, p.name))
            return [(None, v.encode(), "t") for p in files for v in j.loads(p.read_text())]

        def initialOffset(self):
            return {"n": 0}

        def read(self, start):
            rows = self._rows()[start["n"]:]
            return iter(rows), {"n": start["n"] + len(rows)}

        def readBetweenOffsets(self, start, end):
            return iter(self._rows()[start["n"]:end["n"]])

        def commit(self, end):
            pass

    return Topic


@pytest.fixture
def servers(spark, tmp_path, monkeypatch):
    spark.dataSource.register(stub())
    monkeypatch.setattr(messages, "CONNECTOR", "topic_stub")
    return str(tmp_path / "servers")


def test_published_clicks_are_ingested_from_the_topic(spark, tmp_path, servers):
    df = spark.range(20).select(F.lit("view").alias("event"), F.col("id").cast("string").alias("user_id"), F.lit(5).alias("price"),
                                F.col("id").alias("product_id"), F.lit("2024-01-01T00:00:00").alias("timestamp"))
    messages.publish_events(df, "clicks", servers)
    values = [json.loads(v) for p in (tmp_path / "servers" / "clicks").glob("*.json") for v in json.loads(p.read_text())]
    assert len(values) == 20 and {v["product_id"] for v in values} == set(range(20))
    target, bad = str(tmp_path / "clicks"), str(tmp_path / "bad")
    source = {"servers": servers, "topic": "clicks", "per_trigger": "1000"}
    query = S.ingest_clicks(messages.read_clicks(spark, source), target, bad, str(tmp_path / "ckpt"), once=False, poll="1 second")
    query.processAllAvailable()
    messages.publish_events(df.limit(0).unionByName(df.where("product_id = 3").withColumn("product_id", F.lit(77).cast("long"))), "clicks", servers)
    query.processAllAvailable()
    query.stop()
    assert S.read_ingested(spark, target).count() == 21


def test_a_stream_is_published(spark, tmp_path, servers):
    src = str(tmp_path / uuid.uuid4().hex)
    spark.range(9).select("id", F.lit("x").alias("v")).write.parquet(src)
    stream = spark.readStream.schema("id long, v string").parquet(src)
    messages.publish_stream(stream, "out", servers, str(tmp_path / "ckpt")).awaitTermination()
    got = [json.loads(v) for p in (tmp_path / "servers" / "out").glob("*.json") for v in json.loads(p.read_text())]
    assert sorted(v["id"] for v in got) == list(range(9)) and got[0].keys() == {"id", "v"}
