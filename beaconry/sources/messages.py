"""JSON requests and replies, and the click topic."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.functions.columns import as_col

CONNECTOR = "kafka"  # the data source that topics are read and written by


def open_envelope(c) -> Column:
    """The request text, whether plain or wrapped as ``{"body": "<json>"}``."""
    return F.coalesce(F.get_json_object(as_col(c), "$.body"), as_col(c))


def parse_envelope(df: DataFrame, col: str, schema: T.StructType) -> DataFrame:
    parsed = F.from_json(open_envelope(col), schema)
    return df.withColumn("_p", parsed).select(*[c for c in df.columns if c != col], "_p.*")


def notification_text(c) -> Column:
    """Long template of the top recommendation inside a reply's JSON body, '' if absent."""
    body = F.get_json_object(as_col(c), "$.body")
    return F.coalesce(F.get_json_object(body, "$.top_recommendation.campaign_data.template_long"), F.lit(""))


def event_messages(df: DataFrame) -> DataFrame:
    """Rows as JSON message values, ready for a topic."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def _topic(writer, topic: str, servers: str):
    return writer.format(CONNECTOR).option("kafka.bootstrap.servers", servers).option("topic", topic)


def publish_events(df: DataFrame, topic: str, servers: str) -> None:
    """Append JSON messages to a topic (needs the Kafka connector on the class path)."""
    writer = _topic(event_messages(df).write, topic, servers)
    # Kafka appends by default; other connectors want the mode named.
    (writer if CONNECTOR == "kafka" else writer.mode("append")).save()


def publish_stream(df: DataFrame, topic: str, servers: str, checkpoint: str, once: bool = True, poll: str = "10 seconds"):
    """Publish the rows of a stream as JSON messages, each at least once. Returns the query."""
    writer = _topic(event_messages(df).writeStream, topic, servers).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=poll)).start()


def read_clicks(spark: SparkSession, source: dict[str, str]) -> DataFrame:
    """Stream of JSON click messages in one ``value`` column.

    ``{"servers": ..., "topic": ...}`` reads a topic from its start, at most ``per_trigger`` messages a micro-batch if that is given;
    ``{"path": ...}`` replays text files with one message per line.
    """
    if "topic" in source:
        raw = (spark.readStream.format(CONNECTOR).option("kafka.bootstrap.servers", source["servers"])
               .option("subscribe", source["topic"]).option("startingOffsets", "earliest"))
        if "per_trigger" in source:
            raw = raw.option("maxOffsetsPerTrigger", source["per_trigger"])
        return raw.load().select(F.col("value").cast("string").alias("value"))
    return spark.readStream.option("maxFilesPerTrigger", source.get("files_per_trigger", "1000")).text(source["path"])
