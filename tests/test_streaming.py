"""Streams against their batch results."""

import datetime as dt
import json

from pyspark.sql import functions as F

from beaconry.operators.delivery import throttle
from beaconry.sources import messages
from beaconry.streaming import clicks as S

GOOD = {"event": "view", "user_id": "U1", "price": 12.0, "product_id": 7, "product_name": "Shoe", "category": "Footwear",
        "article_type": "shoe", "timestamp": "2024-01-01T00:00:00"}


def write_topic(path, rows, name="a.json"):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n")


def test_ingest_quarantine_and_replay(spark, tmp_path):
    topic, target, bad = tmp_path / "topic", str(tmp_path / "clicks"), str(tmp_path / "bad")
    no_user = {k: v for k, v in GOOD.items() if k != "user_id"}
    write_topic(topic, [GOOD, GOOD, no_user, {**GOOD, "price": "free"}, '{"event": "vi', {**GOOD, "product_id": None}])

    def run(ckpt):
        S.ingest_clicks(messages.read_clicks(spark, {"path": str(topic)}), target, bad, str(tmp_path / ckpt)).awaitTermination()
        return S.read_ingested(spark, target)

    first = {(r["user_id"], r["price"]) for r in run("c1").collect()}
    assert first == {("U1", 12), ("U0020", 12)}
    assert spark.read.parquet(bad).count() == 3
    # Starting over reads everything again; ids are the same, so nothing is doubled.
    assert run("c2").count() == 2
    # New files are picked up where the checkpoint left off.
    write_topic(topic, [{**GOOD, "product_id": 8}], "b.json")
    assert run("c2").count() == 3


def test_published_messages_round_trip(spark):
    df = spark.createDataFrame([("view", "U1", 5, 7)], "event string, user_id string, price int, product_id long")
    valid, bad = S.split_valid(S.parse_clicks(messages.event_messages(df)))
    assert valid.first()["product_id"] == "7" and bad.count() == 0


def test_envelope_and_reply(spark):
    rows = [('{"user_id": 5}',), (json.dumps({"body": json.dumps({"user_id": 6})}),), ("{}",)]
    df = spark.createDataFrame(rows, "request string")
    got = messages.parse_envelope(df, "request", "user_id long")
    assert [r["user_id"] for r in got.collect()] == [5, 6, None]
    body = json.dumps({"top_recommendation": {"campaign_data": {"template_long": "Hi"}}})
    reply = spark.createDataFrame([(json.dumps({"body": body}),), ("{}",)], "r string")
    assert [r[0] for r in reply.select(messages.notification_text("r")).collect()] == ["Hi", ""]


def test_throttle_stream_equals_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    rows = [(u, t0 + dt.timedelta(seconds=(37 * i * (u + 1)) % 2000), "ABCDE"[i % 5]) for u in range(3) for i in range(40)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp, text string").withColumn("session_start", F.lit(t0))
    src = str(tmp_path / "src")
    df.coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    out = S.run_to_table(S.throttle_stream(stream), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    want = throttle(df)
    assert out.count() == want.count() > 5 and out.select(*df.columns).exceptAll(want).count() == 0


def test_late_and_dedup(spark):
    t0 = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t0, t0 + dt.timedelta(seconds=3)), (2, t0, t0 + dt.timedelta(seconds=9))], "id long, ts timestamp, arrived_at timestamp")
    ok, late = S.late_events(df, 5)
    assert [r["id"] for r in ok.collect()] == [1] and [r["id"] for r in late.collect()] == [2]
    assert S.dedup_stream(df.unionByName(df), ["id"]).count() == 2


def test_clicks_are_stored_once_and_by_day(spark, tmp_path):
    from beaconry.sources import messages

    def message(i, day):
        return (f'{{"event":"view","user_id":"{i}","price":"5","product_id":"{i}","timestamp":"2024-01-{day:02d}T10:00:00"}}',)

    topic, target, bad = (str(tmp_path / n) for n in ("topic", "clicks", "bad"))
    first = [message(i, 1 + i % 2) for i in range(6)]
    for rows in (first, first[:3] + [message(9, 1)]):
        spark.createDataFrame(rows, "value string").coalesce(1).write.mode("append").text(topic)
        S.ingest_clicks(messages.read_clicks(spark, {"path": topic}), target, bad, str(tmp_path / "ckpt")).awaitTermination()
    assert S.read_ingested(spark, target).count() == 7 == S.read_ingested(spark, target).select("id").distinct().count()
    assert {p.name for p in (tmp_path / "clicks").glob("day=*")} == {"day=2024-01-01", "day=2024-01-02"}


def test_topic_options(monkeypatch):
    """The connector is absent here: what would be handed to it is checked."""
    from beaconry.sources import messages

    class Calls:
        def __init__(self):
            self.seen = []

        def __getattr__(self, name):
            return lambda *a: (self.seen.append((name, *a)), self)[1]

    class Frame:
        write = Calls()

    monkeypatch.setattr(messages, "event_messages", lambda df: df)
    messages.publish_events(Frame, "clicks", "host:9092")
    assert Frame.write.seen == [("format", "kafka"), ("option", "kafka.bootstrap.servers", "host:9092"), ("option", "topic", "clicks"), ("save",)]


def test_throttle_stream_folds_many_sessions_in_a_call(spark, tmp_path):
    """Several files, so several micro-batches: sessions of one bucket, ends of sessions and rows without a user keep apart."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(None if u == 6 else u, t0 + dt.timedelta(days=d, seconds=60 + (3700 * i * (u + 1)) % 80000), "ABC"[(i + u) % 3], d)
            for d in range(4) for u in range(7) for i in range(6)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp, text string, day int")
    df = df.withColumn("session_start", F.date_trunc("day", "ts"))
    src = str(tmp_path / "src")
    for d in range(4):  # a file a day, in order
        df.where(F.col("day") == d).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = S.run_to_table(S.throttle_stream(stream, 3600, buckets=2), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    want = throttle(df, min_gap_seconds=3600)
    assert out.count() == want.count() > 30 and out.select(*df.columns).exceptAll(want).count() == 0
