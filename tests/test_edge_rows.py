"""Rows that plain tables lack: missing users and times, deletions, odd ids, other layouts."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconry.operators import campaigns as K
from beaconry.operators import delivery as D
from beaconry.operators import embed as E
from beaconry.operators import neighbours as N
from beaconry.operators import profile as P
from beaconry.operators import schedule as S
from beaconry.operators import serving
from beaconry.sources import tables, upsert
from beaconry.sources.chunk_sink import write_chunks
from beaconry.sources.writers import parquet_chunks

T0 = dt.datetime(2024, 1, 1)


def test_rows_without_user_or_time_have_no_click(spark):
    d = spark.createDataFrame([(1, None, T0), (2, 7, None), (3, 7, T0)], "notification_id long, user_id long, sent_at timestamp")
    c = spark.createDataFrame([(10, None, T0), (11, 7, T0), (12, 7, None)], "click_id long, user_id long, click_ts timestamp")
    assert {r["notification_id"]: r["click_id"] for r in D.attribute_clicks(d, c, 3600).collect()} == {1: None, 2: None, 3: 11}


def test_untimed_rows_are_set_apart(spark):
    df = spark.createDataFrame([(1, "k", T0), (2, "k", None), (3, None, T0), (4, None, T0)], "id long, key string, at timestamp")
    assert {r["id"] for r in D.dedup_within(df, "key", "at", "id").collect()} == {1, 3}
    assert [r["id"] for r in D.quarantined(df, "at").collect()] == [2]
    later = T0 + dt.timedelta(minutes=5)
    alerts = spark.createDataFrame([(1, later, "a", T0), (1, None, "b", T0), (1, later, "c", None)], "user_id long, ts timestamp, text string, session_start timestamp")
    assert [r["text"] for r in D.throttle(alerts).collect()] == ["a"]
    assert {r["text"] for r in D.quarantined(alerts, "ts", "session_start").collect()} == {"b", "c"}


def test_percentiles_of_a_null_group(spark):
    df = spark.createDataFrame([(None, float(i)) for i in range(101)] + [("g", 5.0)], "g string, v double")
    got = {(r["g"], r["prob"]): r["value"] for r in P.exact_percentiles(df, "v", [0.25, 0.5], ["g"]).collect()}
    assert got == {(None, 0.25): 25.0, (None, 0.5): 50.0, ("g", 0.25): 5.0, ("g", 0.5): 5.0}


def test_item_ids_with_commas_make_other_profiles(spark):
    inter = spark.createDataFrame([(1, "a,b"), (2, "a"), (2, "b"), (3, "a")], "user_id long, item_id string")
    got = {(r["user_id"], r["neighbour"]) for r in N.neighbours(inter).collect()}
    assert got == {(2, 3), (3, 2)}


def test_deltas_equal_a_full_run(spark):
    cols = ["product_display_name"]
    old = spark.createDataFrame([(1, "red shoe"), (2, "blue hat")], "product_id long, product_display_name string")
    new = spark.createDataFrame([(1, "red shoe"), (3, "green bag")], "product_id long, product_display_name string")
    stored = E.embed_text(E.content_hash(old, cols), cols, 8)
    got = E.delta_embeddings(stored, new, "product_id", cols, 8)
    assert sorted(r["product_id"] for r in got.collect()) == [1, 3]
    vectors = spark.createDataFrame([(1, [1.0, 2.0])], "product_id long, embedding array<float>")
    bought = spark.createDataFrame([("p", 1, 1, dt.date(2024, 1, 1), 1.0)], "purchase_id string, user_id long, product_id long, purchase_date date, total_amount double")
    bought = bought.withColumns({"quantity": F.lit(1), "l_suppkey": F.lit(1), "l_shipdate": F.lit(None).cast("timestamp")})
    before, after = (spark.createDataFrame([(u,) for u in ids], "user_id long") for ids in ([1, 9], [1, 2]))
    kept = E.user_embeddings(before, bought, vectors, 2, 2)
    none = vectors.select("product_id").limit(0)
    out = E.refresh_user_embeddings(kept, after, bought, bought.limit(0), vectors, none, 2, 2)
    want = E.user_embeddings(after, bought, vectors, 2, 2)
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def test_bucket_count_belongs_to_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    upsert.upsert_table(path, rows, ["k"], ["n"], buckets=8)
    upsert.upsert_table(path, rows, ["k"], ["n"])
    with pytest.raises(ValueError):
        upsert.upsert_table(path, rows, ["k"], ["n"], buckets=64)
    assert upsert.read_table(spark, path).count() == 20 and upsert.stored_buckets(spark, path) == 8


def test_equal_chunks_are_all_stored(spark, tmp_path):
    path = str(tmp_path / "w")
    df = spark.range(24).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b")).repartition(3)
    for _ in range(2):  # a retry adds nothing
        tables.foreach_partition_sink(df, parquet_chunks(path, df.schema), chunk=4)
    assert spark.read.schema(df.schema).parquet(path).count() == 24


def test_users_get_their_limit_when_the_best_campaigns_are_over(spark):
    day = dt.date(2024, 1, 5)
    rng = np.random.default_rng(2)
    users = spark.createDataFrame([(u, [1.0, float(rng.normal())]) for u in range(5)], "user_id long, embedding array<double>")
    over = [(f"OLD{i}", 5, dt.date(2023, 1, 1), dt.date(2023, 2, 1)) for i in range(12)]
    live = [(f"NEW{i}", 3, dt.date(2024, 1, 1), dt.date(2024, 2, 1)) for i in range(6)]
    campaigns = spark.createDataFrame(over + live, "campaign_id string, priority int, start_date date, end_date date")
    vectors = spark.createDataFrame([(c[0], [1.0, 0.0]) for c in over] + [(c[0], [-1.0, 0.1 * i]) for i, c in enumerate(live)],
                                    "campaign_id string, embedding array<double>")
    rules = spark.createDataFrame([(u, 4, "22:00", "08:00", None, None) for u in range(5)],
                                  "user_id long, max_notifications_per_day int, quiet_start string, quiet_end string, preferred_times array<string>, blackout_dates array<date>")
    ranked = K.campaign_topk(users, vectors.join(S.live_on(campaigns, str(day)).select("campaign_id"), "campaign_id", "left_semi"), 10)
    plan = S.plan_schedule(ranked, rules, campaigns, str(day)).groupBy("user_id").count().collect()
    assert [r["count"] for r in plan] == [4] * 5


def test_every_priority_and_number_gets_an_answer(spark):
    got = spark.createDataFrame([(p,) for p in (1, 3, 4, 5, 9)], "p int").select(serving.priority_text(F.col("p"))).collect()
    assert [r[0] for r in got] == ["low", "low", "medium", "high", "high"]
    users = spark.createDataFrame([(1, [1.0])], "user_id long, embedding array<double>")
    reqs = spark.createDataFrame([(1, 1, None), (2, 1, 20), (3, 1, 0), (4, 1, -1), (5, 1, 21)], "request_id long, user_id long, num_recommendations int")
    assert {r["request_id"]: r["error_code"] for r in serving.request_status(reqs, users).collect()} == {
        1: None, 2: None, 3: "INVALID_REQUEST", 4: "INVALID_REQUEST", 5: "INVALID_REQUEST"}


# -- tables that survive ---------------------------------------------------------------

def test_an_empty_first_delta_makes_a_table(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "n")], "k long, v string")
    with pytest.raises(ValueError):
        upsert.read_table(spark, path)
    upsert.upsert_table(path, rows.limit(0), ["k"], ["v"], buckets=4)
    assert upsert.read_table(spark, path).count() == 0 and upsert.read_table(spark, path).columns == ["k", "v"]
    upsert.upsert_table(path, rows, ["k"], ["v"])
    upsert.upsert_table(path, rows.limit(0), ["k"], ["v"])  # changes nothing
    assert {tuple(r) for r in upsert.read_table(spark, path).collect()} == {(1, "a"), (2, None), (None, "n")}
    upsert.upsert_table(path, spark.createDataFrame([(2, "b", 7)], "k long, v string, w int"), ["k"], ["v"])
    assert {tuple(r) for r in upsert.read_table(spark, path).collect()} == {(1, "a", None), (2, "b", 7), (None, "n", None)}


def test_a_failed_write_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.range(50).select(F.col("id").alias("k"), F.lit(1).alias("n"))
    upsert.upsert_table(path, rows, ["k"], ["n"], buckets=4)
    before = upsert.KeyedTable(spark, path).commits()
    with monkeypatch.context() as m:  # the writer dies after its files, before its commit
        m.setattr(upsert.KeyedTable, "commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            upsert.upsert_table(path, rows.withColumn("n", F.lit(2)), ["k"], ["n"])
    fails = F.raise_error(F.lit("task dies")).cast("int")
    with pytest.raises(Exception, match="task dies"):
        upsert.upsert_table(path, rows.withColumn("n", F.when(F.col("k") == 49, fails).otherwise(3)), ["k"], ["n"])
    table = upsert.KeyedTable(spark, path)
    assert table.commits() == before and upsert.read_table(spark, path).agg(F.sum("n")).first()[0] == 50
    assert table.drop_unused() >= 1 and upsert.read_table(spark, path).count() == 50
    # of two writers from one state the second fails
    state = table.state()
    upsert.upsert_table(path, rows.limit(1).withColumn("n", F.lit(9)), ["k"], ["n"])
    with pytest.raises(RuntimeError):
        table.commit(state, state["number"])
    assert upsert.read_table(spark, path).agg(F.sum("n")).first()[0] == 58 and table.read(state=state).agg(F.sum("n")).first()[0] == 50


def test_chunks_appear_with_the_commit_or_not_at_all(spark, tmp_path):
    path, df = str(tmp_path / "w"), spark.range(25).repartition(3).select("id", F.lit(None).cast("string").alias("b"))
    write_chunks(df, path, chunk=4)
    assert spark.read.parquet(path).count() == 25
    assert max(r["n"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) == 4
    dies = df.withColumn("b", F.when(F.col("id") == 24, F.raise_error(F.lit("task dies")).cast("string")).otherwise("x"))
    with pytest.raises(Exception):
        write_chunks(dies, path, chunk=4)
    assert spark.read.parquet(path).count() == 25 and [p.name for p in (tmp_path / "w").iterdir() if "staging" in p.name] == []
    write_chunks(df, path, chunk=10)
    assert spark.read.parquet(path).count() == 50
    write_chunks(df.limit(7), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 7


def test_a_staging_folder_goes_although_tasks_still_write(spark, tmp_path):
    from pyarrow import fs

    from beaconry.sources.chunk_sink import ChunkWriter

    class Busy:
        """A store in which files appear while the folder is being removed."""

        def __init__(self):
            self.real, self.fails = fs.LocalFileSystem(), 3

        def get_file_info(self, path):
            return self.real.get_file_info(path)

        def delete_dir(self, path):
            self.fails -= 1
            if self.fails >= 0:
                raise OSError("directory not empty")
            self.real.delete_dir(path)

    writer = ChunkWriter(f"file://{tmp_path}", spark.range(1).schema, 4, False)
    assert (tmp_path / writer.job).is_dir()
    writer._clear(Busy(), str(tmp_path))
    assert not (tmp_path / writer.job).exists()


def test_late_rows_are_counted_and_listed(spark, tmp_path):
    """Three micro-batches, the second a day late; the last is replayed and counts once."""
    from beaconry.streaming import clicks as S

    src, rates, late, ckpt = (str(tmp_path / n) for n in ("src", "rates", "late", "ckpt"))
    kind = "ts timestamp, event_type string, n int"
    day = dt.datetime(2024, 1, 3, 12)
    for i, times in enumerate(([day, day], [day - dt.timedelta(hours=30), day - dt.timedelta(hours=1), None], [day - dt.timedelta(hours=30), day])):
        spark.createDataFrame([(x, "a", i) for x in times], kind).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(kind).parquet(src)
        S.count_with_late(stream, rates, late, ckpt, "1 hour", 86400).awaitTermination()
    want = {day - dt.timedelta(hours=30): 2, day - dt.timedelta(hours=1): 1, day: 3}
    assert {r["window_start"]: r["n"] for r in S.read_rates(spark, rates).collect()} == want
    listed = S.read_late(spark, late, stream.schema)
    assert sorted((r["n"], r["ts"]) for r in listed.collect()) == [(1, day - dt.timedelta(hours=30)), (2, day - dt.timedelta(hours=30))]
    last = max((tmp_path / "ckpt" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()  # the last batch is not known to have ended
    for crc in (tmp_path / "ckpt" / "commits").glob(f".{last.name}.crc"):
        crc.unlink()
    S.count_with_late(spark.readStream.schema(kind).parquet(src), rates, late, ckpt, "1 hour", 86400).awaitTermination()
    assert {r["window_start"]: r["n"] for r in S.read_rates(spark, rates).collect()} == want
    assert S.read_late(spark, late, stream.schema).count() == 2


def test_a_key_set_opens_few_files(spark, tmp_path):
    from beaconry.sources import clustered

    path = str(tmp_path / "c")
    rows = spark.range(4000).select((F.col("id") * 3).alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartition(7)
    rows = rows.unionByName(spark.createDataFrame([(None, "none"), (30, "again")], "k long, v string"))
    clustered.write_clustered(rows, path, "k", files=16)
    assert spark.read.parquet(path).count() == 4002
    every = {f for f in spark.read.parquet(path).inputFiles()}
    keys = spark.createDataFrame([(30,), (30,), (31,), (33,), (None,), (-5,), (99_999,)], "k long")
    got = clustered.clustered_lookup(spark, path, keys, "k")
    assert sorted(r["v"] for r in got.collect()) == ["again", "v10", "v11"]
    assert len(every) >= 12 and len(got.inputFiles()) == 1  # of all files one is opened
    assert clustered.clustered_lookup(spark, path, keys.where("k < 0 or k is null"), "k").count() == 0
    words = spark.createDataFrame([(w, i) for i, w in enumerate("abcdefgh")], "k string, n int")
    clustered.write_clustered(words, str(tmp_path / "w"), "k", files=4)
    assert [r["n"] for r in clustered.clustered_lookup(spark, str(tmp_path / "w"), spark.createDataFrame([("c",), ("zz",)], "k string"), "k").collect()] == [2]


def test_user_vectors_from_the_state_of_last_purchases(spark, tmp_path):
    rng = np.random.default_rng(9)
    kind = "purchase_id string, user_id long, product_id long, purchase_date date, total_amount double, quantity int, l_suppkey int, l_shipdate timestamp"
    bought = [(f"p{i}", int(rng.integers(0, 12)), int(rng.integers(0, 9)), dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.integers(0, 20))), float(i), 1, 1, None)
              for i in range(150)]
    df = spark.createDataFrame(bought, kind)
    old, new = df.where("purchase_date < '2024-01-15' and user_id <> 11"), df.where("purchase_date >= '2024-01-15' or user_id = 11")
    users = spark.createDataFrame([(u,) for u in [*range(2, 12), 50]], "user_id long")
    vectors = spark.createDataFrame([(p, [float(p), 1.0]) for p in range(8)], "product_id long, embedding array<float>")
    changed = spark.createDataFrame([(3,), (4,)], "product_id long")
    before = vectors.withColumn("embedding", F.when(F.col("product_id").isin(3, 4), F.array(F.lit(0.0), F.lit(0.0)).cast("array<float>")).otherwise(F.col("embedding")))
    stored = E.user_embeddings(spark.createDataFrame([(u,) for u in range(0, 9)], "user_id long"), old, before, 3, 2)
    old.write.parquet(str(tmp_path / "history"))
    E.recent_state(spark.read.parquet(str(tmp_path / "history")), 3).write.parquet(str(tmp_path / "state"))
    state = spark.read.parquet(str(tmp_path / "state"))
    out, after = E.refresh_from_state(stored, state, users, new, vectors, changed, 3, 2)
    want = E.user_embeddings(users, df, vectors, 3, 2)
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))
    cols = sorted(state.columns)
    assert sorted(map(str, after.select(cols).collect())) == sorted(map(str, E.recent_state(df, 3).select(cols).collect()))
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "/state" in plan and "/history" not in plan


def test_user_vectors_read_only_what_they_depend_on(spark, tmp_path):
    rng = np.random.default_rng(4)
    kind = "purchase_id string, user_id long, product_id long, purchase_date date, total_amount double, quantity int, l_suppkey int, l_shipdate timestamp"
    rows = [(f"p{rng.integers(0, 90)}", int(rng.integers(0, 6)), None if i % 9 == 0 else int(rng.integers(0, 5)), None if i % 13 == 0 else
             dt.date(2024, 1, 1) + dt.timedelta(days=int(rng.integers(0, 4))), float(rng.integers(0, 3)), 1, int(rng.integers(0, 3)), None) for i in range(120)]
    spark.createDataFrame(rows + rows[:20], kind).write.parquet(str(tmp_path / "bought"))
    bought = spark.read.parquet(str(tmp_path / "bought"))
    users = spark.createDataFrame([(u,) for u in range(8)], "user_id long")
    vectors = spark.createDataFrame([(p, [float(p + 1), 1.0]) for p in range(4)], "product_id long, embedding array<float>")
    out = E.user_embeddings(users, bought, vectors, 3, 2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<user_id:bigint,product_id:bigint,purchase_date:date>" in plan and "total_amount" not in plan
    # the state may hold these columns alone
    old, new = (bought.where(f"purchase_date < '2024-01-03' IS {x} TRUE") for x in ("", "NOT"))
    zero = vectors.limit(0).select("product_id")
    got, after = E.refresh_from_state(E.user_embeddings(users, E.recent_state(old.select(*E.VECTOR_COLS), 3), vectors, 3, 2),
                                      E.recent_state(old.select(*E.VECTOR_COLS), 3), users, new, vectors, zero, 3, 2)
    assert after.columns == E.VECTOR_COLS and sorted(map(str, got.collect())) == sorted(map(str, out.collect()))
    want: dict[int, list] = {u: [] for u in range(8)}
    for r in sorted(rows + rows[:20], key=lambda r: (r[1], -(r[3] or dt.date.min).toordinal(), r[2] is not None, r[2] or 0)):
        want[r[1]] += [r[2] + 1.0, 1.0] if r[2] is not None and r[2] < 4 else [0.0, 0.0]
    assert {r["user_id"]: r["embedding"] for r in out.collect()} == {u: (v + [0.0] * 6)[:6] for u, v in want.items()}


def test_the_delta_query_joins_purchases_once(spark):
    from beaconry.plans import catalog

    files = catalog.QUERIES["emb_delta_users"](spark, "/root/testdata/sf0.001").inputFiles()
    assert files and not [f for f in files if "lineitem" in f or "orders" in f]
