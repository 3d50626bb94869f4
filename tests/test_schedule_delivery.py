"""Slots, constraints, attribution, de-duplication and throttling."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from beaconry.operators import delivery as D
from beaconry.operators import metrics as M
from beaconry.operators import schedule as S

T0 = dt.datetime(2024, 1, 1)


def ranked(spark, rows):
    return spark.createDataFrame(rows, "user_id long, campaign_id string, similarity_score double, rank long")


def test_slots_are_distinct_hours(spark):
    df = ranked(spark, [(u, f"C{i}", 1 - i / 10, i) for u in range(40) for i in range(1, 9)])
    recs = S.assign_slots(df, "2024-01-15").collect()
    assert len(recs) == 40
    for r in recs:
        slots = [s["timeslot"] for s in r["schedule"]]
        assert len(slots) == 5 == len(set(slots)) and all(0 <= s <= 23 for s in slots)
        assert [s["campaign_id"] for s in r["schedule"]] == ["C1", "C2", "C3", "C4", "C5"]
    assert len({tuple(s["timeslot"] for s in r["schedule"]) for r in recs}) > 30
    again = S.assign_slots(df, "2024-01-15").collect()
    assert sorted(map(str, again)) == sorted(map(str, recs))


@pytest.mark.parametrize("start,end,quiet", [("22:00", "08:00", {22, 23, *range(8)}), ("01:00", "06:00", set(range(1, 6))),
                                             ("12:00", "13:30", {12, 13}), ("09:00", "09:00", set())])
def test_quiet_hours(spark, start, end, quiet):
    got = spark.range(24).filter(S.is_quiet(F.col("id"), F.lit(start), F.lit(end))).collect()
    assert {r["id"] for r in got} == quiet


def rules(spark, rows):
    return spark.createDataFrame(rows, "user_id long, max_notifications_per_day int, quiet_start string, quiet_end string, "
                                       "preferred_times array<string>, blackout_dates array<date>")


def live(spark):
    d = dt.date
    return spark.createDataFrame([(f"C{i}", 3 + i % 3, d(2024, 1, 1), d(2024, 1, 31)) for i in range(1, 8)]
                                 + [("OLD", 5, d(2023, 1, 1), d(2023, 2, 1))],
                                 "campaign_id string, priority int, start_date date, end_date date")


def test_plan(spark):
    day = dt.date(2024, 1, 5)
    rows = [(u, f"C{i}", round(1 - i / 10, 2), i) for u in (1, 2, 3, 4) for i in range(1, 8)] + [(1, "OLD", 0.99, 8)]
    cons = rules(spark, [(1, 3, "22:00", "08:00", ["19:00", "09:00", "23:00"], None), (2, 5, "00:00", "22:00", None, None),
                         (3, 5, "22:00", "08:00", None, [day]), (4, 9, "22:00", "08:00", None, None)])
    got = {}
    for r in S.plan_schedule(ranked(spark, rows), cons, live(spark), "2024-01-05").orderBy("user_id", "sequence").collect():
        got.setdefault(r["user_id"], []).append(r)
    # Highest priority first (C2 and C5 have 5), then score; preferred hours in order, the quiet one left out.
    assert {r["campaign_id"]: r["timeslot"] for r in got[1] if r["timeslot"] in (9, 19)} == {"C2": 9, "C5": 19}
    assert len(got[1]) == 3 and [r["sequence"] for r in got[1]] == [1, 2, 3]
    assert [r["timeslot"] for r in got[2]] == [22, 23]  # only two hours are free
    assert 3 not in got and 4 not in got  # blackout; invalid limit
    assert got[1][0]["scheduled_time"] == dt.datetime(2024, 1, 5, got[1][0]["timeslot"])
    everyone = [r for rs in got.values() for r in rs]
    assert all(r["notification_status"] == "pending" for r in everyone)


def test_constraint_errors(spark):
    cons = rules(spark, [(1, 5, "22:00", "08:00", None, None), (2, 6, "22:00", "08:00", None, None), (3, 0, "22:00", "08:00", None, None),
                         (4, 2, "25:00", "08:00", None, None), (5, 2, None, "08:00", None, None), (6, 2, "22:00", "08:00", None, None)])
    asked = spark.createDataFrame([(1, 5), (6, 3)], "user_id long, n_campaigns long")
    got = {r["user_id"]: r["error_code"] for r in S.constraint_error(cons, asked).collect()}
    assert got == {1: None, 2: "INVALID_CONSTRAINTS", 3: "INVALID_CONSTRAINTS", 4: "INVALID_CONSTRAINTS",
                   5: "INVALID_CONSTRAINTS", 6: "MAX_NOTIFICATIONS_EXCEEDED"}


def test_rule_rows_and_ids(spark):
    plan = spark.createDataFrame([(1, "C1", 1, dt.datetime(2024, 7, 5, 9))], "user_id long, campaign_id string, sequence long, scheduled_time timestamp")
    zones = spark.createDataFrame([(1, "America/New_York")], "user_id long, timezone string")
    r = S.delivery_rules(plan, zones).first()
    assert r["rule_name"] == "notify-1-C1-seq1" and r["schedule_expression"] == "at(2024-07-05T05:00:00)"
    assert S.delivery_rules(plan).first()["schedule_expression"] == "at(2024-07-05T09:00:00)"
    assert S.notification_id(plan).first()["notification_id"] == S.notification_id(plan).first()["notification_id"]


def test_attribution_matches_brute_force(spark):
    rnd = random.Random(4)
    sent = [(i, 1 if i % 3 == 0 else rnd.randrange(5), T0 + dt.timedelta(minutes=rnd.randrange(4000))) for i in range(150)]
    hits = [(1000 + i, 1 if i % 3 == 0 else rnd.randrange(5), T0 + dt.timedelta(minutes=rnd.randrange(4000))) for i in range(150)]
    hits += [(2000, 2, sent[1][2]), (2001, sent[1][1], sent[1][2]), (1999, sent[1][1], sent[1][2])]
    d = spark.createDataFrame(sent, "notification_id long, user_id long, sent_at timestamp")
    c = spark.createDataFrame(hits, "click_id long, user_id long, click_ts timestamp")
    got = {r["notification_id"]: r["click_id"] for r in D.attribute_clicks(d, c, 3600).collect()}
    want = {}
    for n, u, at in sent:
        ok = sorted((t, k) for k, v, t in hits if v == u and at <= t <= at + dt.timedelta(hours=1))
        want[n] = ok[0][1] if ok else None
    assert got == want


def brute_dedup(rows, seconds):
    kept, last = set(), {}
    for i, key, at in sorted(rows, key=lambda r: (r[2], r[0])):
        if key not in last or (at - last[key]).total_seconds() >= seconds:
            kept.add(i)
            last[key] = at
    return kept


def test_dedup_keeps_first_and_third(spark):
    rows = [(1, "n", T0), (2, "n", T0 + dt.timedelta(hours=23)), (3, "n", T0 + dt.timedelta(hours=25))]
    df = spark.createDataFrame(rows, "id long, key string, at timestamp")
    assert {r["id"] for r in D.dedup_within(df, "key", "at", "id").collect()} == {1, 3}


@pytest.mark.parametrize("spread", [200, 20_000])
def test_dedup_matches_brute_force(spark, spread):
    rnd = random.Random(spread)
    rows = [(i, "hot" if i % 3 == 0 else f"k{rnd.randrange(6)}", T0 + dt.timedelta(minutes=rnd.randrange(spread))) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, key string, at timestamp")
    got = {r["id"] for r in D.dedup_within(df, "key", "at", "id", 3600).collect()}
    assert got == brute_dedup(rows, 3600)


def alerts(spark, rows):
    return spark.createDataFrame([(u, T0 + dt.timedelta(seconds=s), x, T0 + dt.timedelta(seconds=b)) for u, s, x, b in rows],
                                 "user_id long, ts timestamp, text string, session_start timestamp")


def test_throttle_example(spark):
    df = alerts(spark, [(1, 10, "A", 0), (1, 45, "A", 0), (1, 90, "B", 0), (1, 100, "C", 0), (1, 500, "", 0), (1, 600, "A", 0)])
    got = [(r["text"], (r["ts"] - T0).seconds) for r in D.throttle(df).orderBy("ts").collect()]
    assert got == [("A", 45), ("B", 90)]


def test_throttle_matches_fold_per_session(spark):
    rnd = random.Random(9)
    rows = [(1 if i % 3 == 0 else rnd.randrange(4), rnd.randrange(3000), rnd.choice("ABCDEFGH"), 0) for i in range(300)]
    rows = [(u, s, x, s // 1000 * 1000) for u, s, x, _ in rows]
    want, state = set(), {}
    for u, s, x, b in sorted(set(rows), key=lambda r: (r[0], r[3], r[1], r[2])):
        last, shown = state.get((u, b), (b, set()))
        if s - last >= 40 and x not in shown:
            want.add((u, s, x))
            state[(u, b)] = (s, shown | {x})
    got = {(r["user_id"], int((r["ts"] - T0).total_seconds()), r["text"]) for r in D.throttle(alerts(spark, rows)).collect()}
    assert got == want


def test_log_and_metrics(spark):
    rows = [(1, "A", T0, T0 + dt.timedelta(seconds=3), False, T0 + dt.timedelta(seconds=60)), (2, "A", T0, T0 + dt.timedelta(seconds=30), False, None),
            (3, "B", T0, T0, True, None), (4, "B", T0, None, False, None)]
    df = spark.createDataFrame(rows, "user_id long, campaign_id string, scheduled_time timestamp, sent_at timestamp, failed boolean, click_ts timestamp")
    log = D.delivery_log(df)
    assert [r["notification_status"] for r in log.orderBy("user_id").collect()] == ["clicked", "sent", "failed", "pending"]
    assert M.on_time_rate(df, 10).first()["on_time_rate"] == 0.5
    rate = M.status_rates(log, ["campaign_id"]).orderBy("campaign_id").collect()
    assert (rate[0]["success_rate"], rate[1]["failure_rate"], rate[1]["pending_rate"]) == (1.0, 0.5, 0.5)
    assert M.ctr(df).filter("campaign_id = 'A'").first()["ctr"] == 0.5
    v = M.daily_volume(spark.createDataFrame([(1, T0)] * 6 + [(2, T0)], "user_id long, sent_at timestamp")).first()
    assert (v["notifications"], v["users"], v["users_over_limit"]) == (7, 2, 1)


def test_active_users_are_close(spark):
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("user_id"), F.lit(T0).alias("ts"))
    n = M.active_users(df, "1 day").first()["active_users"]
    assert abs(n - 20_000) / 20_000 <= 0.05


@pytest.mark.parametrize("long_run", [0, 50])
def test_long_runs_are_followed_by_pointers(spark, long_run):
    """A third of all rows in one run without a pause; the rows kept are those of the fold."""
    import numpy as np

    rng = np.random.default_rng(6)
    rows = [(i, "hot", int(t)) for i, t in enumerate(np.cumsum(rng.integers(1, 4000, 700)))]
    rows += [(1000 + i, str(rng.choice(["a", "b", "c"])), int(rng.integers(0, 40 * 86400))) for i in range(1300)]
    rows += [(5000, "hot", rows[10][2]), (5001, "hot", rows[0][2] + 3600), (5002, None, 5), (5003, None, 6)]
    df = spark.createDataFrame(rows, "id long, key string, s long").withColumn("at", F.timestamp_seconds("s")).drop("s")
    want, last = set(), {}
    for i, key, s in sorted(rows, key=lambda r: (r[2], r[0])):
        if key not in last or s >= last[key] + 3600:
            last[key] = s
            want.add(i)
    assert {r["id"] for r in D.dedup_within(df, "key", "at", "id", 3600, long_run=long_run).collect()} == want
    assert {r["id"] for r in D.dedup_within(df, "key", "at", "id", 3600).collect()} == want


def test_minute_sketches_merge_to_the_direct_one(spark, tmp_path):
    rows = spark.range(40_000).select((F.col("id") % 9000).alias("user_id"), F.timestamp_seconds(F.col("id") * 2).alias("ts"),
                                      ((F.col("id") * 7919) % 40_000).cast("double").alias("value"), F.lit("a").alias("kind"))
    rows = rows.unionByName(spark.createDataFrame([(None, T0, None, "b"), (1, None, 1.0, "b")], "user_id long, ts timestamp, value double, kind string"))
    path = str(tmp_path / "s")
    for batch in (0, 1, 1):  # the second batch is replayed
        M.store_sketches(M.minute_sketches(rows.where(F.pmod(F.hash("user_id"), F.lit(2)) == batch), "value", ["kind"]), path, batch)
    stored = spark.read.parquet(path)
    day = M.sketched(M.merged_sketches(M.merged_sketches(stored, "1 hour", ["kind"]), "1 day", ["kind"])).collect()
    direct = rows.where("kind = 'a'").agg(F.hll_sketch_estimate(F.hll_sketch_agg("user_id", 14)).alias("u")).first()["u"]
    got = {r["kind"]: r for r in day}
    assert got["a"]["n"] == 40_000 and abs(got["a"]["active_users"] / direct - 1) < 0.02 and abs(got["a"]["active_users"] / 9000 - 1) < 0.05
    assert abs(got["a"]["p95"] / 38_000 - 1) < 0.01 and abs(got["a"]["p99"] / 39_600 - 1) < 0.01
    assert sum(r["n"] for r in day if r["kind"] == "b") == 1 and [r["p95"] for r in day if r["kind"] == "b"] == [None]
