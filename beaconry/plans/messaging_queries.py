"""Queries for embeddings, recommendation, scheduling, streams and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.functions import vectors as V
from beaconry.functions.columns import rounded_small
from beaconry.operators import campaigns as K
from beaconry.operators import collaborative as CF
from beaconry.operators import delivery, embed, metrics, neighbours, schedule, vector_index
from beaconry.operators import pairs as P
from beaconry.plans.bindings import CART_KINDS, CLICK_AS_OF, DIM, LAST_K, Tables
from beaconry.plans.feature_queries import LAST_PER_ID, USER_VECTOR, WEIGHTED, attributed, records, rounded, vector_facts
from beaconry.plans.registry import query
from beaconry.plans.table_queries import INGESTED, click_messages
from beaconry.session import cut, scratch_path
from beaconry.sources import messages
from beaconry.streaming import clicks as S

DAY = 86400

# -- embeddings ----------------------------------------------------------------------

WORDS = """SELECT {k}, bucket, round(n / sqrt(sum(n * n) OVER (PARTITION BY {k})), 8) AS weight FROM (SELECT {k},
    CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS bucket, count(*) AS n FROM (SELECT {k},
    unnest(string_split_regex(lower({text}), '\\s+')) AS w FROM {src}) WHERE w <> '' GROUP BY 1, 2)"""


def weights(df, key):
    """Non-zero entries of the vectors, one row each."""
    return df.select(key, F.posexplode("embedding").alias("bucket", "weight")).filter("weight <> 0").select(
        key, F.col("bucket").cast("bigint").alias("bucket"), F.round("weight", 8).alias("weight"))


PRODUCT_TEXT = """product_display_name || ' ' || master_category || ' ' || '' || ' ' || article_type || ' ' || '' || ' '"""


@query("emb_product", WORDS.format(k="product_id", text=PRODUCT_TEXT, src="products_v"))
def emb_product(t):
    return weights(embed.embed_text(t.products, embed.PRODUCT_TEXT, DIM), "product_id")


@query("emb_campaign", WORDS.format(
    k="campaign_id", text="name || ' ' || template_long || ' ' || status || ' ' || priority || ' ' || notification_type",
    src="campaigns_v"))
def emb_campaign(t):
    """The whole campaign text stands for its description."""
    df = t.campaigns.withColumn("description", F.col("template_long"))
    return weights(embed.embed_text(df, embed.CAMPAIGN_TEXT, DIM), "campaign_id")


@query("emb_purchase", f"""SELECT purchase_id, user_id, CAST(64 AS BIGINT) AS dim, round({WEIGHTED.format(e='embedding')}, 6) AS weighted,
    round(sqrt(list_dot_product(embedding, embedding)), 6) AS norm FROM ({LAST_PER_ID}) JOIN product_vectors_v USING (product_id)""")
def emb_purchase(t):
    return vector_facts(embed.purchase_embeddings(t.purchases, t.product_vectors, DIM), "purchase_id", "user_id")


@query("emb_delta", WORDS.format(k="product_id", text=PRODUCT_TEXT, src="products_v"))
def emb_delta(t):
    """Stored vectors are of an older catalogue: some types renamed, the dearest items missing."""
    old = t.products.filter("price < 1500").withColumn("master_category", F.when(
        F.col("article_type") == "Brand#1", F.lit("OLD")).otherwise(F.col("master_category")))
    stored = embed.embed_text(embed.content_hash(old, embed.PRODUCT_TEXT), embed.PRODUCT_TEXT, DIM)
    return weights(embed.delta_embeddings(stored, t.products, "product_id", embed.PRODUCT_TEXT, DIM), "product_id")


@query("emb_delta_users", USER_VECTOR.format(j="LEFT"))
def emb_delta_users(t):
    """User vectors after new purchases and changed product vectors equal a full recomputation, from the stored state of the last purchases."""
    # Both sides of the cut are read from one pass over the purchases, with the columns that vectors depend on.
    path = scratch_path(t.spark, "bought")
    t.purchases.select(*embed.VECTOR_COLS).write.parquet(path)
    bought = t.spark.read.parquet(path)
    old = bought.filter("purchase_date < DATE '2001-01-01'")
    new = bought.filter("purchase_date >= DATE '2001-01-01'")
    changed = t.products.filter("article_type = 'Brand#1'").select("product_id")
    zeroed = t.product_vectors.join(changed.withColumn("_c", F.lit(True)), "product_id", "left").select(
        "product_id", F.when(F.col("_c"), F.transform("embedding", lambda x: (x * 0).cast("float"))).otherwise(F.col("embedding")).alias("embedding"))
    path = scratch_path(t.spark, "recent")
    embed.recent_state(old, LAST_K).write.parquet(path)
    state = t.spark.read.parquet(path)
    stored = embed.user_embeddings(t.users, state, zeroed, LAST_K, DIM)
    out, _ = embed.refresh_from_state(stored, state, t.users, new, t.product_vectors, changed, LAST_K, DIM)
    return vector_facts(out, "user_id")


# -- recommendation ------------------------------------------------------------------

RANKED_COLS = ["user_id", "campaign_id", "similarity_score", "rank"]


@query("rec_cosine", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(list_dot_product(p.embedding, s.embedding) / (sqrt(list_dot_product(p.embedding, p.embedding))
    * sqrt(list_dot_product(s.embedding, s.embedding))), 4) AS similarity FROM lineitem JOIN product_vectors_v p ON p.product_id = l_partkey
    JOIN product_vectors_v s ON s.product_id = l_suppkey""")
def rec_cosine(t):
    """Product vector of each line against the vector kept under its supplier's number."""
    # The length of a vector is taken once a product, not once a pair, and no vector travels with a line.
    lines = t.raw("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    vectors = t.product_vectors.withColumn("norm", V.magnitude("embedding"))
    p = vectors.withColumnRenamed("product_id", "l_partkey")
    s = P.named(vectors.withColumnRenamed("product_id", "l_suppkey"), lines, "l_suppkey")
    return P.dots(lines, p, s, "l_partkey", "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(V.cosine(product="product", norms="norms"), 4).alias("similarity"))


@query("rec_campaign_topk", "SELECT user_id, campaign_id, similarity_score, rank FROM ranked_v")
def rec_campaign_topk(t):
    return t.ranked.select(*RANKED_COLS)


@query("rec_campaign_topk_mean", """WITH m AS (SELECT user_id, i, sum(embedding[i]) / 5 AS x FROM user_blocks_v, (SELECT unnest(range(1, 65)) AS i) GROUP BY 1, 2),
    v AS (SELECT user_id, list(x ORDER BY i) AS e FROM m GROUP BY 1)
    SELECT user_id, campaign_id, similarity_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity_score DESC, campaign_id) AS rank
    FROM (SELECT u.user_id, campaign_id, CASE WHEN e IS NULL THEN 0 ELSE round(list_dot_product(e, c.embedding) / (sqrt(list_dot_product(e, e))
    * sqrt(list_dot_product(c.embedding, c.embedding))), 4) END AS similarity_score FROM users_v u CROSS JOIN campaign_vectors_v c
    LEFT JOIN v ON v.user_id = u.user_id)) WHERE rank <= 10""")
def rec_campaign_topk_mean(t):
    return K.campaign_topk(t.user_vectors, t.campaign_vectors, 10, dim_policy="mean", dim=DIM).select(*RANKED_COLS)


@query("rec_skip_no_vector", """SELECT user_id, campaign_id, similarity_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id
    ORDER BY similarity_score DESC, campaign_id) AS rank FROM scores_v JOIN campaigns_v USING (campaign_id) WHERE status = 'active') WHERE rank <= 10""")
def rec_skip_no_vector(t):
    """Paused campaigns lose their vector: empty, or none at all."""
    v = t.campaign_vectors.join(t.campaigns.select("campaign_id", "status", "priority"), "campaign_id")
    gone = F.when(F.col("priority") > 3, F.array().cast("array<float>"))
    v = v.withColumn("embedding", F.when(F.col("status") == "active", F.col("embedding")).otherwise(gone))
    return K.campaign_topk(t.user_vectors, v, 10).select(*RANKED_COLS)


def short_vectors(t):
    """User vectors cut to what a campaign can meet, computed once for the index and the ranking."""
    return cut(t.user_vectors.withColumn("embedding", K.first_block("embedding", DIM)))


def index_search(t, users):
    path, campaigns = scratch_path(t.spark, "index"), cut(t.campaign_vectors)
    vector_index.build_index(campaigns, users, path, DIM)
    return vector_index.search(users, campaigns, path, DIM)


@query("rec_ann")
def rec_ann(t):
    """Ranking from a stored vector index; every user has as many rows as the exact ranking gives it."""
    return index_search(t, short_vectors(t))


@query("rec_ann_complete", """SELECT user_id, least(10, (SELECT count(*) FROM campaign_vectors_v)) AS n_rows, true AS whole_ranks, true AS true_scores FROM users_v""")
def rec_ann_complete(t):
    """Per user of the index search: its rows, whether its ranks are without gaps, and whether all its scores are cosines of the exact table."""
    users = short_vectors(t)
    near = index_search(t, users)
    exact = K.campaign_topk(users, t.campaign_vectors, t.n_campaigns).select("user_id", "campaign_id", F.col("similarity_score").alias("exact"))
    return near.join(exact, ["user_id", "campaign_id"], "left").groupBy("user_id").agg(
        F.count("*").alias("n_rows"), (F.max("rank") == F.count("*")).alias("whole_ranks"), F.bool_and(F.coalesce(F.col("similarity_score") == F.col("exact"), F.lit(False))).alias("true_scores"))


@query("rec_user_similarity", """SELECT user_id, neighbour, shared, round(similarity, 8) AS similarity, row_number() OVER (PARTITION BY user_id
    ORDER BY CAST(shared * shared AS DOUBLE) / n_v DESC, neighbour) AS rank FROM pairs_v""")
def rec_user_similarity(t):
    """The user-user matrix: every two users that share an item, not only the closest ones."""
    return neighbours.neighbours(t.interactions, k=None).withColumn("similarity", rounded_small("similarity", 8))


@query("rec_cf", "SELECT user_id, item_id, score, rank FROM cf_topn_v")
def rec_cf(t):
    return CF.cf_topn(t.interactions, t.items)


@query("rec_records", f"""SELECT user_id, '{CLICK_AS_OF}T00:00:00' AS timestamp, string_agg(item_id, ',' ORDER BY rank) AS ads, CAST(100 AS BIGINT) AS entries,
    count(*) AS num_recommendations, any_value(s.n) AS num_previously_seen, CAST(epoch(TIMESTAMP '{CLICK_AS_OF} 00:00:00') AS BIGINT) + 604800 AS ttl
    FROM cf_topn_v JOIN sizes_v s USING (user_id) GROUP BY 1""")
def rec_records(t):
    ads = F.concat_ws(",", F.transform("ads", lambda x: x.cast("string")))
    return records(t).withColumns({"entries": F.size("ads").cast("bigint"), "ads": ads})


@query("rec_validate", """SELECT CAST(user_id AS VARCHAR) AS user_id, 'duplicate items' AS issue FROM cf_topn_v WHERE rank = 1
    UNION ALL SELECT CAST(user_id AS VARCHAR), '1 items already seen' FROM sizes_v""")
def rec_validate(t):
    """Records spoiled on purpose: the first item is repeated, and the user's lowest seen item is put in."""
    lowest = t.interactions.groupBy("user_id").agg(F.min("item_id").alias("low"))
    spoiled = records(t).join(lowest, "user_id").withColumn("ads", F.concat("ads", F.array(F.col("ads")[0], F.col("low"))))
    return CF.validate_recommendations(spoiled, t.interactions)


@query("rec_validate_clean", """SELECT count(*) AS n_records, CAST(0 AS BIGINT) AS n_issues FROM sizes_v""")
def rec_validate_clean(t):
    """Unspoiled records show no issue."""
    r = records(t)
    issues = CF.validate_recommendations(r, t.interactions).select("user_id", F.lit(1).alias("issue"))
    all_rows = r.select(F.col("user_id").cast("string").alias("user_id"), F.lit(0).alias("issue")).unionByName(issues)
    return all_rows.agg(F.count(F.when(F.col("issue") == 0, 1)).alias("n_records"), F.coalesce(F.sum("issue"), F.lit(0)).alias("n_issues"))


@query("rec_filters", """SELECT request_id, user_id, rank, campaign_id, similarity_score, campaign_name, priority, estimated_ctr, time_window_start, time_window_end FROM (SELECT r.request_id, r.user_id,
    row_number() OVER (PARTITION BY request_id ORDER BY similarity_score DESC, s.campaign_id) AS rank, s.campaign_id, similarity_score, c.name AS campaign_name,
    CASE WHEN c.priority < 4 THEN 'low' WHEN c.priority = 4 THEN 'medium' ELSE 'high' END AS priority, round(ctr, 6) AS estimated_ctr,
    strftime(start_date, '%Y-%m-%dT00:00:00Z') AS time_window_start, strftime(end_date, '%Y-%m-%dT23:59:59Z') AS time_window_end,
    least(coalesce(num_recommendations, 10), 20) AS wanted FROM requests_v r JOIN scores_v s ON s.user_id = r.user_id JOIN campaigns_v c ON c.campaign_id = s.campaign_id
    LEFT JOIN (SELECT campaign_id, avg((click_ts IS NOT NULL)::INT) AS ctr FROM attributed_v GROUP BY 1) x ON x.campaign_id = s.campaign_id
    WHERE (window_end IS NULL OR start_date <= window_end) AND (window_start IS NULL OR window_start <= end_date)
    AND NOT list_contains(exclude_campaign_ids, s.campaign_id)) WHERE rank <= wanted""")
def rec_filters(t):
    rates = rounded(metrics.ctr(attributed(t)), ctr=6)
    return K.serve_requests(t.requests, t.user_vectors, t.campaigns, t.campaign_vectors, rates).drop("start_date", "end_date")


@query("rec_feedback", """SELECT user_id, item_id FROM interactions_v UNION SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT)
    FROM events WHERE event_type = 'click' AND event_id IN (SELECT click_id FROM attributed_v) UNION SELECT user_id, product_id FROM clicks_v WHERE event_type = 'purchase'""")
def rec_feedback(t):
    """Attributed clicks and purchases flow back into the interactions."""
    hit = attributed(t).filter("click_id IS NOT NULL").select("user_id", F.col("click_id").alias("event_id")).distinct()
    clicked = t.clicks.join(hit, ["user_id", "event_id"], "left_semi")
    bought = t.clicks.filter("event_type = 'purchase'")
    back = clicked.unionByName(bought).select("user_id", F.col("product_id").alias("item_id"))
    return CF.feedback_interactions(neighbours.interactions(t.clicks, CART_KINDS), back)


# -- scheduling and delivery ---------------------------------------------------------

@query("sch_slots", f"""SELECT user_id, DATE '{CLICK_AS_OF}' AS date, campaign_id, timeslot, similarity_score AS score FROM ranked_v JOIN
    (SELECT user_id, slot AS timeslot, row_number() OVER (PARTITION BY user_id ORDER BY h, slot) AS rank FROM slot_hash_v) USING (user_id, rank)
    WHERE rank <= 5""")
def sch_slots(t):
    return schedule.assign_slots(t.ranked, CLICK_AS_OF).select(
        "user_id", "date", F.explode("schedule").alias("s")).select("user_id", "date", "s.campaign_id", "s.timeslot", "s.score")


PLAN_DAY = "2024-01-05"


def plan(t):
    return schedule.plan_schedule(t.ranked_on(PLAN_DAY), t.constraints, t.campaigns, PLAN_DAY)


@query("sch_plan", """SELECT user_id, schedule_date, sequence, campaign_id, priority, similarity_score, timeslot,
    strftime(schedule_date + to_hours(timeslot), '%Y-%m-%dT%H:%M:%S') AS scheduled_time, 'pending' AS notification_status FROM plan_v""")
def sch_plan(t):
    return plan(t).withColumn("scheduled_time", F.date_format("scheduled_time", "yyyy-MM-dd'T'HH:mm:ss"))


@query("win_sequence", "SELECT user_id, sequence, timeslot FROM plan_v")
def win_sequence(t):
    return plan(t).select("user_id", "sequence", "timeslot")


@query("sch_validate", """SELECT c.user_id, CASE WHEN max_notifications_per_day > 5 THEN 'INVALID_CONSTRAINTS'
    WHEN n > max_notifications_per_day THEN 'MAX_NOTIFICATIONS_EXCEEDED' END AS error_code,
    CASE WHEN max_notifications_per_day > 5 OR n > max_notifications_per_day THEN 'error' ELSE 'success' END AS status
    FROM constraints_v c LEFT JOIN (SELECT user_id, count(*) AS n FROM ranked_v WHERE similarity_score > 0.2 GROUP BY 1) k USING (user_id)""")
def sch_validate(t):
    """Users ask for every campaign scoring above 0.2."""
    asked = t.ranked.filter("similarity_score > 0.2").groupBy("user_id").agg(F.count("*").alias("n_campaigns"))
    return schedule.constraint_error(t.constraints, asked).select("user_id", "error_code", "status")


@query("sch_score", """SELECT user_id, schedule_date, count(*) AS total_scheduled, round(avg(least(greatest(similarity_score, 0), 1)) + 1e-9, 6) AS optimization_score
    FROM plan_v GROUP BY 1, 2""")
def sch_score(t):
    out = schedule.schedule_score(plan(t))
    return out.withColumn("optimization_score", F.round(F.col("optimization_score") + 1e-9, 6))


@query("sch_rule_rows", """SELECT user_id, campaign_id, sequence, 'notify-' || user_id || '-' || campaign_id || '-seq' || sequence AS rule_name,
    'at(' || strftime(schedule_date + to_hours(timeslot) + CASE user_id % 3 WHEN 0 THEN INTERVAL 9 HOUR WHEN 1 THEN INTERVAL (-5) HOUR ELSE INTERVAL 0 HOUR END, '%Y-%m-%dT%H:%M:%S') || ')' AS schedule_expression,
    CASE user_id % 3 WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'America/New_York' ELSE 'UTC' END AS timezone, 'ENABLED' AS state FROM plan_v""")
def sch_rule_rows(t):
    zones = t.users.selectExpr("user_id", "CASE user_id % 3 WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'America/New_York' END AS timezone")
    return schedule.delivery_rules(plan(t), zones)


@query("sch_due", """SELECT user_id, campaign_id, sequence FROM plan_v WHERE timeslot = 14""")
def sch_due(t):
    return schedule.due_notifications(plan(t), f"{PLAN_DAY} 14:00:30").select("user_id", "campaign_id", "sequence")


STATUS = "CASE WHEN failed THEN 'failed' WHEN click_ts IS NOT NULL THEN 'clicked' WHEN sent_at IS NOT NULL THEN 'sent' ELSE 'pending' END"


@query("sch_log", f"""SELECT notification_id, user_id, {STATUS} AS notification_status, CASE WHEN NOT failed THEN epoch_us(sent_at) END AS delivery_us,
    CASE WHEN NOT failed THEN epoch_us(click_ts) END AS click_us FROM attributed_v""")
def sch_log(t):
    return delivery.delivery_log(attributed(t)).select(
        "notification_id", "user_id", "notification_status", F.unix_micros("delivery_time").alias("delivery_us"),
        F.unix_micros("click_time").alias("click_us"))


@query("sch_notif_id", """SELECT user_id, campaign_id, sha256(user_id || '~' || campaign_id || '~' || strftime(schedule_date + to_hours(timeslot), '%Y-%m-%dT%H:%M:%S'))
    AS notification_id FROM plan_v""")
def sch_notif_id(t):
    return schedule.notification_id(plan(t)).select("user_id", "campaign_id", "notification_id")


# The kept rows of each key follow one another: the next is the first at least a day later.
@query("sch_dedup_24h", """WITH RECURSIVE e AS (SELECT event_id, user_id || '/' || event_type AS notification, ts FROM events),
    kept AS (SELECT notification, min(ts) AS ts FROM e GROUP BY 1 UNION ALL SELECT k.notification, (SELECT min(e.ts) FROM e
    WHERE e.notification = k.notification AND e.ts >= k.ts + INTERVAL 24 HOUR) FROM kept k WHERE k.ts IS NOT NULL)
    SELECT min(event_id) AS event_id, notification FROM kept JOIN e USING (notification, ts) GROUP BY notification, ts""")
def sch_dedup_24h(t):
    e = t.raw("events").select("event_id", F.concat_ws("/", "user_id", "event_type").alias("notification"), "ts")
    return delivery.dedup_within(e, "notification", "ts", "event_id").select("event_id", "notification")


# -- streams -------------------------------------------------------------------------

def stream_of(t: Tables):
    return S.read_event_files(t.spark, t.root)


@query("st_ingest", INGESTED)
def st_ingest(t):
    """Messages, every one delivered twice, end up once in the flat table."""
    topic, target, bad = (scratch_path(t.spark, n) for n in ("topic", "clicks", "bad"))
    msgs = click_messages(t)
    msgs.unionByName(msgs).write.text(topic)
    S.ingest_clicks(messages.read_clicks(t.spark, {"path": topic}), target, bad, scratch_path(t.spark, "ckpt")).awaitTermination()
    return S.read_ingested(t.spark, target).drop("id")


@query("st_poll", INGESTED)
def st_poll(t):
    """The same table from a source polled every ten seconds."""
    topic, target, bad = (scratch_path(t.spark, n) for n in ("topic", "clicks", "bad"))
    click_messages(t).write.text(topic)
    q = S.ingest_clicks(messages.read_clicks(t.spark, {"path": topic}), target, bad, scratch_path(t.spark, "ckpt"), once=False)
    q.processAllAvailable()
    q.stop()
    return S.read_ingested(t.spark, target).drop("id")


@query("st_bad_records", "SELECT event_type, count(*) AS n_quarantined FROM clicks_v WHERE price % 5 < 2 GROUP BY 1")
def st_bad_records(t):
    """A price in words or a cut-off message goes to quarantine instead of stopping the stream."""
    topic, target, bad = (scratch_path(t.spark, n) for n in ("topic", "clicks", "bad"))
    words = F.when(F.col("price") % 5 == 0, F.lit("free")).otherwise(F.col("price").cast("string"))
    value = F.to_json(F.struct(F.col("event_type").alias("event"), words.alias("price"), "product_id",
                               F.col("event_id").cast("string").alias("timestamp")))
    cut = F.when(F.col("price") % 5 == 1, F.expr("left(value, length(value) - 5)")).otherwise(F.col("value"))
    t.clicks.withColumn("value", value).select(cut.alias("value")).write.text(topic)
    S.ingest_clicks(messages.read_clicks(t.spark, {"path": topic}), target, bad, scratch_path(t.spark, "ckpt")).awaitTermination()
    kind = F.regexp_extract("raw", '"event":"([a-z_]+)"', 1).alias("event_type")
    return t.spark.read.parquet(bad).select(kind).groupBy("event_type").agg(F.count("*").alias("n_quarantined"))


@query("st_dedup", "SELECT user_id, event_type, epoch_us(min(ts)) AS first_us FROM events GROUP BY 1, 2")
def st_dedup(t):
    """First event per user and type; the window spans the data, so late repeats are dropped too."""
    rows = stream_of(t).select("ts", "user_id", "event_type")
    out = S.run_to_table(S.dedup_stream(rows, ["user_id", "event_type"], window="40 days"), scratch_path(t.spark, "dedup"),
                         scratch_path(t.spark, "ckpt"))
    return out.select("user_id", "event_type", F.unix_micros("ts").alias("first_us"))


RATES = "SELECT CAST(epoch(time_bucket(INTERVAL {w}, ts)) AS BIGINT) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2"


@query("st_rates", RATES.format(w="1 HOUR"))
def st_rates(t):
    """Each micro-batch changes only the windows it has rows of; rows a day behind are counted and listed apart."""
    rates, late = scratch_path(t.spark, "rates"), scratch_path(t.spark, "late")
    S.count_with_late(stream_of(t).select("ts", "event_type"), rates, late, scratch_path(t.spark, "ckpt"), "1 hour", 86400).awaitTermination()
    return S.read_rates(t.spark, rates).withColumn("window_start", F.unix_timestamp("window_start"))


@query("st_rates_batch", RATES.format(w="1 MINUTE"))
def st_rates_batch(t):
    return S.event_rates(t.raw("events"), "1 minute").withColumn("window_start", F.unix_timestamp("window_start"))


@query("st_rates_sliding", """SELECT CAST(epoch(time_bucket(INTERVAL 15 MINUTE, ts)) AS BIGINT) - 900 * i AS window_start, event_type, count(*) AS n
    FROM events CROSS JOIN (SELECT unnest(range(4)) AS i) GROUP BY 1, 2""")
def st_rates_sliding(t):
    return S.event_rates(t.raw("events"), "1 hour", "15 minutes").withColumn("window_start", F.unix_timestamp("window_start"))


@query("st_sessions", """SELECT user_id, CAST(epoch_us(min(ts)) AS BIGINT) AS session_start_us, CAST(epoch_us(max(ts)) + 21600000000 AS BIGINT) AS session_end_us,
    count(*) AS events, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'add_to_cart') AS adds,
    coalesce(sum(price) FILTER (event_type = 'add_to_cart'), 0)::BIGINT AS value FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM
    (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM clicks_v)) GROUP BY user_id, s""")
def st_sessions(t):
    out = S.user_sessions(t.clicks, "6 hours")
    return out.withColumns({"session_start_us": F.unix_micros("session_start"), "session_end_us": F.unix_micros("session_end")}).drop(
        "session_start", "session_end")


def alerts(df):
    """Events as alert texts; a user's day is one session."""
    return df.select("event_id", "user_id", "ts", F.col("event_type").alias("text"),
                     F.date_trunc("day", F.col("ts").cast("timestamp")).alias("session_start"))


# A gap of two hours, since the events of a user are hours apart.
ALERT_GAP = 2 * 3600
THROTTLED = """WITH RECURSIVE n AS (SELECT event_id, user_id, ts, event_type AS text, date_trunc('day', ts) AS day,
    row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_type) AS i FROM events),
    f AS (SELECT event_id, user_id, day, i, ts >= day + INTERVAL 2 HOUR AS shown, CASE WHEN ts >= day + INTERVAL 2 HOUR THEN ts ELSE day END AS last,
    CASE WHEN ts >= day + INTERVAL 2 HOUR THEN [text] ELSE []::VARCHAR[] END AS seen FROM n WHERE i = 1
    UNION ALL SELECT n.event_id, n.user_id, n.day, n.i, n.ts >= f.last + INTERVAL 2 HOUR AND NOT list_contains(f.seen, n.text),
    CASE WHEN n.ts >= f.last + INTERVAL 2 HOUR AND NOT list_contains(f.seen, n.text) THEN n.ts ELSE f.last END,
    CASE WHEN n.ts >= f.last + INTERVAL 2 HOUR AND NOT list_contains(f.seen, n.text) THEN list_append(f.seen, n.text) ELSE f.seen END
    FROM f JOIN n ON n.user_id = f.user_id AND n.day = f.day AND n.i = f.i + 1) SELECT event_id, user_id FROM f WHERE shown"""


@query("st_throttle", THROTTLED)
def st_throttle(t):
    return delivery.throttle(alerts(t.raw("events")), min_gap_seconds=ALERT_GAP).select("event_id", "user_id")


@query("st_throttle_stream", THROTTLED)
def st_throttle_stream(t):
    """Same alerts from the stateful stream."""
    out = S.throttle_stream(alerts(stream_of(t)), min_gap_seconds=ALERT_GAP)
    return S.run_to_table(out, scratch_path(t.spark, "alerts"), scratch_path(t.spark, "ckpt")).select("event_id", "user_id")


@query("st_due", "SELECT user_id, campaign_id, sequence FROM plan_v WHERE timeslot = 9")
def st_due(t):
    """The plan arrives as files; each micro-batch hands over what is due at 09:00."""
    src, out = scratch_path(t.spark, "plan"), scratch_path(t.spark, "due")
    plan(t).write.parquet(src)
    stream = t.spark.readStream.schema(t.spark.read.parquet(src).schema).parquet(src)

    def deliver(batch, batch_id):
        due = schedule.due_notifications(batch, f"{PLAN_DAY} 09:00:00").withColumn("batch_id", F.lit(batch_id))
        due.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    S.deliver_due(stream, deliver, scratch_path(t.spark, "ckpt"), once=True).awaitTermination()
    return t.spark.read.parquet(out).select("user_id", "campaign_id", "sequence")


def arrivals(events):
    """Arrival: the value column as seconds of delay."""
    lag = (F.col("value") * 1_000_000).cast("bigint")
    return events.withColumn("arrived_at", F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + lag))


@query("st_late", "SELECT event_type, count(*) FILTER (CAST(trunc(value * 1000000) AS BIGINT) <= 20000000) AS in_time, "
       "count(*) FILTER (CAST(trunc(value * 1000000) AS BIGINT) > 20000000) AS late FROM events GROUP BY 1")
def st_late(t):
    """The stream counts all events and lists those that arrived more than 20 seconds late."""
    rates, late = scratch_path(t.spark, "rates"), scratch_path(t.spark, "late")
    events = S.event_time(arrivals(stream_of(t)).select("event_id", "ts", "event_type", "arrived_at"))
    S.count_with_late(events, rates, late, scratch_path(t.spark, "ckpt"), "1 hour", 20, arrival="arrived_at").awaitTermination()
    listed = S.read_late(t.spark, late, events.schema).groupBy("event_type").agg(F.count("*").alias("late"))
    every = S.read_rates(t.spark, rates).groupBy("event_type").agg(F.sum("n").alias("n"))
    return every.join(listed, "event_type", "left").select("event_type", (F.col("n") - F.coalesce("late", F.lit(0))).alias("in_time"),
                                                         F.coalesce("late", F.lit(0)).alias("late"))


@query("st_late_batch", "SELECT event_type, count(*) FILTER (CAST(trunc(value * 1000000) AS BIGINT) <= 20000000) AS in_time, "
       "count(*) FILTER (CAST(trunc(value * 1000000) AS BIGINT) > 20000000) AS late FROM events GROUP BY 1")
def st_late_batch(t):
    ok, late = S.late_events(arrivals(t.raw("events")), 20)
    both = ok.withColumn("late", F.lit(0)).unionByName(late.withColumn("late", F.lit(1)))
    return both.groupBy("event_type").agg(F.count(F.when(F.col("late") == 0, 1)).alias("in_time"),
                                          F.count(F.when(F.col("late") == 1, 1)).alias("late"))


@query("st_attribution", "SELECT notification_id, click_id FROM attributed_v WHERE click_id IS NOT NULL")
def st_attribution(t):
    """Stream-stream join of deliveries and clicks, then the first click of each delivery."""
    raw = stream_of(t)
    sent = raw.filter("event_type = 'view'").select(F.col("event_id").alias("notification_id"), "user_id", F.col("ts").alias("sent_at"))
    hits = raw.filter("event_type = 'click'").select(F.col("event_id").alias("click_id"), "user_id", F.col("ts").alias("click_ts"))
    pairs = S.run_to_table(S.attribute_clicks_stream(sent, hits, "24 hours"), scratch_path(t.spark, "pairs"), scratch_path(t.spark, "ckpt"))
    return S.first_clicks(pairs).select("notification_id", "click_id")


# -- metrics -------------------------------------------------------------------------

@query("met_latency", """SELECT event_type, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY 1""")
def met_latency(t):
    return rounded(metrics.latency_percentiles(t.raw("events"), "value", ["event_type"]), p95=6, p99=6)


def stored_sketches(t):
    """Sketches per minute and type of two halves of the events, stored as two batches."""
    path = scratch_path(t.spark, "sketches")
    for batch in (0, 1):
        half = t.raw("events").where(F.pmod("event_id", F.lit(2)) == batch)
        metrics.store_sketches(metrics.minute_sketches(half, "value", ["event_type"]), path, batch)
    return t.spark.read.parquet(path)


@query("met_latency_approx")
def met_latency_approx(t):
    """From the stored sketches of all minutes."""
    merged = metrics.merged_sketches(metrics.merged_sketches(stored_sketches(t), "1 day", ["event_type"]), "3650 days", ["event_type"])
    return metrics.sketched(merged).select("event_type", "p95", "p99")


@query("met_sketches_close", """SELECT event_type, true AS users_close, true AS p95_close FROM events GROUP BY 1""")
def met_sketches_close(t):
    """Whether the merged sketches are near the exact numbers: users within 5 %, the rank of the 95th percentile within 1 %."""
    merged = metrics.merged_sketches(metrics.merged_sketches(stored_sketches(t), "1 day", ["event_type"]), "3650 days", ["event_type"])
    est = metrics.sketched(merged).select(F.col("event_type").alias("of"), "active_users", "p95")
    rows = t.raw("events").join(F.broadcast(est), F.col("event_type").eqNullSafe(F.col("of")))  # one row a type
    exact = rows.groupBy("event_type").agg(F.countDistinct("user_id").alias("users"), F.avg((F.col("value") <= F.col("p95")).cast("double")).alias("rank"),
                                           F.first("active_users").alias("active_users"))
    return exact.select("event_type", (F.abs(F.col("active_users") / F.col("users") - 1) <= 0.05).alias("users_close"),
                        (F.abs(F.col("rank") - 0.95) <= 0.01).alias("p95_close"))


@query("met_on_time", """SELECT count(*) AS n, round(avg((epoch_us(sent_at) - epoch_us(scheduled_time) <= 10000000)::INT), 8) AS on_time_rate FROM deliveries_v""")
def met_on_time(t):
    return rounded(metrics.on_time_rate(t.deliveries, 10), on_time_rate=8)


@query("met_success", f"""SELECT day, count(*) AS n, round(avg((s IN ('sent', 'clicked'))::INT) + 1e-9, 6) AS success_rate, round(avg((s = 'failed')::INT) + 1e-9, 6) AS failure_rate,
    round(avg((s = 'pending')::INT) + 1e-9, 6) AS pending_rate FROM (SELECT CAST(sent_at AS DATE) AS day, {STATUS} AS s FROM attributed_v) GROUP BY 1""")
def met_success(t):
    out = metrics.status_rates(delivery.delivery_log(attributed(t)).withColumn("day", F.to_date("sent_at")), ["day"])
    return out.withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in ("success_rate", "failure_rate", "pending_rate")})


@query("met_ctr", """SELECT campaign_id, count(*) AS deliveries, count(click_ts) AS clicks, round(count(click_ts) / count(*) + 1e-9, 6) AS ctr FROM attributed_v GROUP BY 1""")
def met_ctr(t):
    return metrics.ctr(attributed(t)).withColumn("ctr", F.round(F.col("ctr") + 1e-9, 6))


@query("met_dup_rate", """SELECT count(*) AS n_events, count(DISTINCT purchase_id) AS n_distinct, round(1 - count(DISTINCT purchase_id) / count(*), 8) AS duplicate_rate FROM purchases_v""")
def met_dup_rate(t):
    return rounded(metrics.duplicate_rate(t.purchases, ["purchase_id"]), duplicate_rate=8)


@query("met_daily_volume", """SELECT day, sum(n)::BIGINT AS notifications, count(*) AS users, count(*) FILTER (n > 2) AS users_over_limit FROM
    (SELECT CAST(sent_at AS DATE) AS day, user_id, count(*) AS n FROM deliveries_v GROUP BY 1, 2) GROUP BY 1""")
def met_daily_volume(t):
    return metrics.daily_volume(t.deliveries, limit=2)


@query("met_distinct_users")
def met_distinct_users(t):
    """Per day, merged from the stored sketches of its minutes."""
    return metrics.sketched(metrics.merged_sketches(stored_sketches(t), "1 day")).select("window_start", "active_users")


@query("met_embedding_coverage", """SELECT count(*) AS n, round(avg((user_id IN (SELECT user_id FROM user_blocks_v))::INT), 8) AS coverage FROM users_v""")
def met_embedding_coverage(t):
    return rounded(embed.vector_coverage(t.user_vectors), coverage=8)


@query("met_lag", """SELECT CAST(epoch(time_bucket(INTERVAL 1 HOUR, ts)) AS BIGINT) AS window_start, count(*) AS n, round(max(trunc(value * 1000000) / 1000000), 4) AS max_lag,
    round(avg(trunc(value * 1000000) / 1000000) + 1e-7, 4) AS avg_lag FROM events GROUP BY 1""")
def met_lag(t):
    out = metrics.lag_stats(arrivals(t.raw("events")), "1 hour")
    return out.withColumns({"window_start": F.unix_timestamp("window_start"), "max_lag": F.round("max_lag", 4),
                            "avg_lag": F.round(F.col("avg_lag") + 1e-7, 4)})
