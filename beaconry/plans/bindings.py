"""The messaging tables expressed over the driver's tables, for Spark and as SQL."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconry.sources.tables import read_table

DIM = 64
LAST_K = 5
PURCHASE_AS_OF = "2002-01-01"
CLICK_AS_OF = "2024-01-15"
CART_KINDS = ["add_to_cart", "purchase"]


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.root, name)

    @cached_property
    def n_vectors(self) -> int:
        return self.raw("embeddings").count()

    @cached_property
    def n_campaigns(self) -> int:
        return self.raw("benchmark").count()

    @cached_property
    def products(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS product_id", "p_name AS product_display_name", "p_type AS master_category",
            "p_brand AS article_type", "p_retailprice AS price")

    @cached_property
    def users(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey AS user_id", "c_name AS name",
            "lower(replace(c_name,'#','.')) || '@example.com' AS email", "c_mktsegment AS segment",
            "date_add(DATE '1994-01-01', CAST(c_custkey % 365 AS INT)) AS created_at")

    @cached_property
    def purchases(self) -> DataFrame:
        lines = self.raw("lineitem")
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
            "concat(l_orderkey, '-', l_linenumber) AS purchase_id", "o_custkey AS user_id",
            "l_partkey AS product_id", "CAST(l_quantity AS INT) AS quantity",
            "l_extendedprice / l_quantity AS price", "l_extendedprice AS total_amount",
            "CAST(o_orderdate AS DATE) AS purchase_date", "l_suppkey", "l_shipdate")

    @cached_property
    def campaigns(self) -> DataFrame:
        return self.raw("benchmark").selectExpr(
            "concat('C', item_id + 1) AS campaign_id", "substr(text, 1, 24) AS name", "text AS template_long",
            "substr(text, 1, 40) AS template_short",
            "CASE WHEN item_id % 7 = 6 THEN 'paused' ELSE 'active' END AS status",
            "CAST(3 + item_id % 3 AS INT) AS priority", "'promotional' AS notification_type",
            "date_add(DATE '2023-12-20', CAST(item_id % 30 AS INT)) AS start_date",
            "date_add(DATE '2023-12-20', CAST(item_id % 30 + 14 AS INT)) AS end_date", "item_id AS vec_id")

    @cached_property
    def product_vectors(self) -> DataFrame:
        e = self.raw("embeddings").select("vec_id", "embedding")
        return self.raw("part").select("p_partkey").join(e, F.col("vec_id") == F.col("p_partkey") % self.n_vectors).select(
            F.col("p_partkey").alias("product_id"), "embedding")

    @cached_property
    def campaign_vectors(self) -> DataFrame:
        e = self.raw("embeddings").select("vec_id", "embedding")
        return self.campaigns.select("campaign_id", "vec_id").join(e, "vec_id").select("campaign_id", "embedding")

    @cached_property
    def clicks(self) -> DataFrame:
        return clicks_of(self.raw("events"))

    @cached_property
    def interactions(self) -> DataFrame:
        from beaconry.operators.neighbours import interactions

        return interactions(self.clicks, CART_KINDS)

    @cached_property
    def items(self) -> DataFrame:
        return self.interactions.select("item_id").distinct()

    @cached_property
    def deliveries(self) -> DataFrame:
        """Views stand for delivered notifications, one campaign each."""
        return self.raw("events").filter("event_type = 'view'").selectExpr(
            "event_id AS notification_id", "user_id",
            f"concat('C', (CAST(get_json_object(props, '$.k') AS BIGINT) + 100 * (event_id % 10)) % {self.n_campaigns} + 1) AS campaign_id",
            "date_trunc('minute', ts) AS scheduled_time", "CAST(ts AS TIMESTAMP) AS sent_at",
            "CAST(get_json_object(props, '$.k') AS BIGINT) % 17 = 0 AS failed")

    @cached_property
    def click_times(self) -> DataFrame:
        return self.raw("events").filter("event_type = 'click'").selectExpr(
            "event_id AS click_id", "user_id", "CAST(ts AS TIMESTAMP) AS click_ts")

    @cached_property
    def user_vectors(self) -> DataFrame:
        from beaconry.operators.embed import user_embeddings

        return user_embeddings(self.users, self.purchases, self.product_vectors, LAST_K, DIM)

    @cached_property
    def ranked(self) -> DataFrame:
        from beaconry.operators.campaigns import campaign_topk

        return campaign_topk(self.user_vectors, self.campaign_vectors, 10)

    def ranked_on(self, date: str) -> DataFrame:
        """The ten best of the campaigns whose dates cover the day."""
        from beaconry.operators.campaigns import campaign_topk
        from beaconry.operators.schedule import live_on

        live = self.campaign_vectors.join(live_on(self.campaigns, date).select("campaign_id"), "campaign_id", "left_semi")
        return campaign_topk(self.user_vectors, live, 10)

    @cached_property
    def requests(self) -> DataFrame:
        """One request per event: ids beyond the known users, missing ids, lists and windows included."""
        return self.raw("events").selectExpr(
            "event_id AS request_id", "CASE WHEN event_id % 11 = 10 THEN NULL ELSE user_id * 11 END AS user_id",
            "CAST(nullif(event_id % 25, 0) AS INT) AS num_recommendations",
            f"array(concat('C', event_id % {self.n_campaigns} + 1), concat('C', event_id % 7 + 1)) AS exclude_campaign_ids",
            "CASE WHEN event_id % 3 > 0 THEN CAST(ts AS DATE) END AS window_start",
            "CASE WHEN event_id % 3 > 1 THEN date_add(CAST(ts AS DATE), 2) END AS window_end")

    @cached_property
    def constraints(self) -> DataFrame:
        return self.users.selectExpr(
            "user_id", "CAST(1 + user_id % 6 AS INT) AS max_notifications_per_day",
            "CASE user_id % 4 WHEN 0 THEN '22:00' WHEN 1 THEN '01:00' WHEN 2 THEN '12:00' ELSE '20:15' END AS quiet_start",
            "CASE user_id % 4 WHEN 0 THEN '08:00' WHEN 1 THEN '06:00' WHEN 2 THEN '13:30' ELSE '09:00' END AS quiet_end",
            "CASE WHEN user_id % 2 = 0 THEN array('09:00', '14:00', '19:00') END AS preferred_times",
            "CASE WHEN user_id % 50 = 0 THEN array(DATE '2024-01-05') END AS blackout_dates")


def clicks_of(events: DataFrame) -> DataFrame:
    return events.filter("event_type IN ('view','click','purchase')").selectExpr(
        "event_id", "ts", "user_id",
        "CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type",
        "CAST(value AS INT) AS price", "CAST(get_json_object(props, '$.k') AS BIGINT) AS product_id")


_NEWEST = ("purchase_date DESC, product_id, purchase_id, l_suppkey, l_shipdate, quantity, total_amount")

# The same tables for the SQL check, each a view body that may name earlier ones.
SQL_VIEWS: dict[str, str] = {
    "products_v": "SELECT p_partkey AS product_id, p_name AS product_display_name, p_type AS master_category, "
                  "p_brand AS article_type, p_retailprice AS price FROM part",
    "users_v": "SELECT c_custkey AS user_id, c_name AS name, lower(replace(c_name,'#','.')) || '@example.com' AS email, "
               "c_mktsegment AS segment, DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS created_at FROM customer",
    "purchases_v": "SELECT concat(l_orderkey, '-', l_linenumber) AS purchase_id, o_custkey AS user_id, "
                   "l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity, l_extendedprice / l_quantity AS price, "
                   "l_extendedprice AS total_amount, CAST(o_orderdate AS DATE) AS purchase_date, l_suppkey, l_shipdate "
                   "FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "campaigns_v": "SELECT concat('C', item_id + 1) AS campaign_id, substr(text, 1, 24) AS name, text AS template_long, "
                   "substr(text, 1, 40) AS template_short, CASE WHEN item_id % 7 = 6 THEN 'paused' ELSE 'active' END AS status, "
                   "CAST(3 + item_id % 3 AS INT) AS priority, 'promotional' AS notification_type, "
                   "DATE '2023-12-20' + CAST(item_id % 30 AS INT) AS start_date, "
                   "DATE '2023-12-20' + CAST(item_id % 30 + 14 AS INT) AS end_date, item_id AS vec_id FROM benchmark",
    "product_vectors_v": "SELECT p_partkey AS product_id, CAST(embedding AS DOUBLE[]) AS embedding FROM part "
                         "JOIN embeddings ON vec_id = p_partkey % (SELECT count(*) FROM embeddings)",
    "campaign_vectors_v": "SELECT concat('C', item_id + 1) AS campaign_id, CAST(embedding AS DOUBLE[]) AS embedding "
                          "FROM benchmark JOIN embeddings ON vec_id = item_id",
    "clicks_v": "SELECT event_id, ts, user_id, CASE event_type WHEN 'click' THEN 'add_to_cart' ELSE event_type END AS event_type, "
                "CAST(trunc(value) AS INT) AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id "
                "FROM events WHERE event_type IN ('view','click','purchase')",
    "interactions_v": "SELECT DISTINCT user_id, product_id AS item_id FROM clicks_v "
                      "WHERE event_type IN ('add_to_cart','purchase')",
    "deliveries_v": "SELECT event_id AS notification_id, user_id, "
                    "concat('C', (CAST(json_extract_string(props, '$.k') AS BIGINT) + 100 * (event_id % 10)) % (SELECT count(*) FROM benchmark) + 1) AS campaign_id, "
                    "date_trunc('minute', ts) AS scheduled_time, ts AS sent_at, "
                    "CAST(json_extract_string(props, '$.k') AS BIGINT) % 17 = 0 AS failed FROM events WHERE event_type = 'view'",
    "click_times_v": "SELECT event_id AS click_id, user_id, ts AS click_ts FROM events WHERE event_type = 'click'",
    "last5_v": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY " + _NEWEST + ") AS rn "
               "FROM purchases_v) WHERE rn <= 5",
    "user_blocks_v": "SELECT user_id, rn, embedding FROM last5_v JOIN product_vectors_v USING (product_id)",
    "user_norms_v": "SELECT user_id, sqrt(sum(list_dot_product(embedding, embedding))) AS norm FROM user_blocks_v GROUP BY user_id",
    "scores_v": "SELECT u.user_id, c.campaign_id, CASE WHEN b.user_id IS NULL THEN 0.0 ELSE "
                "round(list_dot_product(b.embedding, c.embedding) / (n.norm * sqrt(list_dot_product(c.embedding, c.embedding))), 4) END "
                "AS similarity_score FROM users_v u CROSS JOIN campaign_vectors_v c "
                "LEFT JOIN user_blocks_v b ON b.user_id = u.user_id AND b.rn = 1 LEFT JOIN user_norms_v n ON n.user_id = u.user_id",
    "ranked_v": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY similarity_score DESC, campaign_id) AS rank "
                "FROM scores_v) WHERE rank <= 10",
    "ranked_live_v": "SELECT * FROM (SELECT s.*, row_number() OVER (PARTITION BY user_id ORDER BY similarity_score DESC, campaign_id) AS rank "
                     "FROM scores_v s JOIN campaigns_v USING (campaign_id) WHERE DATE '2024-01-05' BETWEEN start_date AND end_date) WHERE rank <= 10",
    "sizes_v": "SELECT user_id, count(*) AS n FROM interactions_v GROUP BY user_id",
    "pairs_v": "SELECT p.u AS user_id, p.v AS neighbour, p.shared, a.n AS n_u, b.n AS n_v, "
               "p.shared / sqrt(CAST(a.n * b.n AS DOUBLE)) AS similarity FROM (SELECT x.user_id AS u, y.user_id AS v, "
               "count(*) AS shared FROM interactions_v x JOIN interactions_v y ON x.item_id = y.item_id AND x.user_id <> y.user_id "
               "GROUP BY 1, 2) p JOIN sizes_v a ON a.user_id = p.u JOIN sizes_v b ON b.user_id = p.v",
    "near_v": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "
              "CAST(shared * shared AS DOUBLE) / n_v DESC, neighbour) AS rank FROM pairs_v) WHERE rank <= 5",
    "cf_scores_v": "SELECT n.user_id, i.item_id, round(sum(n.similarity), 10) AS score FROM near_v n "
                   "JOIN interactions_v i ON i.user_id = n.neighbour "
                   "WHERE NOT EXISTS (SELECT 1 FROM interactions_v s WHERE s.user_id = n.user_id AND s.item_id = i.item_id) GROUP BY 1, 2",
    "cf_topn_v": "SELECT * FROM (SELECT user_id, item_id, score, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank "
                 "FROM (SELECT u.user_id, i.item_id, coalesce(c.score, 0.0) AS score FROM (SELECT DISTINCT user_id FROM interactions_v) u "
                 "CROSS JOIN (SELECT DISTINCT item_id FROM interactions_v) i LEFT JOIN cf_scores_v c ON c.user_id = u.user_id AND c.item_id = i.item_id "
                 "WHERE NOT EXISTS (SELECT 1 FROM interactions_v s WHERE s.user_id = u.user_id AND s.item_id = i.item_id))) WHERE rank <= 100",
    "requests_v": "SELECT event_id AS request_id, CASE WHEN event_id % 11 = 10 THEN NULL ELSE user_id * 11 END AS user_id, "
                  "CAST(nullif(event_id % 25, 0) AS INT) AS num_recommendations, "
                  "[concat('C', event_id % (SELECT count(*) FROM benchmark) + 1), concat('C', event_id % 7 + 1)] AS exclude_campaign_ids, "
                  "CASE WHEN event_id % 3 > 0 THEN CAST(ts AS DATE) END AS window_start, "
                  "CASE WHEN event_id % 3 > 1 THEN CAST(ts AS DATE) + 2 END AS window_end FROM events",
    "constraints_v": "SELECT user_id, CAST(1 + user_id % 6 AS INT) AS max_notifications_per_day, "
                     "CASE user_id % 4 WHEN 0 THEN 22 WHEN 1 THEN 1 WHEN 2 THEN 12 ELSE 20 END AS qs, "
                     "CASE user_id % 4 WHEN 0 THEN 8 WHEN 1 THEN 6 WHEN 2 THEN 14 ELSE 9 END AS qe, "
                     "user_id % 2 = 0 AS likes, user_id % 50 = 0 AS blacked_out FROM users_v",
    "slot_hash_v": "SELECT user_id, s AS slot, CAST('0x' || substr(md5(concat(user_id, '-', s)), 1, 8) AS BIGINT) AS h "
                   "FROM users_v CROSS JOIN (SELECT unnest(range(24)) AS s)",
    "free_slots_v": "SELECT user_id, slot, row_number() OVER (PARTITION BY user_id ORDER BY CASE WHEN likes AND slot IN (9, 14, 19) "
                    "THEN slot ELSE 100 END, h, slot) AS i FROM slot_hash_v JOIN constraints_v USING (user_id) "
                    "WHERE NOT (CASE WHEN qs < qe THEN slot >= qs AND slot < qe ELSE slot >= qs OR slot < qe END)",
    "plan_v": "SELECT user_id, DATE '2024-01-05' AS schedule_date, row_number() OVER (PARTITION BY user_id ORDER BY slot) AS sequence, "
              "campaign_id, priority, similarity_score, slot AS timeslot FROM (SELECT r.user_id, r.campaign_id, c.priority, r.similarity_score, "
              "row_number() OVER (PARTITION BY r.user_id ORDER BY c.priority DESC, r.similarity_score DESC, r.campaign_id) AS i "
              "FROM ranked_live_v r JOIN campaigns_v c USING (campaign_id)) "
              "JOIN constraints_v USING (user_id) JOIN free_slots_v f USING (user_id, i) "
              "WHERE i <= max_notifications_per_day AND max_notifications_per_day <= 5 AND NOT blacked_out",
    "attributed_v": "SELECT d.*, k.click_id, k.click_ts FROM deliveries_v d LEFT JOIN (SELECT * FROM (SELECT d.notification_id, c.click_id, c.click_ts, "
                    "row_number() OVER (PARTITION BY d.notification_id ORDER BY c.click_ts, c.click_id) AS rn FROM deliveries_v d "
                    "JOIN click_times_v c ON c.user_id = d.user_id AND c.click_ts BETWEEN d.sent_at AND d.sent_at + INTERVAL 24 HOUR) WHERE rn = 1) k "
                    "USING (notification_id)",
}


def with_views(sql: str) -> str:
    """Put the views a SQL text needs in front of it."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"\b\w+_v\b", text):
            if name in SQL_VIEWS and name not in needed:
                needed.add(name)
                visit(SQL_VIEWS[name])

    visit(sql)
    heads = ", ".join(f"{n} AS ({body})" for n, body in SQL_VIEWS.items() if n in needed)
    if not heads:
        return sql.strip()
    sql = sql.strip()
    if sql.upper().startswith("WITH "):
        return f"WITH {heads}, {sql[5:]}"
    return f"WITH {heads} {sql}"
