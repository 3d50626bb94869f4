"""Queries for joins, aggregates, windows, set operations and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from beaconry.functions import columns as C
from beaconry.functions import vectors as V
from beaconry.operators import campaigns as K
from beaconry.operators import collaborative as CF
from beaconry.operators import delivery, embed, features, neighbours, profile, schedule, serving
from beaconry.plans.bindings import CLICK_AS_OF, DIM, LAST_K, PURCHASE_AS_OF
from beaconry.plans.registry import query
from beaconry.sources import upsert

DAY = 86400


def rounded(df, **places):
    return df.withColumns({c: F.round(c, p) for c, p in places.items()})


def rounded_average(df, col):
    """Averages of cents often end on a 5: a nudge keeps both engines on the same side."""
    return df.withColumn(col, F.round(F.col(col) + 1e-7, 4))


def vector_facts(df, *keys):
    """Length, weighted sum and length of the vector, as a check that fits in numbers."""
    weighted = F.aggregate(F.transform("embedding", lambda x, i: x * (i + 1)), F.lit(0.0), lambda s, x: s + x)
    return df.select(*keys, F.size("embedding").cast("bigint").alias("dim"), F.round(weighted, 6).alias("weighted"),
                     F.round(V.magnitude("embedding"), 6).alias("norm"))


# -- joins ---------------------------------------------------------------------------

@query("join_purchase_product", """SELECT purchase_id, user_id, CAST(product_id AS VARCHAR) AS product_id, quantity, article_type, master_category
    FROM purchases_v LEFT JOIN products_v USING (product_id)""")
def join_purchase_product(t):
    return features.enrich_purchases(t.purchases, t.products, ["article_type", "master_category"]).select(
        "purchase_id", "user_id", "product_id", "quantity", "article_type", "master_category")


PRODUCT_FEATURES = """SELECT product_id, sum(quantity)::BIGINT AS total_sales, round(sum(total_amount), 2) AS revenue,
    round(avg(p.price), 4) AS avg_price, max(purchase_date) AS last_sold_date, any_value(product_display_name) AS product_display_name,
    any_value(article_type) AS article_type, any_value(products_v.price) AS list_price
    FROM purchases_v p LEFT JOIN products_v USING (product_id) GROUP BY product_id"""


@query("join_feature_product", f"SELECT product_id, product_display_name, article_type, total_sales FROM ({PRODUCT_FEATURES})")
def join_feature_product(t):
    return features.product_features(t.purchases, t.products).select(
        "product_id", "product_display_name", "article_type", "total_sales")


TOP = """SELECT user_id, string_agg({c}, ', ' ORDER BY rnk) AS {n} FROM (SELECT user_id, {c}, row_number() OVER
    (PARTITION BY user_id ORDER BY count(*) DESC, {c} NULLS LAST) AS rnk FROM purchases_v LEFT JOIN products_v USING (product_id)
    GROUP BY 1, 2) WHERE rnk <= 5 GROUP BY 1"""
USER_FEATURES = f"""SELECT a.user_id, a.total_orders, round(a.total_spent, 2) AS total_spent, round(a.avg_order_value + 1e-7, 4) AS avg_order_value,
    a.last_purchase_date, u.name, u.email, u.segment, x.top_article_types, y.top_master_categories,
    date_diff('day', u.created_at, DATE '{PURCHASE_AS_OF}') AS days_since_signup
    FROM (SELECT user_id, count(*) AS total_orders, sum(total_amount) AS total_spent, avg(total_amount) AS avg_order_value,
    max(purchase_date) AS last_purchase_date FROM purchases_v GROUP BY 1) a LEFT JOIN users_v u USING (user_id)
    LEFT JOIN ({TOP.format(c='article_type', n='top_article_types')}) x USING (user_id)
    LEFT JOIN ({TOP.format(c='master_category', n='top_master_categories')}) y USING (user_id)"""
USER_COLS = ["user_id", "total_orders", "total_spent", "avg_order_value", "last_purchase_date", "name", "email", "segment",
             "top_article_types", "top_master_categories", "days_since_signup"]


@query("join_user_multi", USER_FEATURES)
def join_user_multi(t):
    """The same features as four joined parts."""
    out = features.joined_user_features(t.purchases, t.users, t.products, PURCHASE_AS_OF)
    return rounded(rounded_average(out, "avg_order_value"), total_spent=2).select(*USER_COLS)


def few_vectors(t):
    """Vectors stored under the product's own id, so later products have none."""
    return t.raw("embeddings").select(F.col("vec_id").alias("product_id"),
                                      F.col("embedding").cast("array<double>").alias("embedding"))


WEIGHTED = "list_sum(list_transform({e}, lambda x, i: x * i))"
LAST_PER_ID = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY purchase_id ORDER BY purchase_date DESC, product_id DESC,
    total_amount DESC, user_id DESC) AS rn FROM purchases_v) WHERE rn = 1"""


@query("join_embedding_default", f"""SELECT purchase_id, product_id, CAST(64 AS BIGINT) AS dim,
    round(coalesce({WEIGHTED.format(e='CAST(embedding AS DOUBLE[])')}, 0), 6) AS weighted,
    round(coalesce(sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))), 0), 6) AS norm
    FROM ({LAST_PER_ID}) LEFT JOIN embeddings ON vec_id = product_id""")
def join_embedding_default(t):
    return vector_facts(embed.purchase_embeddings(t.purchases, few_vectors(t), DIM), "purchase_id", "product_id")


@query("join_user_lastk", """SELECT user_id, count(purchase_id) AS n_recent, max(purchase_date) AS newest FROM users_v
    LEFT JOIN last5_v USING (user_id) GROUP BY 1""")
def join_user_lastk(t):
    recent = features.last_k(t.purchases, LAST_K).groupBy("user_id").agg(
        F.count("purchase_id").alias("n_recent"), F.max("purchase_date").alias("newest"))
    return t.users.select("user_id").join(recent, "user_id", "left").withColumn(
        "n_recent", F.coalesce("n_recent", F.lit(0).cast("bigint")))


@query("join_cross_score", """SELECT user_id, count(*) AS campaigns, round(avg(similarity_score), 10) AS mean_score,
    min(similarity_score) AS low_score, max(similarity_score) AS high_score FROM scores_v GROUP BY 1""")
def join_cross_score(t):
    return rounded(K.score_summary(t.user_vectors, t.campaign_vectors), mean_score=10)


@query("join_self_similarity", """SELECT user_id, count(neighbour) AS overlapping_users, coalesce(sum(shared), 0)::BIGINT AS shared_items,
    round(coalesce(sum(similarity), 0), 6) AS similarity_sum, round(min(similarity), 8) AS lowest_similarity,
    round(max(similarity), 8) AS highest_similarity FROM sizes_v LEFT JOIN pairs_v USING (user_id) GROUP BY 1""")
def join_self_similarity(t):
    return rounded(neighbours.overlap_summary(t.interactions), similarity_sum=6, lowest_similarity=8, highest_similarity=8)


@query("join_neighbour_items", """SELECT n.user_id, n.neighbour, i.item_id, round(n.similarity, 8) AS similarity FROM near_v n
    JOIN interactions_v i ON i.user_id = n.neighbour""")
def join_neighbour_items(t):
    return rounded(CF.neighbour_items(neighbours.neighbours(t.interactions), t.interactions), similarity=8).select(
        "user_id", "neighbour", "item_id", "similarity")


@query("join_anti_seen", "SELECT user_id, item_id, score FROM cf_scores_v")
def join_anti_seen(t):
    return CF.cf_scores(t.interactions)


def asking_vectors(t):
    """Vectors of the users that ask: nobody else's are needed to serve the requests."""
    return embed.user_embeddings(embed.only_users(t.users, t.requests), embed.only_users(t.purchases, t.requests), t.product_vectors, LAST_K, DIM)


@query("join_exclude", """SELECT request_id, campaign_id FROM (SELECT r.request_id, k.campaign_id, row_number() OVER (PARTITION BY r.request_id
    ORDER BY similarity_score DESC, k.campaign_id) AS rank FROM requests_v r JOIN scores_v k ON k.user_id = r.user_id
    WHERE NOT list_contains(r.exclude_campaign_ids, k.campaign_id)) WHERE rank <= 10""")
def join_exclude(t):
    """The ten best campaigns of a request among those it does not exclude: as many more are ranked as a request can drop."""
    most = t.requests.agg(F.max(F.size("exclude_campaign_ids"))).first()[0] or 0
    return serving.best_allowed(t.requests, K.campaign_topk(asking_vectors(t), t.campaign_vectors, 10 + max(most, 0)), 10)


@query("join_window_overlap", """SELECT request_id, campaign_id FROM (SELECT r.request_id, k.campaign_id, row_number() OVER (PARTITION BY r.request_id
    ORDER BY similarity_score DESC, k.campaign_id) AS rank FROM requests_v r JOIN scores_v k ON k.user_id = r.user_id
    JOIN campaigns_v c ON c.campaign_id = k.campaign_id WHERE (window_end IS NULL OR start_date <= window_end)
    AND (window_start IS NULL OR window_start <= end_date)) WHERE rank <= 10""")
def join_window_overlap(t):
    """The ten best campaigns of a request among those that run in its window, by an interval join of windows and campaigns."""
    return serving.best_in_window(t.requests, K.campaign_topk(asking_vectors(t), t.campaign_vectors, t.n_campaigns), t.campaigns, 10)


@query("join_due_context", """SELECT notification_id, d.user_id, d.campaign_id, u.name AS user_name, email, c.name AS campaign_name, template_long
    FROM deliveries_v d LEFT JOIN users_v u USING (user_id) LEFT JOIN campaigns_v c USING (campaign_id)""")
def join_due_context(t):
    due = t.deliveries.select("notification_id", "user_id", "campaign_id")
    return schedule.due_with_context(due, t.users, t.campaigns)


def attributed(t):
    return delivery.attribute_clicks(t.deliveries, t.click_times, DAY)


@query("join_attribution", "SELECT notification_id, user_id, campaign_id, click_id, epoch_us(click_ts) AS click_us FROM attributed_v")
def join_attribution(t):
    return attributed(t).select("notification_id", "user_id", "campaign_id", "click_id",
                                F.unix_micros("click_ts").alias("click_us"))


@query("join_not_found", """SELECT request_id, r.user_id, k.campaign_id, CASE WHEN r.user_id IS NULL THEN 'INVALID_REQUEST'
    WHEN u.user_id IS NULL THEN 'USER_NOT_FOUND' END AS error_code,
    CASE WHEN r.user_id IS NULL OR u.user_id IS NULL THEN 'error' ELSE 'success' END AS status
    FROM requests_v r LEFT JOIN users_v u ON u.user_id = r.user_id LEFT JOIN ranked_v k ON k.user_id = r.user_id AND k.rank = 1""")
def join_not_found(t):
    best = K.top_recommendation(t.ranked).select("user_id", "campaign_id")
    return serving.with_status(t.requests.select("request_id", "user_id"), best, t.user_vectors)


# -- aggregations --------------------------------------------------------------------

@query("agg_user_features", USER_FEATURES)
def agg_user_features(t):
    out = features.user_features(t.purchases, t.users, t.products, PURCHASE_AS_OF, 5)
    return rounded(rounded_average(out, "avg_order_value"), total_spent=2).select(*USER_COLS)


@query("agg_product_features", PRODUCT_FEATURES)
def agg_product_features(t):
    out = features.product_features(t.purchases, t.products)
    return rounded(out, revenue=2, avg_price=4).select(
        "product_id", "total_sales", "revenue", "avg_price", "last_sold_date", "product_display_name", "article_type",
        "list_price")


@query("agg_user_product", """SELECT user_id, product_id, count(*) AS times_purchased, max(purchase_date) AS last_purchase_date,
    1 AS purchased_before FROM purchases_v GROUP BY 1, 2""")
def agg_user_product(t):
    return features.user_product_matrix(t.purchases)


@query("agg_pref_counts", """SELECT user_id, master_category, count(*) AS cnt FROM purchases_v LEFT JOIN products_v USING (product_id) GROUP BY 1, 2""")
def agg_pref_counts(t):
    return features.preference_counts(t.purchases, t.products, "master_category")


@query("agg_concat_top", TOP.format(c="master_category", n="top_values"))
def agg_concat_top(t):
    return features.top_values(features.preference_counts(t.purchases, t.products, "master_category"), "master_category", 5)


@query("agg_group_list", """SELECT user_id, (pos - 1) // 10 AS page, string_agg(product_id, ',' ORDER BY pos) AS products FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY purchase_date DESC, product_id, purchase_id, l_suppkey, l_shipdate,
    quantity, total_amount) AS pos FROM purchases_v) GROUP BY 1, 2""")
def agg_group_list(t):
    pages = features.purchase_lists(t.purchases, page=10)
    return pages.select("user_id", "page", F.concat_ws(",", F.transform(
        "purchases", lambda x: x["product_id"].cast("string"))).alias("products"))


@query("agg_dot", """SELECT product_id, round(list_dot_product(p.embedding, CAST(e.embedding AS DOUBLE[])), 6) AS dot,
    round(sqrt(list_dot_product(p.embedding, p.embedding)), 6) AS magnitude FROM product_vectors_v p
    JOIN part ON p_partkey = product_id JOIN embeddings e ON e.vec_id = p_size""")
def agg_dot(t):
    """Each product vector against the vector kept under its size."""
    other = t.raw("embeddings").select("vec_id", F.col("embedding").alias("other"))
    df = t.product_vectors.join(t.raw("part").select(F.col("p_partkey").alias("product_id"), "p_size"), "product_id")
    df = df.join(other, F.col("vec_id") == F.col("p_size"))
    return df.select("product_id", F.round(V.dot("embedding", "other"), 6).alias("dot"),
                     F.round(V.magnitude("embedding"), 6).alias("magnitude"))


@query("agg_interactions", "SELECT user_id, item_id FROM interactions_v")
def agg_interactions(t):
    return t.interactions


@query("agg_engagement_rate", """SELECT count(*) AS pairs, count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items,
    round(count(*) / (count(DISTINCT user_id) * count(DISTINCT item_id)), 8) AS engagement_rate FROM interactions_v""")
def agg_engagement_rate(t):
    return rounded(neighbours.engagement_rate(t.interactions), engagement_rate=8)


@query("agg_similarity_stats", """SELECT count(*) AS n_users, round(CASE WHEN (SELECT count(*) FROM pairs_v) < count(*) * (count(*) - 1) THEN 0
    ELSE (SELECT min(similarity) FROM pairs_v) END, 8) AS min_similarity,
    round((SELECT max(similarity) FROM pairs_v), 8) AS max_similarity FROM sizes_v""")
def agg_similarity_stats(t):
    return rounded(neighbours.similarity_stats(t.interactions), min_similarity=8, max_similarity=8)


def records(t):
    return CF.recommendation_records(CF.cf_topn(t.interactions, t.items), t.interactions, CLICK_AS_OF)


COUNTED = """SELECT user_id, count(*) AS num_recommendations, any_value(s.n) AS num_previously_seen FROM cf_topn_v
    JOIN sizes_v s USING (user_id) GROUP BY 1"""


@query("agg_rec_counts", COUNTED)
def agg_rec_counts(t):
    return records(t).select("user_id", "num_recommendations", "num_previously_seen")


@query("agg_rec_summary", f"""SELECT count(*) AS n_users, sum(num_recommendations)::BIGINT AS total_recommendations,
    round(avg(num_recommendations), 6) AS avg_recommendations, min(num_recommendations) AS min_recommendations,
    max(num_recommendations) AS max_recommendations FROM ({COUNTED})""")
def agg_rec_summary(t):
    return rounded(CF.recommendation_summary(records(t)), avg_recommendations=6)


LINES = """SELECT user_id, product_id, count(*) AS quantity, arg_max(price, (ts, event_id)) AS price FROM clicks_v
    WHERE event_type = 'add_to_cart' GROUP BY 1, 2"""


@query("agg_cart_lines", f"SELECT *, round(price * quantity, 2)::DOUBLE AS subtotal FROM ({LINES})")
def agg_cart_lines(t):
    return rounded(features.cart_subtotals(features.cart_lines(t.clicks)), subtotal=2)


@query("agg_cart", f"""SELECT user_id, sum(quantity)::BIGINT AS total_items, round(sum(price * quantity), 2)::DOUBLE AS cart_total
    FROM ({LINES}) GROUP BY 1""")
def agg_cart(t):
    return rounded(features.cart_totals(features.cart_lines(t.clicks)), cart_total=2)


@query("agg_row_count", """SELECT 'users' AS table_name, count(*) AS n FROM users_v UNION ALL SELECT 'products', count(*) FROM products_v
    UNION ALL SELECT 'purchases', count(*) FROM purchases_v UNION ALL SELECT 'campaigns', count(*) FROM campaigns_v""")
def agg_row_count(t):
    return features.table_counts({"users": t.users, "products": t.products, "purchases": t.purchases,
                                  "campaigns": t.campaigns})


@query("agg_key_unique", "SELECT count(DISTINCT purchase_id) AS distinct_keys, count(*) AS n_rows FROM purchases_v")
def agg_key_unique(t):
    return profile.key_profile(t.purchases, ["purchase_id"])


NULLS = "SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls, count({c}) AS non_nulls FROM d"


@query("agg_null_counts", "WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(
    NULLS.format(c=c) for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")))
def agg_null_counts(t):
    df = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    return profile.null_profile(df)


@query("agg_value_counts", "SELECT quality, count(*) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def agg_value_counts(t):
    return profile.value_counts(t.raw("documents").select("doc_id").join(t.raw("labels"), "doc_id", "left"), "quality")


@query("agg_describe", """WITH p AS (SELECT l_extendedprice AS v FROM lineitem)
    SELECT 'count' AS stat, count(v)::DOUBLE AS value FROM p UNION ALL SELECT 'mean', round(avg(v), 4) FROM p
    UNION ALL SELECT 'std', round(stddev_samp(v), 4) FROM p UNION ALL SELECT 'min', min(v) FROM p UNION ALL SELECT 'max', max(v) FROM p
    UNION ALL SELECT '25%', round(quantile_cont(v, 0.25), 4) FROM p UNION ALL SELECT '50%', round(quantile_cont(v, 0.5), 4) FROM p
    UNION ALL SELECT '75%', round(quantile_cont(v, 0.75), 4) FROM p""")
def agg_describe(t):
    return rounded(profile.describe(t.raw("lineitem"), "l_extendedprice"), value=4)


@query("agg_describe_text", """SELECT count(c_mktsegment) AS count, count(DISTINCT c_mktsegment) AS "unique",
    (SELECT c_mktsegment FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
    (SELECT count(*) FROM customer GROUP BY c_mktsegment ORDER BY 1 DESC LIMIT 1) AS freq FROM customer""")
def agg_describe_text(t):
    return profile.describe_text(t.raw("customer"), "c_mktsegment")


# -- windows, sort, top-k ------------------------------------------------------------

@query("win_top_articles", TOP.format(c="article_type", n="top_article_types"))
def win_top_articles(t):
    return features.top_values(features.preference_counts(t.purchases, t.products, "article_type"),
                               "article_type", 5, "top_article_types")


@query("win_top_categories", TOP.format(c="master_category", n="top_master_categories"))
def win_top_categories(t):
    return features.top_values(features.preference_counts(t.purchases, t.products, "master_category"),
                               "master_category", 5, "top_master_categories")


@query("win_last_k", "SELECT user_id, rn, purchase_id, product_id, purchase_date FROM last5_v")
def win_last_k(t):
    return features.last_k(t.purchases, LAST_K).select(
        "user_id", F.col("rn").cast("bigint").alias("rn"), "purchase_id", "product_id", "purchase_date")


@query("win_first_k_arrival", """SELECT user_id, rn, purchase_id, product_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY l_shipdate,
    product_id, purchase_id, l_suppkey, quantity, total_amount) AS rn FROM purchases_v) WHERE rn <= 5""")
def win_first_k_arrival(t):
    """The ship date stands for the time a row arrived."""
    return features.last_k(t.purchases, LAST_K, order="l_shipdate").select(
        "user_id", F.col("rn").cast("bigint").alias("rn"), "purchase_id", "product_id")


@query("win_neighbours", "SELECT user_id, neighbour, shared, round(similarity, 8) AS similarity, rank FROM near_v")
def win_neighbours(t):
    return rounded(neighbours.neighbours(t.interactions), similarity=8)


@query("win_top_n_items", "SELECT user_id, item_id, score, rank FROM cf_topn_v WHERE rank <= 100")
def win_top_n_items(t):
    return CF.cf_topn(t.interactions, t.items, n=100)


RANKED_COLS = ["user_id", "campaign_id", "similarity_score", "rank"]


@query("win_campaign_topk", "SELECT user_id, campaign_id, similarity_score, rank FROM ranked_v WHERE rank = 1")
def win_campaign_topk(t):
    return K.top_recommendation(t.ranked).select(*RANKED_COLS)


@query("win_rank_col", """SELECT request_id, campaign_id, rank FROM requests_v r JOIN (SELECT *, row_number() OVER
    (PARTITION BY user_id ORDER BY similarity_score DESC, campaign_id) AS rank FROM scores_v) s ON s.user_id = r.user_id
    WHERE rank <= least(coalesce(num_recommendations, 10), 20)""")
def win_rank_col(t):
    deep = K.campaign_topk(t.user_vectors, t.campaign_vectors, serving.MAX_N)
    return (t.requests.select("request_id", "user_id", "num_recommendations").join(deep, "user_id")
            .filter(F.col("rank") <= serving.wanted(F.col("num_recommendations")))
            .select("request_id", "campaign_id", "rank"))


def versions(t):
    """Stored vectors of all events' users: one version per event type, updated at the event time."""
    e = t.raw("events").select("user_id", F.col("event_type").alias("version"), F.col("ts").alias("last_updated"),
                               (F.col("event_id") % t.n_vectors).alias("vec_id"))
    return e.join(t.raw("embeddings").select("vec_id", "embedding"), "vec_id")


VERSIONS = """SELECT user_id, version, vec_id, CAST(64 AS BIGINT) AS embedding_dimension FROM (SELECT user_id, event_type AS version,
    event_id % (SELECT count(*) FROM embeddings) AS vec_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS rn FROM events {w}) WHERE rn = 1"""


@query("win_latest_version", VERSIONS.format(w=""))
def win_latest_version(t):
    return embed.latest_embedding(versions(t)).select("user_id", "version", "vec_id", "embedding_dimension")


@query("emb_lookup", VERSIONS.format(w="WHERE event_type = 'view'"))
def emb_lookup(t):
    return embed.latest_embedding(versions(t), "view").select("user_id", "version", "vec_id", "embedding_dimension")


@query("sort_slice", "SELECT user_id, string_agg(campaign_id, ',' ORDER BY rank) AS first_five FROM ranked_v WHERE rank <= 5 GROUP BY 1")
def sort_slice(t):
    lists = t.ranked.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", "campaign_id"))).alias("l"))
    return lists.select("user_id", F.concat_ws(",", F.transform(F.slice("l", 1, 5), lambda x: x["campaign_id"])).alias("first_five"))


@query("sort_head", "SELECT product_id, product_display_name, price FROM products_v ORDER BY price DESC, product_id LIMIT 60")
def sort_head(t):
    return t.products.select("product_id", "product_display_name", "price").orderBy(F.col("price").desc(), "product_id").limit(60)


@query("pad_null", """SELECT user_id, any_value(n) AS entries, count(*) AS filled, 10 - count(*) AS empties FROM (SELECT user_id, 10::BIGINT AS n FROM last5_v)
    GROUP BY 1""")
def pad_null(t):
    """The last five purchases padded to ten places."""
    lists = features.last_k(t.purchases, LAST_K).groupBy("user_id").agg(F.collect_list("product_id").alias("l"))
    padded = lists.select("user_id", C.pad_list("l", 10).alias("l"))
    known = F.size(F.filter("l", lambda x: x.isNotNull())).cast("bigint")
    return padded.select("user_id", F.size("l").cast("bigint").alias("entries"), known.alias("filled"),
                         (F.size("l") - known).cast("bigint").alias("empties"))


USER_VECTOR = f"""SELECT u.user_id, CAST(320 AS BIGINT) AS dim, round(coalesce(sum({WEIGHTED.format(e='embedding')}
    + (rn - 1) * 64 * list_sum(embedding)), 0), 6) AS weighted, round(coalesce(sqrt(sum(list_dot_product(embedding, embedding))), 0), 6) AS norm
    FROM users_v u {{j}} JOIN user_blocks_v b ON b.user_id = u.user_id GROUP BY 1"""


@query("pad_zero_blocks", USER_VECTOR.format(j="LEFT"))
def pad_zero_blocks(t):
    return vector_facts(t.user_vectors, "user_id")


@query("emb_user_concat", USER_VECTOR.format(j="LEFT"))
def emb_user_concat(t):
    return vector_facts(t.user_vectors, "user_id")


@query("emb_user_scope", USER_VECTOR.format(j=""))
def emb_user_scope(t):
    """Only users with purchases."""
    return vector_facts(embed.user_embeddings(t.users, t.purchases, t.product_vectors, LAST_K, DIM, include_inactive=False),
                        "user_id")


# -- set operations ------------------------------------------------------------------

@query("set_overlap", "SELECT user_id, count(*) AS n_seen FROM near_v n JOIN (SELECT user_id AS neighbour, item_id FROM interactions_v) USING (neighbour) "
       "WHERE (user_id, item_id) IN (SELECT (user_id, item_id) FROM interactions_v) AND rank = 1 GROUP BY 1")
def set_overlap(t):
    """Offering a user the nearest neighbour's own items: how many were seen already."""
    near = neighbours.neighbours(t.interactions).filter("rank = 1")
    offered = CF.neighbour_items(near, t.interactions).groupBy("user_id").agg(F.collect_set("item_id").alias("ads"))
    return CF.seen_overlap(offered, t.interactions)


@query("set_duplicates", "SELECT user_id, count(*) > count(DISTINCT product_id) AS has_duplicates FROM last5_v GROUP BY 1")
def set_duplicates(t):
    lists = features.last_k(t.purchases, LAST_K).groupBy("user_id").agg(F.collect_list("product_id").alias("l"))
    return lists.select("user_id", C.has_duplicates("l").alias("has_duplicates"))


@query("set_free_slots", """SELECT user_id, string_agg(s, ',' ORDER BY s) AS free FROM (SELECT DISTINCT user_id FROM events)
    CROSS JOIN (SELECT unnest(range(24)) AS s) WHERE (user_id, s) NOT IN (SELECT DISTINCT (user_id, hour(ts)) FROM events WHERE event_type = 'view')
    GROUP BY 1""")
def set_free_slots(t):
    """Hours of the day in which a user never looked at anything."""
    used = t.raw("events").groupBy("user_id").agg(
        F.collect_set(F.when(F.col("event_type") == "view", F.hour("ts"))).alias("used"))
    return used.select("user_id", F.concat_ws(",", F.transform(C.free_slots("used"), lambda s: s.cast("string"))).alias("free")) \
        .filter("free <> ''")


@query("set_merge", """SELECT user_id, name, CAST(NULL AS BIGINT) AS n_orders FROM users_v UNION ALL
    SELECT o_custkey, NULL, count(*) FROM orders GROUP BY 1""")
def set_merge(t):
    delta = t.raw("orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n_orders"))
    return upsert.merge_rows(t.users.select("user_id", "name"), delta)


# -- scalar functions ----------------------------------------------------------------

@query("fn_string", """SELECT user_id, split_part(name, '#', 1) AS head, replace(email, '@example.com', '') AS local_part,
    'Rs. ' || CAST(CAST(user_id AS DECIMAL(18,2)) AS VARCHAR) AS price_text FROM users_v""")
def fn_string(t):
    return t.users.select("user_id", F.split_part("name", F.lit("#"), F.lit(1)).alias("head"),
                          F.substring_index("email", "@", 1).alias("local_part"), C.price_text("user_id").alias("price_text"))


@query("fn_date", """SELECT o_orderkey, date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS age_days,
    CAST(epoch(o_orderdate) AS BIGINT) + 604800 AS expires, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS stamp FROM orders""")
def fn_date(t):
    at = F.col("o_orderdate").cast("timestamp")
    return t.raw("orders").select(
        "o_orderkey", F.datediff(F.lit(PURCHASE_AS_OF).cast("date"), F.to_date("o_orderdate")).cast("bigint").alias("age_days"),
        (F.unix_timestamp(at) + 7 * DAY).alias("expires"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("stamp"))


@query("fn_json", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, '{"u":' || user_id || '}' AS encoded FROM events""")
def fn_json(t):
    return t.raw("events").select(
        "event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.to_json(F.struct(F.col("user_id").alias("u"))).alias("encoded"))


@query("fn_array", """SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) AS square,
    round(list_sum(CAST(embedding[1:5] AS DOUBLE[])), 6) AS head_sum, len(list_filter(embedding, lambda x: x > 0)) AS positives FROM embeddings""")
def fn_array(t):
    e = F.col("embedding").cast("array<double>")
    return t.raw("embeddings").select(
        "vec_id", F.round(V.dot(e, e), 6).alias("square"),
        F.round(F.aggregate(F.slice(e, 1, 5), F.lit(0.0), lambda s, x: s + x), 6).alias("head_sum"),
        F.size(F.filter(e, lambda x: x > 0)).cast("bigint").alias("positives"))


@query("fn_math", """SELECT l_orderkey, l_linenumber, l_partkey, round(sqrt(l_extendedprice), 4) AS root, round(power(l_discount, 2), 6) AS squared,
    CASE WHEN l_tax = 0 THEN 0.0 ELSE round(l_discount / l_tax, 4) END AS ratio FROM lineitem""")
def fn_math(t):
    guarded = F.when(F.col("l_tax") == 0, F.lit(0.0)).otherwise(F.round(F.col("l_discount") / F.col("l_tax"), 4))
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.round(F.sqrt("l_extendedprice"), 4).alias("root"),
        F.round(F.pow("l_discount", F.lit(2)), 6).alias("squared"), guarded.alias("ratio"))


@query("fn_map", """SELECT doc_id, '{"lang":"' || lang || '"' || coalesce(',"quality":"' || quality || '"', '') || '}' AS item
    FROM documents LEFT JOIN labels USING (doc_id)""")
def fn_map(t):
    """Attributes as a map, those without a value left out."""
    df = t.raw("documents").select("doc_id", "lang").join(t.raw("labels"), "doc_id", "left")
    pairs = F.create_map(F.lit("lang"), F.col("lang"), F.lit("quality"), F.col("quality").cast("string"))
    return df.select("doc_id", F.to_json(F.map_filter(pairs, lambda k, v: v.isNotNull())).alias("item"))


@query("fn_cast", """SELECT l_orderkey, l_linenumber, CAST(l_orderkey AS VARCHAR) AS key_text, CAST(trunc(l_quantity) AS INT) AS quantity,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_shipdate AS DATE) AS shipped FROM lineitem""")
def fn_cast(t):
    return t.raw("lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("key_text"),
        C.lenient("l_quantity", "int").alias("quantity"), F.col("l_extendedprice").try_cast("decimal(18,2)").alias("price"),
        F.col("l_shipdate").try_cast("date").alias("shipped"))
