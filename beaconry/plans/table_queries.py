"""Queries for sources, sinks, cleaning and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.functions import columns as C
from beaconry.operators import campaigns as K
from beaconry.operators import clean, features
from beaconry.plans.bindings import LAST_K, PURCHASE_AS_OF
from beaconry.plans.registry import query
from beaconry.session import scratch_path
from beaconry.sources import clustered, messages, tables, upsert
from beaconry.sources.chunk_sink import write_chunks
from beaconry.streaming import clicks as S


# -- sources and sinks ---------------------------------------------------------------

@query("src_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def src_csv(t):
    path = scratch_path(t.spark, "csv")
    df = t.raw("customer").select("c_custkey", "c_name", "c_acctbal")
    tables.write_csv(df, path)
    return tables.read_csv(t.spark, path, df.schema)


@query("src_csv_infer", "SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_size, p_retailprice FROM part")
def src_csv_infer(t):
    path = scratch_path(t.spark, "csv")
    tables.write_csv(t.raw("part").select("p_partkey", "p_name", "p_size", "p_retailprice"), path)
    df = tables.read_csv(t.spark, path)
    return df.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("src_csv_skip_bad", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'")
def src_csv_skip_bad(t):
    """Orders still in progress get a bad key; the reader drops those lines."""
    path = scratch_path(t.spark, "csv")
    key = F.when(F.col("o_orderstatus") == "P", F.lit("pending")).otherwise(F.col("o_orderkey").cast("string"))
    tables.write_csv(t.raw("orders").select(key.alias("o_orderkey"), "o_orderstatus"), path)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_orderstatus", T.StringType())])
    return tables.read_csv(t.spark, path, schema, "DROPMALFORMED")


@query("src_parquet", "SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def src_parquet(t):
    n, r = t.raw("nation"), t.raw("region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name")


@query("src_keyed_scan", "SELECT product_id, product_display_name, master_category, article_type, price FROM products_v")
def src_keyed_scan(t):
    return t.products


@query("src_scan_limit", "SELECT user_id, name, segment FROM users_v ORDER BY user_id LIMIT 100")
def src_scan_limit(t):
    return tables.sample_scan(t.users.select("user_id", "name", "segment"), 100, ["user_id"])


@query("src_point_lookup", "SELECT user_id, name, email FROM users_v WHERE user_id IN (SELECT user_id FROM events)")
def src_point_lookup(t):
    path = scratch_path(t.spark, "users")
    clustered.write_clustered(t.users.select("user_id", "name", "email"), path, "user_id", files=8)
    return clustered.clustered_lookup(t.spark, path, t.raw("events"), "user_id")


def click_messages(t):
    """Click events as JSON messages in the shape the web shop sends."""
    c = t.clicks.join(t.products.select("product_id", "product_display_name", "master_category", "article_type"),
                      "product_id", "left")
    return messages.event_messages(c.select(
        F.col("event_type").alias("event"), F.col("user_id").cast("string").alias("user_id"), "price", "product_id",
        F.col("product_display_name").alias("product_name"), F.col("master_category").alias("category"), "article_type",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp")))


INGESTED = """SELECT event_type, c.price, c.product_id, product_display_name AS product_name, master_category AS category,
    article_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, CAST(user_id AS VARCHAR) AS user_id
    FROM clicks_v c LEFT JOIN products_v p ON p.product_id = c.product_id"""


@query("src_kafka", INGESTED)
def src_kafka(t):
    """Replay of the topic: one JSON message per line, read as a stream from the start."""
    path, out = scratch_path(t.spark, "topic"), scratch_path(t.spark, "clicks")
    click_messages(t).write.text(path)
    stream = messages.read_clicks(t.spark, {"path": path})
    valid, _ = S.split_valid(S.parse_clicks(stream))
    return S.run_to_table(clean.normalise_clicks(valid), out, scratch_path(t.spark, "ckpt"))


@query("snk_kafka", """SELECT '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
    || '","product_id":' || product_id || '}' AS value FROM clicks_v""")
def snk_kafka(t):
    return messages.event_messages(t.clicks.select("event_id", "user_id", "event_type", "product_id"))


@query("snk_parquet", """SELECT o_orderkey, o_custkey, CAST(year(o_orderdate) AS INT) AS order_year FROM orders""")
def snk_parquet(t):
    path = scratch_path(t.spark, "orders")
    df = t.raw("orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year"))
    tables.write_table(df, path, ["order_year"])
    tables.write_table(df, path, ["order_year"])  # a second run replaces the first
    return t.spark.read.parquet(path)


@query("snk_single_file", """SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files, sum(total_sales)::BIGINT AS total_sales
    FROM (SELECT product_id, sum(quantity) AS total_sales FROM purchases_v GROUP BY 1)""")
def snk_single_file(t):
    path = scratch_path(t.spark, "features")
    tables.write_table(t.purchases.groupBy("product_id").agg(F.sum("quantity").alias("total_sales")), path, files=1)
    per_file = t.spark.read.parquet(path).withColumn("file", F.input_file_name()).groupBy("file").agg(
        F.count("*").alias("n"), F.sum("total_sales").alias("s"))
    return per_file.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_files"), F.sum("s").alias("total_sales"))


@query("snk_put", """SELECT product_id, CASE WHEN s.l_partkey IS NULL THEN master_category ELSE 'sold' END AS master_category,
    CASE WHEN s.l_partkey IS NULL THEN price ELSE s.top_price END AS price
    FROM products_v LEFT JOIN (SELECT l_partkey, max(l_extendedprice) AS top_price FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) s
    ON s.l_partkey = product_id""")
def snk_put(t):
    """Products replaced by the items of returned lines, written to a keyed table and read back."""
    base = t.products.select("product_id", "master_category", "price")
    delta = t.raw("lineitem").filter("l_returnflag = 'R'").select(
        F.col("l_partkey").alias("product_id"), F.lit("sold").alias("master_category"),
        F.col("l_extendedprice").alias("price"))
    path = scratch_path(t.spark, "products")
    upsert.upsert_table(path, base, ["product_id"], ["price"], buckets=8)
    upsert.upsert_table(path, delta, ["product_id"], [F.col("price").desc()], buckets=8)
    return upsert.read_table(t.spark, path)


@query("snk_update_set", """SELECT u.user_id AS user_id, name, n_orders, last_order FROM users_v u
    FULL JOIN (SELECT o_custkey AS user_id, count(*) AS n_orders, CAST(max(o_orderdate) AS DATE) AS last_order FROM orders GROUP BY 1) o
    ON o.user_id = u.user_id""")
def snk_update_set(t):
    delta = t.raw("orders").groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.count("*").alias("n_orders"), F.max("o_orderdate").cast("date").alias("last_order"))
    return upsert.upsert_merge(t.users.select("user_id", "name"), delta, ["user_id"], ["n_orders", "last_order"])


@query("snk_ensure_table", "SELECT s_suppkey, s_name FROM supplier")
def snk_ensure_table(t):
    path = scratch_path(t.spark, "suppliers")
    df = t.raw("supplier").select("s_suppkey", "s_name")
    tables.ensure_table(t.spark, path, df.schema)
    df.write.mode("append").parquet(path)
    return tables.ensure_table(t.spark, path, df.schema)


@query("snk_batch_writer", "SELECT user_id, product_id, count(*) AS times_purchased FROM purchases_v GROUP BY 1, 2")
def snk_batch_writer(t):
    path = scratch_path(t.spark, "chunks")
    df = t.purchases.groupBy("user_id", "product_id").agg(F.count("*").alias("times_purchased"))
    write_chunks(df, path, chunk=5000)
    return t.spark.read.schema(df.schema).parquet(path)


@query("snk_json", "SELECT s_suppkey, s_name, s_nationkey FROM supplier")
def snk_json(t):
    path = scratch_path(t.spark, "json")
    df = t.raw("supplier").select("s_suppkey", "s_name", "s_nationkey")
    tables.write_json(df, path)
    return t.spark.read.schema(df.schema).json(path)


@query("snk_csv", """SELECT user_id, '[' || string_agg(product_id, ',' ORDER BY rn) || ']' AS products FROM last5_v GROUP BY 1""")
def snk_csv(t):
    """A list column goes to CSV as JSON text."""
    path = scratch_path(t.spark, "csv")
    lists = features.last_k(t.purchases, LAST_K).groupBy("user_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rn", "product_id"))), lambda x: x["product_id"]).alias("products"))
    tables.write_csv(lists, path)
    return tables.read_csv(t.spark, path, T.StructType([
        T.StructField("user_id", T.LongType()), T.StructField("products", T.StringType())]))


REQUEST = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("num_recommendations", T.IntegerType())])


@query("src_json_envelope", "SELECT c_custkey AS request_id, c_custkey AS user_id, c_nationkey AS num_recommendations FROM customer")
def src_json_envelope(t):
    """Every other request comes wrapped in a body."""
    plain = F.to_json(F.struct(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("num_recommendations")))
    wrapped = F.to_json(F.struct(plain.alias("body")))
    df = t.raw("customer").select(F.col("c_custkey").alias("request_id"),
                                  F.when(F.col("c_custkey") % 2 == 0, plain).otherwise(wrapped).alias("request"))
    return messages.parse_envelope(df, "request", REQUEST)


@query("src_json_path", """SELECT r.user_id, coalesce(c.template_long, '') AS notification FROM ranked_v r
    LEFT JOIN campaigns_v c ON c.campaign_id = r.campaign_id WHERE rank = 1""")
def src_json_path(t):
    reply = K.recommendation_reply(t.ranked, t.campaigns)
    return reply.select("user_id", messages.notification_text("reply").alias("notification"))


# -- projections, cleaning, predicates -----------------------------------------------

@query("prj_require_cols", "SELECT c_custkey, c_name FROM customer")
def prj_require_cols(t):
    return clean.require_columns(t.raw("customer"), ["c_custkey", "c_name"]).select("c_custkey", "c_name")


@query("prj_trim_all", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def prj_trim_all(t):
    padded = t.raw("customer").select("c_custkey", F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name"),
                                      F.concat("c_mktsegment", F.lit("   ")).alias("c_mktsegment"))
    return clean.trim_all(padded)


@query("prj_select", "SELECT user_id, name, email, created_at FROM users_v")
def prj_select(t):
    return clean.select_cols(t.users, ["user_id", "name", "email", "created_at"])


@query("prj_cast_lenient", """SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN NULL ELSE p_size END AS size_int,
    CAST(trunc(p_retailprice) AS INT) AS price_int, CAST(p_retailprice AS DOUBLE) AS price_double FROM part""")
def prj_cast_lenient(t):
    """Bad text, text with decimals, and doubles, all to whole numbers."""
    size = F.col("p_size").cast("string")
    text = F.when(F.col("p_size") % 3 == 0, F.lit("abc")).when(
        F.col("p_size") % 3 == 1, F.concat(size, F.lit(".7"))).otherwise(size)
    df = t.raw("part").select("p_partkey", text.alias("size_int"), F.col("p_retailprice").alias("price_int"),
                              F.col("p_retailprice").cast("string").alias("price_double"))
    return clean.cast_cols(df, {"size_int": "int", "price_int": "int", "price_double": "double"})


@query("prj_reformat_date", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END
    AS order_date FROM orders""")
def prj_reformat_date(t):
    iso, dmy = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "dd-MM-yyyy")
    df = t.raw("orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "P", iso).otherwise(dmy).alias("order_date"))
    return clean.reformat_date(df, "order_date")


@query("prj_asset_url", """SELECT product_id, 's3://shop-assets/images/' || product_id || '.jpg' AS s3_url,
    's3://shop-assets/raw/' || product_id || '.jpg' AS raw_url,
    'https://shop-assets.example.com/images/' || product_id || '.jpg' AS web_url FROM products_v""")
def prj_asset_url(t):
    df = t.products.select("product_id")
    df = clean.asset_url(df, "product_id", "s3://shop-assets/images/", name="s3_url")
    df = clean.asset_url(df, "product_id", "s3://shop-assets/raw/", name="raw_url")
    return clean.asset_url(df, "product_id", "https://shop-assets.example.com/images/", name="web_url")


FALLBACK = "s3://shop-assets/none.jpg"


@query("prj_asset_fallback", f"""SELECT product_id, CASE WHEN product_id IN (SELECT l_partkey FROM lineitem WHERE l_discount = 0)
    THEN 's3://shop-assets/images/' || product_id || '.jpg' ELSE '{FALLBACK}' END AS shown_url FROM products_v""")
def prj_asset_fallback(t):
    """Products sold at full price once have a picture; the others show the fallback."""
    prefix = "s3://shop-assets/images/"
    listed = clean.asset_url(t.raw("lineitem").filter("l_discount = 0").select("l_partkey"), "l_partkey", prefix)
    shown = clean.asset_or_fallback(clean.asset_url(t.products, "product_id", prefix), listed, "image_url", FALLBACK)
    return shown.select("product_id", "shown_url")


@query("prj_rename", "SELECT product_id AS id, product_display_name AS title, master_category AS category FROM products_v")
def prj_rename(t):
    return clean.rename(t.products.select("product_id", "product_display_name", "master_category"),
                        {"product_id": "id", "product_display_name": "title", "master_category": "category"})


@query("flt_dropna", """SELECT d.doc_id, quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id
    WHERE quality IS NOT NULL AND toxic IS NOT NULL""")
def flt_dropna(t):
    """Documents left without a label drop out."""
    df = t.raw("documents").select("doc_id").join(t.raw("labels"), "doc_id", "left")
    return clean.drop_nulls(df, ["quality", "toxic"]).select("doc_id", "quality")


@query("flt_dedup_key", """SELECT purchase_id, user_id, product_id, purchase_date FROM (SELECT *, row_number() OVER
    (PARTITION BY purchase_id ORDER BY purchase_date, product_id, l_suppkey, l_shipdate, quantity, total_amount) AS rn
    FROM purchases_v) WHERE rn = 1""")
def flt_dedup_key(t):
    order = ["purchase_date", "product_id", "l_suppkey", "l_shipdate", "quantity", "total_amount"]
    return clean.dedup_keep_first(t.purchases, ["purchase_id"], order).select(
        "purchase_id", "user_id", "product_id", "purchase_date")


MEMBERS = "SELECT product_id, product_display_name FROM products_v WHERE product_id IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')"


@query("flt_isin", MEMBERS)
def flt_isin(t):
    ids = t.raw("lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("product_id"))
    return clean.keep_members(t.products.select("product_id", "product_display_name"), ids, ["product_id"])


@query("join_semi_assets", MEMBERS)
def join_semi_assets(t):
    return flt_isin(t)


COUNTS = """SELECT user_id, {c}, count(*) AS cnt FROM purchases_v LEFT JOIN products_v USING (product_id) GROUP BY 1, 2"""
RANKED = "SELECT user_id, {c}, cnt, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, {c} NULLS LAST) AS rnk FROM (" + COUNTS + ")"


@query("flt_rank_le", "SELECT user_id, article_type, cnt, rnk FROM (" + RANKED.format(c="article_type") + ") WHERE rnk <= 5")
def flt_rank_le(t):
    counts = features.preference_counts(t.purchases, t.products, "article_type")
    return features.ranked_values(counts, "article_type", 5).withColumn("rnk", F.col("rnk").cast("bigint"))


@query("flt_active", """SELECT campaign_id, start_date, end_date FROM campaigns_v
    WHERE status = 'active' AND DATE '2024-01-15' BETWEEN start_date AND end_date""")
def flt_active(t):
    return clean.active_campaigns(t.campaigns, "2024-01-15").select("campaign_id", "start_date", "end_date")


@query("prj_compose_text", """SELECT doc_id, coalesce(source, '') || ' ' || coalesce(CAST(quality AS VARCHAR), '') || ' ' || lang AS text
    FROM documents LEFT JOIN labels USING (doc_id)""")
def prj_compose_text(t):
    df = t.raw("documents").select("doc_id", "source", "lang").join(t.raw("labels"), "doc_id", "left")
    return clean.compose_text(df, ["source", "quality", "lang"]).select("doc_id", "text")


@query("prj_drop_null_attrs", """SELECT '{"doc_id":' || doc_id || coalesce(',"quality":' || quality, '') || ',"lang":"' || lang || '"}' AS item
    FROM documents LEFT JOIN labels USING (doc_id)""")
def prj_drop_null_attrs(t):
    df = t.raw("documents").select("doc_id", "lang").join(t.raw("labels"), "doc_id", "left")
    return tables.item_json(df.select("doc_id", "quality", "lang"))


@query("prj_decimal_safe", """SELECT p_partkey, CAST(CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(38,18)) AS VARCHAR) AS price_text,
    p_retailprice AS price_back FROM part""")
def prj_decimal_safe(t):
    d = C.to_decimal("p_retailprice")
    return t.raw("part").select("p_partkey", d.cast("string").alias("price_text"), C.to_double(d).alias("price_back"))


@query("prj_dates_to_text", "SELECT user_id, strftime(created_at, '%Y-%m-%d') AS created_at FROM users_v")
def prj_dates_to_text(t):
    return clean.dates_to_text(t.users.select("user_id", "created_at"), ["created_at"])


@query("prj_alias_coalesce", """SELECT doc_id, CASE WHEN quality IS NOT NULL AND quality <> 0 THEN quality::DOUBLE
    WHEN toxic IS NOT NULL AND toxic <> 0 THEN toxic::DOUBLE ELSE 0.0 END AS score,
    CASE WHEN lang = 'en' THEN source ELSE lang END AS name FROM documents LEFT JOIN labels USING (doc_id)""")
def prj_alias_coalesce(t):
    df = t.raw("documents").join(t.raw("labels"), "doc_id", "left")
    blank = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return df.select("doc_id", C.first_truthy_number(["quality", "toxic"]).alias("score"),
                     C.first_truthy_text([blank, "source"], "UNKNOWN").alias("name"))


@query("prj_const_flag", "SELECT DISTINCT user_id, product_id, 1 AS purchased_before FROM purchases_v")
def prj_const_flag(t):
    return features.user_product_matrix(t.purchases).select("user_id", "product_id", "purchased_before")


@query("prj_event_normalise", """SELECT event_type, CAST(trunc(value) AS INT) AS price,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS product_name,
    strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp,
    CASE WHEN event_type = 'error' THEN 'U0020' ELSE CAST(user_id AS VARCHAR) END AS user_id FROM events""")
def prj_event_normalise(t):
    raw = t.raw("events").select(
        F.col("event_type").alias("event"), F.col("value").cast("string").alias("price"),
        F.get_json_object("props", "$.k").alias("product_id"), F.lit(None).cast("string").alias("product_name"),
        F.lit(None).cast("string").alias("category"), F.lit(None).cast("string").alias("article_type"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("user_id"))
    return clean.normalise_clicks(raw).drop("category", "article_type")


@query("prj_event_id", "SELECT event_id, event_type, user_id, sha256(event_id || '~' || event_type || '~' || user_id) AS id FROM events")
def prj_event_id(t):
    return clean.event_id(t.raw("events").select("event_id", "event_type", "user_id"))


@query("prj_audit_cols", f"""SELECT user_id, '{PURCHASE_AS_OF}T00:00:00' AS updated_at,
    CAST(epoch(TIMESTAMP '{PURCHASE_AS_OF} 00:00:00') AS BIGINT) + 604800 AS ttl FROM users_v""")
def prj_audit_cols(t):
    return clean.stamp(t.users.select("user_id"), PURCHASE_AS_OF)


@query("prj_display", """SELECT product_id, 'Rs. ' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) AS price_text,
    split_part(product_display_name, ' ', 1) AS first_name FROM products_v""")
def prj_display(t):
    return clean.display_cols(t.products, "price", "product_display_name").select("product_id", "price_text", "first_name")


@query("prj_catalog_page", """SELECT product_id, (i - 1) % 6 AS grid_col, (i - 1) // 6 AS grid_row FROM (SELECT product_id,
    row_number() OVER (ORDER BY product_id) AS i FROM products_v) WHERE i <= 60""")
def prj_catalog_page(t):
    return clean.catalog_page(t.products.select("product_id"))


@query("prj_category_case", """SELECT product_id, CASE b WHEN 0 THEN 1200 WHEN 1 THEN 800 WHEN 2 THEN 300 ELSE 500 END::BIGINT AS band_low,
    CASE b WHEN 0 THEN 3499 WHEN 1 THEN 2499 ELSE 1999 END::BIGINT AS band_high,
    coalesce(price, CASE b WHEN 0 THEN 1200 + product_id * 7919 % 2300 WHEN 1 THEN 800 + product_id * 7919 % 1700
    WHEN 2 THEN 300 + product_id * 7919 % 1700 ELSE 500 + product_id * 7919 % 1500 END)::DOUBLE AS price
    FROM (SELECT p_partkey AS product_id, CASE WHEN p_size > 10 THEN p_retailprice END AS price, p_partkey % 4 AS b FROM part)""")
def prj_category_case(t):
    names = F.array(*[F.lit(x) for x in ("Footwear", "Apparel", "Accessories", "Other")])
    df = t.raw("part").select(F.col("p_partkey").alias("product_id"),
                              F.when(F.col("p_size") > 10, F.col("p_retailprice")).alias("price"),
                              F.get(names, (F.col("p_partkey") % 4).cast("int")).alias("master_category"))
    return clean.price_band_check(clean.impute_price(df)).select("product_id", "band_low", "band_high", "price")


@query("prj_ranked_struct", """SELECT r.user_id, r.rank, r.campaign_id, r.similarity_score, c.name, c.status AS data_status,
    c.template_short AS data_short FROM ranked_v r JOIN campaigns_v c USING (campaign_id)""")
def prj_ranked_struct(t):
    return K.ranked_struct(t.ranked, t.campaigns).select(
        "user_id", "rank", "campaign_id", "similarity_score", "name", F.col("campaign_data.status").alias("data_status"),
        F.col("campaign_data.template_short").alias("data_short"))
