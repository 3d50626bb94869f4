"""One explicit schema per table."""

from pyspark.sql import types as T

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("created_at", T.DateType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType()),
    T.StructField("product_display_name", T.StringType()),
    T.StructField("master_category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("article_type", T.StringType()),
    T.StructField("base_colour", T.StringType()),
    T.StructField("usage", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("image_url", T.StringType()),
])

PURCHASES = T.StructType([
    T.StructField("purchase_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("purchase_date", T.DateType()),
])

CAMPAIGNS = T.StructType([
    T.StructField("campaign_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("priority", T.IntegerType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("notification_type", T.StringType()),
    T.StructField("template_short", T.StringType()),
    T.StructField("template_long", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
])

# JSON body of one click message. Numbers are read as text so that a bad price
# sends the message to quarantine instead of hiding as NULL.
CLICK_JSON = T.StructType([
    T.StructField("event", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("article_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("_corrupt", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
