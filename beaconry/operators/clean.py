"""Cleaning and projection operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions import columns as C
from beaconry.sources.tables import keep_latest


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def trim_all(df: DataFrame) -> DataFrame:
    return df.select(*[C.trimmed(c).alias(c) for c in df.columns])


def select_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return require_columns(df, cols).select(*cols)


def cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: C.lenient(c, t) for c, t in types.items()})


def reformat_date(df: DataFrame, col: str, pattern_in: str = "dd-MM-yyyy",
                  pattern_out: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(col, C.reformat_date(col, pattern_in, pattern_out))


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def dedup_keep_first(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    return keep_latest(df, key, order)


def keep_members(df: DataFrame, ids: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(ids.select(*on), list(on), "left_semi")


def compose_text(df: DataFrame, cols: Sequence[str], name: str = "text") -> DataFrame:
    return df.withColumn(name, C.joined_text(cols))


def asset_url(df: DataFrame, id_col: str, prefix: str, suffix: str = ".jpg", name: str = "image_url") -> DataFrame:
    return df.withColumn(name, C.asset_url(id_col, prefix, suffix))


def asset_or_fallback(products: DataFrame, manifest: DataFrame, url_col: str, fallback: str) -> DataFrame:
    """``image_url`` when the manifest lists it, else the fallback image."""
    known = manifest.select(F.col(url_col), F.lit(True).alias("_known")).distinct()
    return (products.join(known, url_col, "left")
            .withColumn("shown_url", F.when(F.col("_known"), F.col(url_col)).otherwise(F.lit(fallback)))
            .drop("_known"))


def dates_to_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in cols})


def active_campaigns(df: DataFrame, as_of: str) -> DataFrame:
    day = F.lit(as_of).cast("date")
    return df.filter((F.col("status") == "active") & day.between(F.col("start_date"), F.col("end_date")))


def stamp(df: DataFrame, as_of: str, ttl_days: int = 7) -> DataFrame:
    """Audit columns: time of the run, and the epoch second the row expires."""
    at = F.lit(as_of).cast("timestamp")
    return df.withColumns({"updated_at": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"),
                           "ttl": F.unix_timestamp(at) + F.lit(ttl_days * 86400)})


def display_cols(df: DataFrame, price: str = "price", name: str | None = None) -> DataFrame:
    out = df.withColumn("price_text", C.price_text(F.coalesce(F.col(price), F.lit(0))))
    return out.withColumn("first_name", C.first_name(name)) if name else out


def catalog_page(df: DataFrame, n: int = 60, width: int = 6, key: str = "product_id") -> DataFrame:
    """First ``n`` items with their place in a grid; the window sees ``n`` rows only."""
    w = W.partitionBy(F.lit(0)).orderBy(key)
    at = F.row_number().over(w) - 1
    return (df.orderBy(key).limit(n).withColumn("_i", at)
            .withColumn("grid_col", F.pmod(F.col("_i"), F.lit(width)).cast("bigint"))
            .withColumn("grid_row", F.floor(F.col("_i") / width).cast("bigint")).drop("_i"))


def price_band_check(df: DataFrame, category: str = "master_category", price: str = "price") -> DataFrame:
    low, high = C.price_band(category)
    return df.withColumns({"band_low": low.cast("bigint"), "band_high": (high - 1).cast("bigint"),
                           "in_band": (F.col(price) >= low) & (F.col(price) < high)})


def impute_price(df: DataFrame, id_col: str = "product_id", category: str = "master_category",
                 price: str = "price") -> DataFrame:
    return df.withColumn(price, F.coalesce(F.col(price).cast("double"),
                                           C.imputed_price(id_col, category).cast("double")))


def normalise_clicks(df: DataFrame, default_user: str = "U0020") -> DataFrame:
    """Flat click records from parsed click messages (columns of ``CLICK_JSON``)."""
    return df.select(
        F.col("event").alias("event_type"),
        C.lenient("price", "int").alias("price"),
        C.lenient("product_id", "bigint").alias("product_id"),
        "product_name", "category", "article_type", "timestamp",
        F.coalesce(F.col("user_id"), F.lit(default_user)).alias("user_id"),
    )


def event_id(df: DataFrame, name: str = "id") -> DataFrame:
    """Surrogate id from all fields, so a replayed message gets the same id."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.withColumn(name, F.sha2(F.concat_ws("~", *parts), 256))
