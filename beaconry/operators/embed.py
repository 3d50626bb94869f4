"""Embeddings of texts, purchases and users."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.functions import columns as C
from beaconry.functions import vectors as V
from beaconry.operators.features import last_k
from beaconry.operators.tiles import cores_of
from beaconry.sources.tables import keep_latest
from beaconry.sources.upsert import upsert_merge

# The fields that make up the embedded text.
PRODUCT_TEXT = ["product_display_name", "master_category", "sub_category", "article_type", "base_colour", "usage"]
CAMPAIGN_TEXT = ["name", "description", "status", "priority", "notification_type"]
# What user vectors depend on: among purchases of one date the product decides, and equal products have equal vectors.
VECTOR_COLS = ["user_id", "product_id", "purchase_date"]


def present(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """The wanted columns; one the table lacks counts as missing text."""
    return [F.col(c) if c in df.columns else F.lit(None).cast("string") for c in cols]


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt over the cores before work that is slow beside reading: a small file may come as one task."""
    first = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(first, 3 * cores_of(df)))


def embed_text(df: DataFrame, cols: Sequence[str], dim: int,
               load_encoder: Callable[[], Callable[[list[str]], list[list[float]]]] | None = None) -> DataFrame:
    """Add ``embedding``, the unit vector of the joined text fields.

    By default hashed word counts. ``load_encoder`` plugs in a model: it is called once
    per Python worker and returns a function from texts to vectors.
    """
    df = spread(df)
    text = C.joined_text(present(df, cols))
    if load_encoder is None:
        return df.withColumn("embedding", V.hashed_words(text, dim))

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_encoder()
        for texts in batches:
            yield pd.Series([list(map(float, v)) for v in model(texts.tolist())])

    return df.withColumn("embedding", encode(text))


def or_zeros(vectors: DataFrame, dim: int) -> Column:
    """The joined vector, or zeros, in the stored element type: floats travel at half the size."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    return F.coalesce(F.col("embedding"), F.array_repeat(F.lit(0.0), dim).cast(kind))


def purchase_embeddings(purchases: DataFrame, product_vectors: DataFrame, dim: int) -> DataFrame:
    """One vector per purchase id: that of its product, zeros if the product is unknown.

    Of several rows with one id the last wins: latest date, then highest product id. The
    choice is made before the join, so vectors travel once per kept purchase.
    """
    cols = ["purchase_id", "user_id", "product_id", "total_amount", "purchase_date"]
    rest = [F.col(c).desc() for c in ("purchase_date", "product_id", "total_amount", "user_id")]
    one = keep_latest(purchases.select(*cols), ["purchase_id"], rest)
    joined = one.join(product_vectors.select("product_id", "embedding"), "product_id", "left")
    return joined.select(*cols, or_zeros(product_vectors, dim).cast("array<double>").alias("embedding"))


def user_embeddings(users: DataFrame, purchases: DataFrame, product_vectors: DataFrame, k: int, dim: int,
                    include_inactive: bool = True, order: str = "newest") -> DataFrame:
    """The vectors of a user's last ``k`` purchases, one after the other, zeros to k x dim.

    ``include_inactive`` keeps users without purchases (all zeros).
    """
    needed = VECTOR_COLS if order == "newest" else list(dict.fromkeys(["user_id", "product_id", order]))
    recent = last_k(purchases.select(*needed), k, order).select("user_id", "product_id", "rn")
    blocks = (recent.join(product_vectors.select("product_id", "embedding"), "product_id", "left")
              .select("user_id", "rn", or_zeros(product_vectors, dim).alias("e")))
    lists = F.sort_array(F.collect_list(F.struct("rn", "e")))
    joined = blocks.groupBy("user_id").agg(F.flatten(F.transform(lists, lambda x: x["e"])).alias("embedding"))
    out = users.select("user_id").join(joined, "user_id", "left" if include_inactive else "inner")
    return out.select("user_id", C.pad_vector("embedding", k * dim).alias("embedding"))


def only_users(df: DataFrame, who: DataFrame) -> DataFrame:
    """The rows of ``df`` whose user is among those of ``who``."""
    return df.join(who.select("user_id").distinct(), "user_id", "left_semi")


def latest_embedding(df: DataFrame, version: str | None = None) -> DataFrame:
    """Newest vector per user, or the newest of one model version, with its length."""
    wanted = df if version is None else df.filter(F.col("version") == version)
    newest = keep_latest(wanted, ["user_id"], [F.col("last_updated").desc(), F.col("version").desc()])
    return newest.withColumn("embedding_dimension", F.size("embedding").cast("bigint"))


def content_hash(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumn("content_hash", F.sha2(C.joined_text(present(df, cols)), 256))


def changed_rows(current: DataFrame, stored: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Rows whose text is new or differs from the stored hash."""
    return content_hash(current, cols).join(stored.select(key, "content_hash"), [key, "content_hash"], "left_anti")


def delta_embeddings(stored: DataFrame, current: DataFrame, key: str, cols: Sequence[str], dim: int) -> DataFrame:
    """Stored (key, content_hash, embedding) brought up to date; unchanged texts are not embedded again, rows gone from
    ``current`` go."""
    fresh = embed_text(changed_rows(current, stored, key, cols), cols, dim)
    still = stored.select(key, "content_hash", "embedding").join(current.select(key), key, "left_semi")
    return upsert_merge(still,
                        fresh.select(key, "content_hash", "embedding"), [key], ["content_hash", "embedding"])


def affected_users(purchases: DataFrame, new_purchases: DataFrame, changed_products: DataFrame, k: int) -> DataFrame:
    """Users with a new purchase, or with a changed product among their last ``k``."""
    touched = last_k(purchases, k).join(changed_products.select("product_id"), "product_id", "left_semi")
    return touched.select("user_id").unionByName(new_purchases.select("user_id")).distinct()


def refresh_user_embeddings(stored: DataFrame, users: DataFrame, purchases: DataFrame, new_purchases: DataFrame,
                            product_vectors: DataFrame, changed_products: DataFrame, k: int, dim: int) -> DataFrame:
    """User vectors after a delta, equal to a full computation: only affected users and users not stored yet are computed
    again, users who are gone go."""
    added = users.select("user_id").join(stored.select("user_id"), "user_id", "left_anti")
    who = affected_users(purchases, new_purchases, changed_products, k).unionByName(added).distinct()
    stored = stored.join(users.select("user_id"), "user_id", "left_semi")
    part = user_embeddings(users.join(who, "user_id", "left_semi"), purchases.join(who, "user_id", "left_semi"),
                           product_vectors, k, dim)
    return upsert_merge(stored.select("user_id", "embedding"), part, ["user_id"], ["embedding"])


def recent_state(purchases: DataFrame, k: int) -> DataFrame:
    """The state that user vectors depend on: each user's last ``k`` purchases, at most ``k`` rows a user."""
    return last_k(purchases, k).drop("rn")


def advance_state(state: DataFrame, new_purchases: DataFrame, k: int) -> DataFrame:
    """The state after a delta, from the old state and the delta alone.

    A purchase that is not among a user's last ``k`` never comes back, so the last ``k`` of the state and the delta are those of
    the whole history. Users without a new purchase keep their rows.
    """
    new = new_purchases.select(*state.columns)
    who = new.select(F.col("user_id").alias("_of")).distinct()
    mine = F.col("user_id").eqNullSafe(F.col("_of"))
    moved = last_k(state.join(who, mine, "left_semi").unionByName(new), k).drop("rn")
    return state.join(who, mine, "left_anti").unionByName(moved)


def refresh_from_state(stored: DataFrame, state: DataFrame, users: DataFrame, new_purchases: DataFrame,
                       product_vectors: DataFrame, changed_products: DataFrame, k: int, dim: int) -> tuple[DataFrame, DataFrame]:
    """User vectors and state after a delta, equal to a full computation; the purchase history is not read.

    ``state`` is that of ``advance_state`` before the delta. Only users with a new purchase, a changed product among their
    last ``k`` or no stored vector are computed again.
    """
    after = advance_state(state, new_purchases, k)
    touched = after.join(changed_products.select("product_id"), "product_id", "left_semi").select("user_id")
    added = users.select("user_id").join(stored.select("user_id"), "user_id", "left_anti")
    who = touched.unionByName(new_purchases.select("user_id")).unionByName(added).distinct()
    part = user_embeddings(users.join(who, "user_id", "left_semi"), after.join(who, "user_id", "left_semi"), product_vectors, k, dim)
    still = stored.join(users.select("user_id"), "user_id", "left_semi").select("user_id", "embedding")
    return upsert_merge(still, part, ["user_id"], ["embedding"]), after


def vector_coverage(df: DataFrame, col: str = "embedding") -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.avg(V.is_nonzero(col).cast("double")).alias("coverage"))
