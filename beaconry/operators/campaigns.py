"""Campaign ranking by cosine similarity."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions import columns as C
from beaconry.functions import vectors as V
from beaconry.operators import serving, tiles
from beaconry.session import cut

# A campaign side within both bounds is shipped to every task; a larger one is tiled.
LOCAL_ROWS = 20_000
LOCAL_BYTES = 64 << 20
USERS_PER_CHUNK = 16_384
CAMPAIGNS_PER_CHUNK = 16_384
MAX_SERVED = 20


def with_vector(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The given columns and the vector of the rows that have one."""
    return df.filter(F.size("embedding") > 0).select(*cols, F.col("embedding").cast("array<double>").alias("embedding"))


def _policy(users: DataFrame, dim_policy: str, dim: int | None) -> DataFrame:
    """'truncate' compares the first block of a longer user vector, 'mean' the average block."""
    if dim_policy == "truncate":
        return users
    if dim_policy == "mean":
        return users.withColumn("embedding", V.block_mean("embedding", dim))
    raise ValueError(dim_policy)


def first_block(embedding, dim: int) -> Column:
    """First ``dim`` entries and one more that keeps the length (norm) of the whole vector.

    A score needs no more than that, so this is what is shuffled.
    """
    whole, head = C.as_col(embedding), F.slice(embedding, 1, dim)
    rest = F.sqrt(F.aggregate(F.slice(whole, dim + 1, F.greatest(F.size(whole) - dim, F.lit(0))), F.lit(0.0),
                              lambda s, x: s + x * x))
    return F.when(F.size(whole) <= dim, whole).otherwise(F.concat(head, F.array(rest)))


class _Block:
    """Campaigns in id order with their vectors and norms, ready for a task."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by("campaign_id")
        self.ids = self.table.column("campaign_id").combine_chunks()
        self.matrix, self.norms = tiles.vectors_of(self.table.column("embedding"))

    def scores(self, vectors) -> Iterator[tuple[int, int, np.ndarray]]:
        """Cosines rounded to 4 places for row batches: dot over the common length, 0 for a zero norm."""
        left, norms = tiles.vectors_of(vectors, self.matrix.shape[1])
        for s, e in tiles.row_batches(len(norms), len(self.norms)):
            scale = norms[s:e, None] * self.norms[None, :]
            dots = left[s:e] @ self.matrix.T
            yield s, e, np.round(np.divide(dots, scale, out=np.zeros_like(dots), where=scale != 0), 4) + 0.0

    def picked(self, keys, rows: np.ndarray, cols: np.ndarray, score: np.ndarray, place: np.ndarray,
               key: str) -> pa.Table:
        return pa.table({key: _flat(keys).take(pa.array(rows)), "campaign_id": self.ids.take(pa.array(cols)),
                         "similarity_score": pa.array(score), "rank": pa.array(place.astype(np.int64))})


def _flat(col) -> pa.Array:
    if not isinstance(col, pa.ChunkedArray):
        return col
    return pa.concat_arrays(col.chunks) if col.num_chunks else pa.array([], type=col.type)


def _best(key: str, k: int):
    def run(block: _Block, batch) -> Iterator[pa.Table]:
        for s, _, score in block.scores(batch.column("embedding")):
            rows, cols, place = tiles.best_columns(score.copy(), k)
            yield block.picked(batch.column(key), rows + s, cols, score[rows, cols], place, key)

    return run


def _summed(block: _Block, batch) -> Iterator[pa.Table]:
    for s, e, score in block.scores(batch.column("embedding")):
        yield pa.table({"user_id": _flat(batch.column("user_id")).slice(s, e - s),
                        "campaigns": pa.array(np.full(e - s, score.shape[1], dtype=np.int64)),
                        "total": pa.array(score.sum(axis=1)), "low": pa.array(score.min(axis=1)),
                        "high": pa.array(score.max(axis=1))})


def _served(block: _Block, batch) -> Iterator[pa.Table]:
    """Best campaigns of each request among those it allows."""
    def numbers(table, name: str) -> np.ndarray:
        return _flat(table.column(name)).to_numpy(zero_copy_only=False)

    start, end = numbers(block.table, "start"), numbers(block.table, "end")
    opens, closes, most = numbers(batch, "opens"), numbers(batch, "closes"), numbers(batch, "most")
    off, banned = tiles.list_parts(batch.column("banned"))
    at = pc.index_in(pa.array(banned[off[0]:off[-1]], pa.string()), value_set=block.ids)
    ban_col = at.fill_null(-1).to_numpy(zero_copy_only=False)
    ban_row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    for s, e, score in block.scores(batch.column("embedding")):
        open_score = score.copy()
        open_score[(start[None, :] > closes[s:e, None]) | (opens[s:e, None] > end[None, :])] = -np.inf
        mine = (ban_row >= s) & (ban_row < e) & (ban_col >= 0)
        open_score[ban_row[mine] - s, ban_col[mine]] = -np.inf
        rows, cols, place = tiles.best_columns(open_score, MAX_SERVED)
        few = place <= most[rows + s]
        rows, cols, place = rows[few], cols[few], place[few]
        yield block.picked(batch.column("request_id"), rows + s, cols, score[rows, cols], place, "request_id")


class _Side:
    """The campaign side, fetched only after an aggregate has shown that it is within the local bounds.

    Within the bounds every task scores its rows against all campaigns and no vector is
    shuffled; beyond them both sides meet in tiles. Both give the same rows.
    """

    def __init__(self, campaigns: DataFrame):
        self.df = campaigns
        size = campaigns.agg(F.count("*").alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("dim"),
                             F.coalesce(F.sum(8 * F.size("embedding") + 64), F.lit(0)).alias("bytes")).first()
        self.rows, self.dim = size["n"], size["dim"]
        self.local = campaigns.toArrow() if self.rows <= LOCAL_ROWS and size["bytes"] <= LOCAL_BYTES else None

    def slim(self, left: DataFrame) -> DataFrame:
        """Left vectors cut to what a campaign can meet (see ``first_block``)."""
        return left.withColumn("embedding", first_block("embedding", self.dim))

    def against(self, left: DataFrame, key: str, how, schema: str) -> DataFrame:
        """Apply ``how(block, batch)`` to the left rows against all campaigns, in bounded pieces."""
        some = self.local
        if some is not None:
            def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                block = _Block(some) if some.num_rows else None
                for b in batches:
                    if block is not None and b.num_rows:
                        for t in how(block, b):
                            yield from t.to_batches()

            return left.mapInArrow(scan, schema)

        left = cut(left)  # counted and tiled from one computation
        empty = left.sparkSession.createDataFrame([], schema).toArrow()

        def tile(users: pa.Table, block: pa.Table) -> pa.Table:
            if not users.num_rows or not block.num_rows:
                return empty
            return pa.concat_tables(list(how(_Block(block), users)))

        return tiles.pair_tiles(left, self.df, key, "campaign_id", tiles.chunk_count(left.count(), USERS_PER_CHUNK),
                                tiles.chunk_count(self.rows, CAMPAIGNS_PER_CHUNK), tile, schema)


def _ranked(side: _Side, left: DataFrame, key: str, how, k: int) -> DataFrame:
    """(key, campaign_id, similarity_score, rank) of the ``k`` best; the left keys are unique.

    Where a task sees all campaigns its places are the ranks; otherwise tiles are merged.
    """
    kind = left.schema[key].dataType.simpleString()
    found = side.against(left, key, how, f"{key} {kind}, campaign_id string, similarity_score double, rank bigint")
    return found if side.local is not None else _final_rank(found.drop("rank"), k, key)


def _final_rank(scored: DataFrame, k: int, key: str = "user_id") -> DataFrame:
    w = W.partitionBy(key).orderBy(F.col("similarity_score").desc(), "campaign_id")
    return scored.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)


def campaign_topk(users: DataFrame, campaigns: DataFrame, k: int = 10, dim_policy: str = "truncate",
                  dim: int | None = None) -> DataFrame:
    """The ``k`` best campaigns of each user by cosine rounded to 4 places, then campaign id.

    Columns: user_id, campaign_id, similarity_score, rank. Rows without a vector are skipped.
    """
    side = _Side(with_vector(campaigns, ["campaign_id"]))
    u = side.slim(with_vector(_policy(users, dim_policy, dim), ["user_id"]))
    return _ranked(side, u, "user_id", _best("user_id", k), k)


def score_summary(users: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Every user against every campaign, folded to one row per user: count, mean, low, high."""
    schema = (f"user_id {users.schema['user_id'].dataType.simpleString()}, campaigns bigint, total double, "
              "low double, high double")
    side = _Side(with_vector(campaigns, ["campaign_id"]))
    parts = side.against(side.slim(with_vector(users, ["user_id"])), "user_id", _summed, schema)
    return parts.groupBy("user_id").agg(
        F.sum("campaigns").alias("campaigns"), (F.sum("total") / F.sum("campaigns")).alias("mean_score"),
        F.min("low").alias("low_score"), F.max("high").alias("high_score"))


def serve_requests(requests: DataFrame, users: DataFrame, campaigns: DataFrame, campaign_vectors: DataFrame,
                   ctr: DataFrame | None = None) -> DataFrame:
    """Ranked campaigns per request: exclusions and time window applied, cut to the wanted number.

    ``requests``: request_id, user_id, num_recommendations, exclude_campaign_ids,
    window_start, window_end (dates, or times whose time of day counts; an open end always overlaps). The filters act on the scores
    inside the tasks, so no request can run short of campaigns and at most
    ``MAX_SERVED`` rows per request leave a task.
    """
    moment = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    asked = requests.select(
        "request_id", "user_id", serving.wanted(F.col("num_recommendations")).cast("bigint").alias("most"),
        F.filter(F.coalesce("exclude_campaign_ids", F.array().cast("array<string>")), lambda c: c.isNotNull()).alias("banned"),
        F.coalesce(moment("window_start"), F.lit(-(1 << 62))).alias("opens"), F.coalesce(moment("window_end"), F.lit(1 << 62)).alias("closes"))
    dated = campaign_vectors.join(campaigns.select(
        "campaign_id", serving.runs_from(F.col("start_date")).alias("start"), serving.runs_to(F.col("end_date")).alias("end")), "campaign_id")
    side = _Side(with_vector(dated, ["campaign_id", "start", "end"]))
    left = asked.join(side.slim(with_vector(users, ["user_id"])), "user_id").select(
        "request_id", "most", "banned", "opens", "closes", "embedding")
    found = _ranked(side, left, "request_id", _served, MAX_SERVED)
    info = campaigns.select("campaign_id", F.col("name").alias("campaign_name"),
                            serving.priority_text(F.col("priority")).alias("priority"), "start_date", "end_date",
                            F.date_format("start_date", "yyyy-MM-dd'T'00:00:00'Z'").alias("time_window_start"),
                            F.date_format("end_date", "yyyy-MM-dd'T'23:59:59'Z'").alias("time_window_end"))
    out = (found.join(asked.select("request_id", "user_id", "most"), "request_id").filter(F.col("rank") <= F.col("most"))
           .drop("most").join(info, "campaign_id"))
    if ctr is None:
        return out.withColumn("estimated_ctr", F.lit(None).cast("double"))
    return out.join(ctr.select("campaign_id", F.col("ctr").alias("estimated_ctr")), "campaign_id", "left")


def campaign_topk_ann(users: DataFrame, campaigns: DataFrame, dim: int, k: int = 10, bucket_length: float = 1.0,
                      tables: int = 8, seed: int = 7) -> DataFrame:
    """Approximate ``campaign_topk``: only campaigns sharing a random-projection bucket are scored.

    Every bucket is scored in tiles of bounded size, so a crowded bucket costs more tiles
    and never a larger task; scores are exact cosines. ``largest_cell`` is the highest
    number of campaigns scored at once for the row, to be read beside the recall.
    """
    user_type = users.schema["user_id"].dataType.simpleString()
    u = with_vector(users, ["user_id"]).withColumn("embedding", first_block("embedding", dim)).filter(
        V.is_nonzero(F.slice("embedding", 1, dim)))
    c = with_vector(campaigns, ["campaign_id"]).filter(V.is_nonzero("embedding"))
    u = u.withColumn("_v", array_to_vector(V.unit(F.slice("embedding", 1, dim))))
    c = c.withColumn("_v", array_to_vector(V.unit("embedding")))
    lsh = BucketedRandomProjectionLSH(inputCol="_v", outputCol="_h", bucketLength=bucket_length,
                                      numHashTables=tables, seed=seed)
    model = lsh.fit(c)

    def cells(df: DataFrame, key: str) -> DataFrame:
        # Hashed once; the cells are counted first and filled afterwards.
        hashed = cut(model.transform(df).select(key, "embedding", "_h"))
        return hashed.select(key, "embedding", F.posexplode("_h").alias("table", "_b")).select(key, "embedding", "table",
                             F.get(vector_to_array("_b"), 0).cast("bigint").alias("bucket"))

    schema = f"user_id {user_type}, campaign_id string, similarity_score double, scored bigint"
    empty = u.sparkSession.createDataFrame([], schema).toArrow()
    best = _best("user_id", k)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        t = pa.concat_tables(list(best(_Block(right), left))).drop_columns(["rank"])
        return t.append_column("scored", pa.array(np.full(t.num_rows, right.num_rows, dtype=np.int64)))

    found = tiles.cell_tiles(cells(u, "user_id"), cells(c, "campaign_id"), ["table", "bucket"], "user_id",
                             "campaign_id", USERS_PER_CHUNK, CAMPAIGNS_PER_CHUNK, tile, schema)
    once = found.groupBy("user_id", "campaign_id").agg(F.max("similarity_score").alias("similarity_score"),
                                                       F.max("scored").alias("largest_cell"))
    return _final_rank(once, k)


def item_vectors(df: DataFrame, id_cols: list[str], vector_cols: list[str]) -> DataFrame:
    """(campaign_id, embedding) from schemaless items that name their fields differently."""
    return df.select(C.first_truthy_text(id_cols).alias("campaign_id"),
                     C.first_truthy_array(vector_cols).alias("embedding"))


def ranked_struct(ranked: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Ranked rows with name, description and the whole campaign as one nested column."""
    whole = campaigns.select("campaign_id", F.struct(*campaigns.columns).alias("campaign_data"))
    return (ranked.join(whole, "campaign_id", "left")
            .withColumn("name", F.col("campaign_data.name"))
            .withColumn("description", F.col("campaign_data.description")
                        if "description" in campaigns.columns else F.lit(None).cast("string")))


def top_recommendation(ranked: DataFrame) -> DataFrame:
    return ranked.filter(F.col("rank") == 1)


def recommendation_reply(ranked: DataFrame, campaigns: DataFrame, k: int = 10) -> DataFrame:
    """One JSON-in-JSON reply per user: top recommendation and the top ``k`` list."""
    full = ranked_struct(ranked.filter(F.col("rank") <= k), campaigns)
    entry = F.struct("campaign_id", "similarity_score", "name", "description", "campaign_data")
    per_user = full.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("rank", entry.alias("e")))).alias("_l"))
    body = F.to_json(F.struct("user_id", F.col("_l")[0]["e"].alias("top_recommendation"),
                              F.transform("_l", lambda x: x["e"]).alias("top_10")))
    return per_user.select("user_id", F.to_json(F.struct(F.lit(200).alias("statusCode"), body.alias("body"))).alias("reply"))
