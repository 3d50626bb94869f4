"""Request tables: status codes, exclusions and time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.session import cut

DEFAULT_N, MAX_N = 10, 20


def priority_text(c: Column) -> Column:
    """Text of a numeric priority: 4 is medium, all below low, all above high; NULL stays NULL."""
    return F.when(c < 4, "low").when(c == 4, "medium").when(c > 4, "high")


def wanted(n: Column) -> Column:
    return F.least(F.coalesce(n, F.lit(DEFAULT_N)), F.lit(MAX_N))


def exclude_campaigns(ranked: DataFrame, requests: DataFrame) -> DataFrame:
    """Drop the campaigns each request lists in ``exclude_campaign_ids``."""
    banned = requests.select("request_id", F.explode("exclude_campaign_ids").alias("campaign_id"))
    return ranked.join(banned, ["request_id", "campaign_id"], "left_anti")


def runs_from(c: Column) -> Column:
    """A campaign's first day begins at midnight; times are compared in microseconds."""
    return F.unix_micros(c.cast("timestamp"))


def runs_to(c: Column) -> Column:
    """It ends with the second before midnight of its last day."""
    return F.unix_micros(c.cast("timestamp")) + (86400 - 1) * 1_000_000


def _meets(window_start: Column, window_end: Column, start: Column, end: Column) -> Column:
    moment = lambda c: F.unix_micros(c.cast("timestamp"))
    return (start <= F.coalesce(moment(window_end), start)) & (F.coalesce(moment(window_start), end) <= end)


def overlapping(ranked: DataFrame) -> DataFrame:
    """Keep campaigns whose days overlap the requested window, times of day included; an open end always overlaps."""
    return ranked.filter(_meets(F.col("window_start"), F.col("window_end"), runs_from(F.col("start_date")), runs_to(F.col("end_date"))))


def window_overlaps(windows: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Interval join: (window_id, campaign_id) of the windows that a campaign runs in, each pair once.

    Windows (window_id, window_start, window_end; open where NULL) and campaigns are cut into days and joined by day; the first
    day that both have decides, so a pair is met once however long both are. Open ends reach as far as there are campaigns.
    A campaign without a date or that ends before it starts overlaps nothing.
    """
    days = lambda a, b: F.explode(F.sequence(a, b)).alias("_day")
    runs = campaigns.where("start_date <= end_date").select("campaign_id", F.to_date("start_date").alias("start_date"), F.to_date("end_date").alias("end_date"))
    reach = runs.agg(F.min("start_date").alias("_lo"), F.max("end_date").alias("_hi"))  # one row
    first = F.greatest(F.coalesce(F.to_date("window_start"), F.col("_lo")), F.col("_lo"))
    last = F.least(F.coalesce(F.to_date("window_end"), F.col("_hi")), F.col("_hi"))
    asked = (windows.select("window_id", "window_start", "window_end").join(F.broadcast(reach)).withColumns({"_first": first, "_last": last})
             .where("_first <= _last").select("window_id", "window_start", "window_end", "_first", days(F.col("_first"), F.col("_last"))))
    met = asked.join(runs.select("*", days(F.col("start_date"), F.col("end_date"))), "_day").where(F.col("_day") == F.greatest("_first", "start_date"))
    return met.where(_meets(F.col("window_start"), F.col("window_end"), runs_from(F.col("start_date")), runs_to(F.col("end_date")))).select("window_id", "campaign_id")


def _best(rows: DataFrame, k: int) -> DataFrame:
    from pyspark.sql import Window as W

    w = W.partitionBy("request_id").orderBy(F.col("similarity_score").desc(), "campaign_id")
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def best_allowed(requests: DataFrame, ranked: DataFrame, k: int) -> DataFrame:
    """(request_id, campaign_id): the ``k`` best of a request's user that it does not exclude.

    ``ranked`` needs, per user, ``k`` campaigns more than a request excludes at most: whatever it drops, enough are left.
    """
    rows = requests.select("request_id", "user_id").join(ranked.select("user_id", "campaign_id", "similarity_score"), "user_id")
    return _best(exclude_campaigns(rows, requests), k).select("request_id", "campaign_id")


WINDOW_PAIRS = 1_000_000  # allowed (window, campaign) pairs up to which their lists are sent to every task


def best_in_window(requests: DataFrame, ranked: DataFrame, campaigns: DataFrame, k: int) -> DataFrame:
    """(request_id, campaign_id): the ``k`` best of a request's user among the campaigns that run in its window.

    Requests share few windows, so the interval join is made once a window and not once a request. ``ranked`` holds all campaigns of a user;
    they travel as one ordered list a user that meets the window's list inside the join, and only the ``k`` best leave it.
    """
    from pyspark.sql import Window as W

    window = F.sha2(F.to_json(F.struct("window_start", "window_end"), {"ignoreNullFields": "false"}), 256).alias("window_id")
    asked = requests.select("request_id", "user_id", "window_start", "window_end", window)
    pairs = cut(window_overlaps(asked.dropDuplicates(["window_id"]), campaigns).distinct())
    allowed = pairs.groupBy("window_id").agg(F.collect_list("campaign_id").alias("_allowed"))
    allowed = F.broadcast(allowed) if pairs.count() <= WINDOW_PAIRS else allowed
    far = F.when(F.isnan("similarity_score"), F.lit(float("-inf"))).otherwise(-F.col("similarity_score"))
    lists = ranked.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct(far.alias("far"), "campaign_id"))).alias("_list"))
    lists = lists.withColumn("_ids", F.array_distinct(F.transform("_list", lambda e: e["campaign_id"])))
    # a request that comes several times has its rows ranked together
    asked = asked.select("request_id", "user_id", "window_id", F.count("*").over(W.partitionBy("request_id")).alias("_same"))
    # in the order of the user's list; a user that has campaigns more than once keeps their rows
    best = F.slice(F.array_intersect("_ids", "_allowed"), 1, k)
    entries = F.slice(F.filter("_list", lambda e: F.array_contains(best, e["campaign_id"])), 1, k)

    def met(some: DataFrame) -> DataFrame:
        return some.join(lists, "user_id").join(allowed, "window_id")

    plain = F.when(F.size("_ids") == F.size("_list"), best).otherwise(F.transform(entries, lambda e: e["campaign_id"]))
    once = met(asked.where("_same = 1")).select("request_id", F.explode(plain).alias("campaign_id"))
    again = met(asked.where("_same > 1")).select("request_id", F.explode(entries).alias("_e")).select(
        "request_id", "_e.campaign_id", (-F.col("_e.far")).alias("similarity_score"))
    return once.unionByName(_best(again, k).select("request_id", "campaign_id"))


def request_status(requests: DataFrame, user_vectors: DataFrame, campaigns_ready: bool = True) -> DataFrame:
    """status and error_code per request: missing user id or a number out of bounds, unknown user, no vector,
    no campaigns."""
    known = user_vectors.select("user_id", F.coalesce(F.size("embedding") > 0, F.lit(False)).alias("_has"))
    number = F.col("num_recommendations") if "num_recommendations" in requests.columns else F.lit(None).cast("int")
    code = (F.when(F.col("user_id").isNull() | F.coalesce((number < 1) | (number > MAX_N), F.lit(False)), "INVALID_REQUEST")
            .when(F.col("_has").isNull(), "USER_NOT_FOUND")
            .when(~F.col("_has"), "EMBEDDING_NOT_AVAILABLE"))
    if not campaigns_ready:
        code = code.otherwise("CAMPAIGN_EMBEDDINGS_UNAVAILABLE")
    return (requests.join(known, "user_id", "left").withColumn("error_code", code)
            .withColumn("status", F.when(F.col("error_code").isNull(), "success").otherwise("error")).drop("_has"))


def with_status(requests: DataFrame, results: DataFrame, user_vectors: DataFrame) -> DataFrame:
    """Every request with its results, or with one error row."""
    checked = request_status(requests, user_vectors)
    extra = [c for c in results.columns if c not in ("user_id",)]
    joined = checked.join(results, "user_id", "left")
    none = F.col("error_code").isNull() & F.col(extra[0]).isNull()
    return joined.withColumn("error_code", F.when(none, "CAMPAIGN_EMBEDDINGS_UNAVAILABLE").otherwise(
        F.col("error_code"))).withColumn("status", F.when(F.col("error_code").isNull(), "success").otherwise("error"))
