"""Service and quality metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.operators.profile import exact_percentiles, share


def latency_percentiles(df: DataFrame, col: str, by: Sequence[str] = (), probs: Sequence[float] = (0.95, 0.99),
                        exact: bool = True) -> DataFrame:
    """Percentiles of a latency column, one row per group: p95, p99, ..."""
    names = {p: f"p{p * 100:g}".replace(".", "_") for p in probs}
    if not exact:
        cols = [F.percentile_approx(col, F.lit(p), 10000).alias(n) for p, n in names.items()]
        return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)
    long = exact_percentiles(df, col, probs, by)
    cols = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in names.items()]
    return long.groupBy(*by).agg(*cols) if by else long.agg(*cols)


def on_time_rate(log: DataFrame, limit_seconds: float, scheduled: str = "scheduled_time",
                 delivered: str = "sent_at") -> DataFrame:
    """Share of notifications delivered no later than the limit after their time."""
    late = (F.unix_micros(F.col(delivered).cast("timestamp"))
            - F.unix_micros(F.col(scheduled).cast("timestamp"))) / F.lit(1_000_000)
    return log.agg(F.count("*").alias("n"), share(late <= limit_seconds).alias("on_time_rate"))


def status_rates(log: DataFrame, by: Sequence[str], status: str = "notification_status") -> DataFrame:
    ok = F.col(status).isin("sent", "clicked")
    return log.groupBy(*by).agg(F.count("*").alias("n"), share(ok).alias("success_rate"),
                                share(F.col(status) == "failed").alias("failure_rate"),
                                share(F.col(status) == "pending").alias("pending_rate"))


def ctr(attributed: DataFrame, by: Sequence[str] = ("campaign_id",)) -> DataFrame:
    """Deliveries, clicked deliveries and their ratio."""
    hit = F.col("click_ts").isNotNull()
    return attributed.groupBy(*by).agg(F.count("*").alias("deliveries"), F.count(F.when(hit, 1)).alias("clicks"),
                                       share(hit).alias("ctr"))


def duplicate_rate(events: DataFrame, key: Sequence[str]) -> DataFrame:
    once = events.groupBy(*key).agg(F.count("*").alias("n"))
    return once.agg(F.sum("n").alias("n_events"), F.count("*").alias("n_distinct")).withColumn(
        "duplicate_rate", 1 - F.col("n_distinct") / F.col("n_events"))


def daily_volume(log: DataFrame, limit: int = 5, ts: str = "sent_at") -> DataFrame:
    """Notifications and users per day, and users above the daily limit."""
    per_user = log.groupBy(F.to_date(ts).alias("day"), "user_id").agg(F.count("*").alias("n"))
    return per_user.groupBy("day").agg(F.sum("n").alias("notifications"), F.count("*").alias("users"),
                                       F.count(F.when(F.col("n") > limit, 1)).alias("users_over_limit"))


def active_users(events: DataFrame, width: str, rsd: float = 0.02, ts: str = "ts") -> DataFrame:
    """Approximate distinct users per window (a sketch of fixed size per window)."""
    return (events.groupBy(F.window(F.col(ts).cast("timestamp"), width).alias("w"))
            .agg(F.approx_count_distinct("user_id", rsd).alias("active_users"))
            .select(F.col("w.start").alias("window_start"), "active_users"))


SKETCH = "minute"


def minute_sketches(events: DataFrame, value: str, by: Sequence[str] = (), user: str = "user_id", ts: str = "ts",
                    lg_users: int = 14, k_values: int = 800) -> DataFrame:
    """One row per minute and group: events, a sketch of the users and one of the values, both as binary and of bounded size.

    Events without a time are left out; NULL users and values are in no sketch.
    """
    minute = F.date_trunc("minute", F.col(ts).cast("timestamp")).alias(SKETCH)
    return (events.where(F.col(ts).isNotNull()).groupBy(minute, *by)
            .agg(F.count("*").alias("n"), F.hll_sketch_agg(user, lg_users).alias("users"),
                 F.kll_sketch_agg_double(F.col(value).cast("double"), k_values).alias("values")))


def store_sketches(sketches: DataFrame, path: str, batch_id: int) -> None:
    """Add a batch's sketches to the stored ones. The batch owns its partitions, so a replayed one replaces itself; a minute may have a row a batch."""
    rows = sketches.withColumns({"day": F.to_date(SKETCH), "batch_id": F.lit(batch_id).cast("long")})
    (rows.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(path))


def merged_sketches(sketches: DataFrame, width: str, by: Sequence[str] = (), lg_users: int = 14) -> DataFrame:
    """Sketches of larger windows from those of their minutes (or of smaller windows): no event is read again."""
    time = "window_start" if "window_start" in sketches.columns else SKETCH
    return (sketches.groupBy(F.window(time, width).alias("w"), *by)
            .agg(F.sum("n").alias("n"), F.hll_union_agg("users", F.lit(True)).alias("users"), F.kll_merge_agg_double("values").alias("values"))
            .select(F.col("w.start").alias("window_start"), *by, "n", "users", "values"))


def sketched(merged: DataFrame, probs: Sequence[float] = (0.95, 0.99)) -> DataFrame:
    """What merged sketches estimate: distinct users, and percentiles of the values (NULL where there are none)."""
    known = F.kll_sketch_get_n_double("values") > 0
    cols = {f"p{p * 100:g}".replace(".", "_"): F.when(known, F.kll_sketch_get_quantile_double("values", F.lit(float(p)))) for p in probs}
    return merged.withColumns({"active_users": F.hll_sketch_estimate("users"), **cols}).drop("users", "values")


def lag_stats(events: DataFrame, width: str, event_ts: str = "ts", arrival_ts: str = "arrived_at") -> DataFrame:
    """Highest and mean seconds between event and arrival, per event-time window."""
    lag = lag_seconds(event_ts, arrival_ts)
    return (events.groupBy(F.window(F.col(event_ts).cast("timestamp"), width).alias("w"))
            .agg(F.count("*").alias("n"), F.max(lag).alias("max_lag"), F.avg(lag).alias("avg_lag"))
            .select(F.col("w.start").alias("window_start"), "n", "max_lag", "avg_lag"))


def lag_seconds(event_ts: str = "ts", arrival_ts: str = "arrived_at") -> Column:
    return (F.unix_micros(F.col(arrival_ts).cast("timestamp"))
            - F.unix_micros(F.col(event_ts).cast("timestamp"))) / F.lit(1_000_000)
