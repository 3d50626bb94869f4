"""Daily send slots and delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.functions import columns as C

SLOTS = 24
MAX_PER_DAY = 5


def slot_order(user: Column, slots: Column | None = None) -> Column:
    """The slots in a repeatable per-user shuffle: by hash of (user, slot), then slot."""
    slots = F.sequence(F.lit(0), F.lit(SLOTS - 1)) if slots is None else slots
    keyed = F.transform(slots, lambda s: F.struct(C.hash_number(user, s).alias("h"), s.alias("s")))
    return F.transform(F.sort_array(keyed), lambda x: x["s"])


def assign_slots(ranked: DataFrame, as_of: str, max_per_day: int = MAX_PER_DAY, score: str = "similarity_score") -> DataFrame:
    """One record per user and date with the list of {campaign_id, timeslot, score}.

    The first ``max_per_day`` recommendations get an hour slot each; the slots of a user are shuffled once.
    """
    entry = F.struct("rank", F.coalesce(F.col("campaign_id"), F.lit("UNKNOWN")).alias("campaign_id"),
                     C.first_truthy_number([score]).alias("score"))
    lists = ranked.filter(F.col("rank") <= max_per_day).groupBy("user_id").agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    slotted = lists.withColumn("_slots", slot_order(F.col("user_id")))
    return slotted.select("user_id", F.lit(as_of).cast("date").alias("date"), F.transform("_l", lambda x: F.struct(
        x["campaign_id"].alias("campaign_id"), F.get("_slots", (x["rank"] - 1).cast("int")).cast("bigint").alias("timeslot"),
        x["score"].alias("score"))).alias("schedule"))


def hour_of(c: Column) -> Column:
    return F.split_part(c, F.lit(":"), F.lit(1)).try_cast("int")


def free_hours(s: Column, e: Column) -> Column:
    """Hours outside the quiet ones: from ``s`` up to ``e``, over midnight if ``e`` is not after ``s``; all if either is NULL."""
    hours = F.sequence(F.lit(0), F.lit(SLOTS - 1))
    return (F.when(s.isNull() | e.isNull(), hours).when(s < e, F.filter(hours, lambda h: (h < s) | (h >= e)))
            .otherwise(F.filter(hours, lambda h: (h < s) & (h >= e))))


def quiet_bounds(start: Column, end: Column) -> tuple[Column, Column]:
    """First quiet hour and the hour after the last; an end with minutes (08:30) also bars its own hour. NULL if nothing is barred."""
    minutes = F.split_part(end, F.lit(":"), F.lit(2)).try_cast("int")
    return F.when(start != end, hour_of(start)), hour_of(end) + F.when(minutes > 0, 1).otherwise(0)


def is_quiet(slot: Column, start: Column, end: Column) -> Column:
    """Whether the hour starting at ``slot`` touches the quiet time; it may cross midnight."""
    return ~F.array_contains(free_hours(*quiet_bounds(start, end)), slot.cast("int"))


def with_slots(users: DataFrame) -> DataFrame:
    """Add ``slots``: free hours, the user's preferred times first (in order of day), then a repeatable shuffle.

    ``users``: user_id, quiet_start, quiet_end, preferred_times. Hours before the end are quiet, so 22:00-08:00 bars 22, 23
    and 0 to 7; equal times bar nothing. Each step is a column of its own, so that it is computed once per user.
    """
    start, end = quiet_bounds(F.col("quiet_start"), F.col("quiet_end"))
    free = users.withColumns({"_s": start, "_e": end}).withColumn("_free", free_hours(F.col("_s"), F.col("_e")))
    likes = F.sort_array(F.transform(F.coalesce("preferred_times", F.array().cast("array<string>")), hour_of))
    first = free.withColumn("_first", F.array_intersect(likes, F.col("_free"))).withColumn(
        "_rest", F.array_except("_free", "_first"))
    return first.withColumn("slots", F.concat("_first", slot_order(F.col("user_id"), F.col("_rest")))).drop(
        "_s", "_e", "_free", "_first", "_rest")


def constraint_error(constraints: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """error_code per user: INVALID_CONSTRAINTS for a bad limit or bad hours, else
    MAX_NOTIFICATIONS_EXCEEDED when more campaigns are asked for than the limit allows."""
    limit = F.col("max_notifications_per_day")

    def clock(c: str) -> Column:
        return F.col(c).rlike("^([01][0-9]|2[0-3]):[0-5][0-9]$")

    bad = (limit.isNull() | (limit < 1) | (limit > MAX_PER_DAY)
           | ~F.coalesce(clock("quiet_start") & clock("quiet_end"), F.lit(False)))
    df = constraints if counts is None else constraints.join(counts, "user_id", "left")
    asked = F.coalesce(F.col("n_campaigns"), F.lit(0)) if counts is not None else F.lit(0)
    code = F.when(bad, "INVALID_CONSTRAINTS").when(asked > limit, "MAX_NOTIFICATIONS_EXCEEDED")
    return df.withColumn("error_code", code).withColumn(
        "status", F.when(F.col("error_code").isNull(), "success").otherwise("error"))


def live_on(campaigns: DataFrame, date: str) -> DataFrame:
    return campaigns.filter(F.lit(date).cast("date").between(F.col("start_date"), F.col("end_date")))


def plan_schedule(ranked: DataFrame, constraints: DataFrame, campaigns: DataFrame, date: str) -> DataFrame:
    """Schedule of one day under each user's constraints.

    ``constraints``: user_id, max_notifications_per_day, quiet_start, quiet_end,
    preferred_times, blackout_dates. ``ranked`` should be ranked among the campaigns of the day only (see ``live_on``):
    a cut made over all campaigns leaves users short. Campaigns whose dates cover the day are ordered by priority,
    then score; the i-th gets the i-th allowed slot; ``sequence`` is by time.
    """
    day = F.lit(date).cast("date")
    ok = constraint_error(constraints).filter("status = 'success'").filter(
        ~F.array_contains(F.coalesce("blackout_dates", F.array().cast("array<date>")), day))
    # Spread by user, as the join below needs: a table of few files is slotted by all tasks.
    rules = with_slots(ok.repartition("user_id")).select(
        "user_id", F.least("max_notifications_per_day", F.lit(MAX_PER_DAY)).alias("_max"), F.slice("slots", 1, MAX_PER_DAY).alias("_slots"))
    live = live_on(campaigns, date).select("campaign_id", "priority")
    w = W.partitionBy("user_id").orderBy(F.col("priority").desc(), F.col("similarity_score").desc(), "campaign_id")
    placed = (ranked.select("user_id", "campaign_id", "similarity_score").join(live, "campaign_id")
              .withColumn("_i", F.row_number().over(w)).filter(F.col("_i") <= MAX_PER_DAY)
              .join(rules, "user_id").filter(F.col("_i") <= F.col("_max"))
              .withColumn("timeslot", F.get("_slots", F.col("_i") - 1)).filter(F.col("timeslot").isNotNull()))
    by_time = W.partitionBy("user_id").orderBy("timeslot")
    at = F.unix_timestamp(day.cast("timestamp")) + F.col("timeslot") * 3600
    return placed.select(
        "user_id", day.alias("schedule_date"), F.row_number().over(by_time).cast("bigint").alias("sequence"),
        "campaign_id", "priority", "similarity_score", F.col("timeslot").cast("bigint").alias("timeslot"),
        F.timestamp_seconds(at).alias("scheduled_time"), F.lit("pending").alias("notification_status"))


def schedule_score(plan: DataFrame) -> DataFrame:
    """Per user and day: notifications and mean similarity held to 0..1."""
    held = F.least(F.greatest(F.col("similarity_score"), F.lit(0.0)), F.lit(1.0))
    return plan.groupBy("user_id", "schedule_date").agg(
        F.count("*").alias("total_scheduled"), F.avg(held).alias("optimization_score"))


def delivery_rules(plan: DataFrame, zones: DataFrame | None = None, default_zone: str = "UTC") -> DataFrame:
    """One delivery rule per notification; the expression is in the user's own time zone."""
    df = plan if zones is None else plan.join(zones.select("user_id", "timezone"), "user_id", "left")
    zone = F.lit(default_zone) if zones is None else F.coalesce(F.col("timezone"), F.lit(default_zone))
    name = F.concat(F.lit("notify-"), F.col("user_id").cast("string"), F.lit("-"), F.col("campaign_id"),
                    F.lit("-seq"), F.col("sequence").cast("string"))
    local = F.date_format(F.from_utc_timestamp("scheduled_time", zone), "yyyy-MM-dd'T'HH:mm:ss")
    return df.select("user_id", "campaign_id", "sequence", name.alias("rule_name"),
                     F.concat(F.lit("at("), local, F.lit(")")).alias("schedule_expression"),
                     zone.alias("timezone"), F.lit("ENABLED").alias("state"))


def due_notifications(schedule: DataFrame, minute: str) -> DataFrame:
    """Pending notifications of one minute, as a plain range so file statistics can prune."""
    start = F.date_trunc("minute", F.lit(minute).cast("timestamp"))
    return schedule.filter((F.col("scheduled_time") >= start)
                           & (F.col("scheduled_time") < start + F.expr("interval 1 minute"))
                           & (F.col("notification_status") == "pending"))


def due_with_context(due: DataFrame, users: DataFrame, campaigns: DataFrame) -> DataFrame:
    u = users.select("user_id", F.col("name").alias("user_name"), "email")
    c = campaigns.select("campaign_id", F.col("name").alias("campaign_name"), "template_long")
    return due.join(u, "user_id", "left").join(c, "campaign_id", "left")


def notification_id(df: DataFrame) -> DataFrame:
    """Idempotent id of a notification: same user, campaign and time give the same id."""
    parts = [F.col("user_id").cast("string"), F.col("campaign_id"),
             F.date_format("scheduled_time", "yyyy-MM-dd'T'HH:mm:ss")]
    return df.withColumn("notification_id", F.sha2(F.concat_ws("~", *parts), 256))
