"""Delivery log, click attribution, de-duplication and alert throttling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.session import cut

DAY = 86400
LONG_RUN = 1_000_000  # rows of a run that one task still folds
STEPS = 1024  # parts of a window, in which the next row is looked for


def micros(col: str):
    return F.unix_micros(F.col(col).cast("timestamp"))


def attribute_clicks(deliveries: DataFrame, clicks: DataFrame, horizon_seconds: int) -> DataFrame:
    """First click of the same user within the horizon after each delivery (NULL if none).

    A delivery without user or time has no click: such rows stay out of the buckets and are put back at the end.

    ``deliveries`` need user_id and sent_at, ``clicks`` user_id, click_id and click_ts.
    A user's time line is cut into horizon-long buckets; a delivery looks into its own
    bucket and the next, so each click is put into two. Inside a bucket one pass from
    the latest row back carries the click last met: no pairs are formed, and a busy user
    is spread over as many tasks as there are buckets.
    """
    h = horizon_seconds * 1_000_000
    no_click = F.lit(None).cast(clicks.schema["click_id"].dataType)
    known = F.col("user_id").isNotNull() & F.col("sent_at").isNotNull()
    left = deliveries.filter(known).select(F.col("user_id").alias("_u"), micros("sent_at").alias("_at"),
                             F.struct(*deliveries.columns).alias("_d"), no_click.alias("_id"))
    left = left.withColumn("_b", F.floor(F.col("_at") / h))
    click = clicks.filter(F.col("user_id").isNotNull() & F.col("click_ts").isNotNull()).withColumn("_at", micros("click_ts"))
    bucket = F.floor(F.col("_at") / h)
    right = click.select(F.col("user_id").alias("_u"), "_at", F.lit(None).cast(left.schema["_d"].dataType).alias("_d"),
                         F.col("click_id").alias("_id"), F.explode(F.array(bucket, bucket - 1)).alias("_b"))
    # Clicks come before deliveries of the same time, the lowest id last.
    back = (W.partitionBy("_u", "_b").orderBy(F.col("_at").desc(), F.col("_d").isNotNull(), F.col("_id").desc())
            .rowsBetween(W.unboundedPreceding, W.currentRow))
    met = F.last(F.when(F.col("_d").isNull(), F.struct("_at", "_id")), ignorenulls=True).over(back)
    near = F.col("_f._at") - F.col("_at") <= h
    found = (left.unionByName(right).withColumn("_f", met).filter(F.col("_d").isNotNull())
             .select("_d.*", F.when(near, F.col("_f._id")).alias("click_id"),
                     F.when(near, F.timestamp_micros(F.col("_f._at"))).alias("click_ts")))
    alone = deliveries.filter(~known).withColumns({"click_id": no_click, "click_ts": F.lit(None).cast("timestamp")})
    return found.unionByName(alone)


def delivery_log(attributed: DataFrame) -> DataFrame:
    """Status per notification: failed, clicked, sent or pending, with delivery and click time."""
    status = (F.when(F.col("failed"), "failed").when(F.col("click_ts").isNotNull(), "clicked")
              .when(F.col("sent_at").isNotNull(), "sent").otherwise("pending"))
    return attributed.withColumn("notification_status", status).withColumn("delivery_time", F.when(
        ~F.col("failed"), F.col("sent_at"))).withColumn("click_time", F.when(~F.col("failed"), F.col("click_ts")))


def _stretches(batch: pa.RecordBatch, *cols: str) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of rows that agree in ``cols``."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[:1] = True
    for c in cols:
        v = batch.column(c).to_numpy(zero_copy_only=False)
        new[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(new).tolist()
    yield from zip(starts, [*starts[1:], batch.num_rows])


def quarantined(df: DataFrame, *times: str) -> DataFrame:
    """Rows that ``dedup_within`` and ``throttle`` leave out, since a time that they need is NULL."""
    missing = F.lit(False)
    for c in times:
        missing = missing | F.col(c).isNull()
    return df.filter(missing)


def dedup_within(df: DataFrame, key: str, ts: str, tie: str, window_seconds: int = DAY, long_run: int = LONG_RUN) -> DataFrame:
    """Keep a row unless a kept row of the same key lies less than the window before it.

    Rows without a time can't be placed and are left out; ``quarantined`` gives them.

    The first row of a key and every row at least one window after the row before it are
    kept whatever came earlier; they start a run. Only rows inside a run depend on the
    fold. Runs, not keys, are the unit of work, so a key with many copies spreads out as
    soon as it pauses once, and a task reads its runs as a stream with one number of state.

    A run of more than ``long_run`` rows is not left to one task: each of its rows points to
    the first row a window later, and the kept rows are those met from the run's start. The
    pointers are doubled from round to round, so the rounds grow with the logarithm of the kept rows.
    """
    width = window_seconds * 1_000_000
    rows = df.filter(F.col(ts).isNotNull()).withColumn("_at", micros(ts))
    cells = _run_cells(rows, key, width)
    long = cut(cells.groupBy("_run").agg(F.sum("_rows").alias("_rows")).where(F.col("_rows") > long_run).select("_run"))
    # Copies at the very same time: only the first by ``tie`` can be kept.
    first = W.partitionBy(key, "_at").orderBy(tie)
    rows = rows.withColumn("_rn", F.row_number().over(first)).filter("_rn = 1").drop("_rn")
    runs = _with_runs(rows, key, width, cells)
    if long.isEmpty():
        return _fold_runs(runs, df, width)
    short = _fold_runs(runs.join(long, "_run", "left_anti"), df, width)
    whole = runs.join(long, "_run", "left_semi")
    kept = _followed(whole.select("_run", "_at"), width)
    return short.unionByName(whole.join(kept, ["_run", "_at"], "left_semi").select(*df.columns))


def _fold_runs(runs: DataFrame, df: DataFrame, width: int) -> DataFrame:
    cols = df.columns

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, last = None, None
        for b in batches:
            at, keep = b.column("_at").to_numpy(), []
            for s, e in _stretches(b, "_run"):
                name = b.column("_run")[s].as_py()
                i = s if name != run else s + int(np.searchsorted(at[s:e], last + width))
                run = name
                while i < e:  # from each kept row straight to the next
                    keep.append(i)
                    last = int(at[i])
                    i += int(np.searchsorted(at[i:e], last + width))
            yield b.take(pa.array(keep, pa.int64())).select(cols)

    placed = runs.repartition("_run").sortWithinPartitions("_run", "_at")
    return placed.select(*cols, "_at", "_run").mapInArrow(fold, df.schema)


def _run_cells(rows: DataFrame, key: str, width: int) -> DataFrame:
    """Coarse cells of one width that hold rows: key, cell, number of rows, and ``_run``, the key and start of the run they lie in.

    A run is a stretch of rows with no gap of ``width`` or more. The window over a key sees one row per filled cell
    instead of all its rows.
    """
    cells = rows.groupBy(F.col(key).alias("_key"), F.floor(F.col("_at") / width).alias("_in")).agg(
        F.min("_at").alias("_lo"), F.max("_at").alias("_hi"), F.count("*").alias("_rows"))
    order = W.partitionBy("_key").orderBy("_in")
    starts = cells.withColumn("_prev", F.lag("_hi").over(order)).withColumn(
        "_new", F.when(F.col("_prev").isNull() | (F.col("_lo") - F.col("_prev") >= width), F.col("_lo")))
    return starts.select("_key", "_in", "_rows", F.concat_ws("~", F.col("_key").cast("string"), F.max("_new").over(order).cast("string")).alias("_run"))


def _with_runs(rows: DataFrame, key: str, width: int, cells: DataFrame) -> DataFrame:
    at = F.floor(F.col("_at") / width)
    return (rows.withColumn("_cell", at)
            .join(cells.drop("_rows"), F.col(key).eqNullSafe(F.col("_key")) & (F.col("_cell") == F.col("_in")))
            .drop("_cell", "_in", "_key"))


def _next_rows(points: DataFrame, width: int) -> DataFrame:
    """(_run, _at, _next): for every row of a run the first one at least ``width`` later; rows without one are left out.

    Times are cut into small cells. A row asks in the cell of its time plus ``width``: one pass from the latest
    entry back carries the row last met; where that finds none, the next filled cell has it.
    """
    fine = max(1, width // STEPS)
    none = F.lit(None).cast("bigint")
    both = (points.select("_run", F.col("_at").alias("_t"), F.col("_at").alias("_to"), none.alias("_from"))
            .unionByName(points.select("_run", (F.col("_at") + width).alias("_t"), none.alias("_to"), F.col("_at").alias("_from")))
            .withColumn("_cell", F.floor(F.col("_t") / fine)))
    back = W.partitionBy("_run", "_cell").orderBy(F.col("_t").desc(), F.col("_to").isNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    asked = both.withColumn("_near", F.last("_to", ignorenulls=True).over(back)).where("_from IS NOT NULL")
    later = W.partitionBy("_run").orderBy(F.col("_cell").desc()).rowsBetween(W.unboundedPreceding, -1)
    cells = both.groupBy("_run", "_cell").agg(F.min("_to").alias("_low")).withColumn("_after", F.last("_low", ignorenulls=True).over(later))
    return (asked.join(cells.select("_run", "_cell", "_after"), ["_run", "_cell"])
            .select("_run", F.col("_from").alias("_at"), F.coalesce("_near", "_after").alias("_next")).where("_next IS NOT NULL"))


def _followed(points: DataFrame, width: int) -> DataFrame:
    """(_run, _at) of the rows met from each run's first row by ``_next_rows``, in a logarithm of joins."""
    jumps = cut(_next_rows(points, width))
    kept = cut(points.groupBy("_run").agg(F.min("_at").alias("_at")))
    while True:
        # ``kept`` holds the first 2^i rows, a jump goes 2^i rows further
        new = cut(kept.join(jumps, ["_run", "_at"]).select("_run", F.col("_next").alias("_at")))
        if new.isEmpty():
            return kept
        kept = cut(kept.unionByName(new))
        further = jumps.select("_run", F.col("_at").alias("_next"), F.col("_next").alias("_then"))
        jumps = cut(jumps.join(further, ["_run", "_next"]).select("_run", "_at", F.col("_then").alias("_next")))


def throttle(df: DataFrame, user: str = "user_id", ts: str = "ts", text: str = "text", start: str = "session_start",
             min_gap_seconds: int = 40) -> DataFrame:
    """Alerts that are shown: text not yet shown in the session, and the gap since the last alert kept.

    Alerts without a time or a session start are left out; ``quarantined`` gives them.

    A session is a user and a session start; the first alert is measured from that start.
    What is shown depends on all that was shown before, so the rows of a session are read
    in time order as a stream; the state is the last alert time and the texts shown,
    never the rows. A busy user is spread over the tasks by session.
    """
    gap = min_gap_seconds * 1_000_000
    rows = df.filter(F.col(text).isNotNull() & (F.col(text) != "") & F.col(ts).isNotNull() & F.col(start).isNotNull()).withColumn("_at", micros(ts)).withColumn(
        "_begin", micros(start))
    cols = df.columns

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session, last, shown = None, 0, set()
        for b in batches:
            at, keep = b.column("_at").to_numpy(), []
            coded = b.column(text).dictionary_encode()
            names, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            for s, e in _stretches(b, user, "_begin"):
                who = (b.column(user)[s].as_py(), b.column("_begin")[s].as_py())
                if who != session:
                    session, last, shown = who, who[1], set()
                fresh = np.array([n not in shown for n in names], dtype=bool)
                i = s + int(np.searchsorted(at[s:e], last + gap))
                while i < e:
                    new = fresh[codes[i:e]]
                    if not new.any():
                        break
                    i += int(new.argmax())  # the next alert with a text not shown yet
                    keep.append(i)
                    fresh[codes[i]] = False
                    shown.add(names[codes[i]])
                    last = int(at[i])
                    i += int(np.searchsorted(at[i:e], last + gap))
            yield b.take(pa.array(keep, pa.int64())).select(cols)

    # Of rows of the same session, time and text the first in this order is shown or none is: the others find their text shown.
    rest = [c for c in cols if c not in (user, text)]
    placed = rows.repartition(user, "_begin").sortWithinPartitions(user, "_begin", "_at", text, *rest)
    return placed.mapInArrow(fold, df.schema)
