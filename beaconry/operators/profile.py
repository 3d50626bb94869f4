"""Table profiles: keys, nulls, frequencies, exact percentiles, describe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from beaconry.session import cut


def key_profile(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys and rows; the second level adds up one row per key."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).agg(
        F.count("*").alias("distinct_keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column: nulls and non-nulls, in a single pass over the table."""
    counts = df.agg(F.count("*").alias("_all"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"),
                                 (F.col("_all") - F.col(c)).alias("nulls"),
                                 F.col(c).alias("non_nulls")) for c in df.columns])
    return counts.select(F.inline(entries))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), F.col(col).asc_nulls_last())


GRID = 64  # parts into which a bracket is refined
MOST = 1 << 20  # rows of a bracket that are ranked in one window


def exact_percentiles(df: DataFrame, col: str, probs: Sequence[float], by: Sequence[str] = (),
                      accuracy: int = 10000, most: int = MOST) -> DataFrame:
    """Exact interpolated percentiles without holding or sorting all values.

    A quantile sketch (one small row per group) brackets each wanted rank within its
    error bound. A second pass over the rows folds all that lies below a bracket into one
    count inside the map tasks, and only the few distinct values inside it are ranked.
    Ranks that the counts don't confirm, and brackets that would hold more than ``most`` rows,
    are found by ``_refined`` instead. Returns ``by`` columns, ``prob`` and ``value``.
    """
    by = list(by)
    keys = by or ["_all"]
    df = df if by else df.withColumn("_all", F.lit(0))
    rows = df.select(*keys, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    slack = 4.0 / accuracy
    few = F.col("_n") < 2 * accuracy  # there the bracket may be narrower than a rank
    edges = F.array(*[F.lit(min(max(p + s, 0.0), 1.0)) for p in probs for s in (-slack, slack)])
    sketch = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", edges, accuracy).alias("_e"), F.count("*").alias("_n"),
        F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    wanted = F.array(*[F.struct(
        F.lit(float(p)).alias("prob"),
        F.when(few | F.lit(p <= slack), F.col("_min")).otherwise(F.col("_e")[2 * i]).alias("lo"),
        F.when(few | F.lit(p >= 1 - slack), F.col("_max")).otherwise(F.col("_e")[2 * i + 1]).alias("hi"))
        for i, p in enumerate(probs)])
    brackets = cut(sketch.select(*keys, "_n", "_min", "_max", wanted.alias("_w")))
    narrow = F.when(few, F.col("_n")).otherwise(2 * slack * F.col("_n")) <= most
    # One row per group, also for a NULL one; without groups a single row. Spark chooses the join by its size.
    cells = _met(rows, brackets.where(narrow).select(*keys, "_n", "_w"), keys).select(*keys, "_v", "_n", F.inline("_w")).filter(F.col("_v") <= F.col("hi"))
    inside = F.when(F.col("_v") >= F.col("lo"), F.col("_v"))
    counted = cells.groupBy(*keys, "prob", "_n", inside.alias("_v")).agg(F.count("*").alias("_c"))
    upto = W.partitionBy(*keys, "prob").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(
        W.unboundedPreceding, W.currentRow)
    ranked = counted.withColumn("_last", F.sum("_c").over(upto)).withColumn("_first", F.col("_last") - F.col("_c"))
    at = (F.col("_n") - 1) * F.col("prob")
    lower, upper = F.floor(at), F.ceil(at)
    met = cut(ranked.groupBy(*keys, "prob", "_n").agg(
        F.max(F.when((F.col("_first") <= lower) & (lower < F.col("_last")), F.col("_v"))).alias("_a"),
        F.max(F.when((F.col("_first") <= upper) & (upper < F.col("_last")), F.col("_v"))).alias("_z")))
    value = (F.col("_a") + (F.col("_z") - F.col("_a")) * (at - lower)).alias("value")
    missed = F.col("_a").isNull() | F.col("_z").isNull()
    open_ = (met.where(missed).select(*keys, "prob")
             .unionByName(brackets.where(~narrow).select(*keys, F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))))
    out = met.where(~missed).select(*by, "prob", value)
    if open_.isEmpty():
        return out
    ends = _met(open_, brackets.select(*keys, "_n", "_min", "_max"), keys).select(*keys, "prob", "_n", "_min", "_max")
    each = ends.select("*", F.explode(F.array_distinct(F.array(lower, upper))).alias("rank"))
    found = _refined(rows, each.select(*keys, "rank", F.col("_min").alias("lo"), F.col("_max").alias("hi"), F.lit(0).cast("bigint").alias("below"),
                                       F.col("_n").alias("inside")).distinct(), keys, accuracy, most)
    pick = lambda rank, name: found.select(*[F.col(k).alias(f"_{name}{i}") for i, k in enumerate(keys)],
                                           F.col("rank").alias(f"_{name}"), F.col("value").alias(name))
    same = lambda name: [F.col(k).eqNullSafe(F.col(f"_{name}{i}")) for i, k in enumerate(keys)]
    both = ends.join(pick("lower", "_a"), [*same("_a"), F.col("__a") == lower]).join(pick("upper", "_z"), [*same("_z"), F.col("__z") == upper])
    return out.unionByName(both.select(*by, "prob", value))


def _met(rows: DataFrame, side: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the columns of their group's entry in ``side``, NULL groups too. The one entry of an ungrouped table is broadcast."""
    side = side.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], *[c for c in side.columns if c not in keys])
    return rows.join(F.broadcast(side) if list(keys) == ["_all"] else side, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])


def _refined(rows: DataFrame, wanted: DataFrame, keys: Sequence[str], accuracy: int, most: int) -> DataFrame:
    """(keys, rank, value) by brackets that are narrowed until they hold at most ``most`` rows or one value.

    ``wanted`` has the keys, a rank (from 0), a bracket ``lo`` to ``hi`` that holds it, and the rows ``below`` and ``inside``.
    Each round takes a grid of quantiles of the bracket's rows and counts what lies below, on, between and above the two
    grid values around the rank. Counts are exact, so the part that holds the rank does, however wrong the grid; grid values are
    values of the rows, so every round leaves at least one behind.
    """
    columns = [*keys, "rank", "lo", "hi", "below", "inside"]
    accuracy = max(accuracy, 4 * GRID)  # a coarser sketch does not tell the parts of the grid apart
    wanted = cut(wanted.select(*columns))
    done = wanted.where((F.col("inside") <= most) | (F.col("lo") == F.col("hi")))
    while True:
        todo = wanted.where((F.col("inside") > most) & (F.col("lo") < F.col("hi")))
        if todo.isEmpty():
            break
        within = (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi"))
        grid = F.array(*[F.lit(i / GRID) for i in range(GRID + 1)])
        step = F.least(F.floor((F.col("rank") - F.col("below")) / F.col("inside") * GRID), F.lit(GRID - 1)).cast("int")
        edges = (_met(rows, todo, keys).where(within).groupBy(*columns).agg(F.percentile_approx("_v", grid, accuracy).alias("_e"))
                 .select(*columns, F.get("_e", step).alias("_a"), F.get("_e", step + 1).alias("_b")))
        edges = cut(edges)
        part = sum(((F.col("_v") >= F.col(c)).cast("int") + (F.col("_v") > F.col(c)).cast("int") for c in ("_a", "_b")), F.lit(0))
        counts = (_met(rows, edges, keys).where(within).groupBy(*columns, part.alias("_p"))
                  .agg(F.count("*").alias("_c"), F.min("_v").alias("_l"), F.max("_v").alias("_h")))
        before = W.partitionBy(*keys, "rank").orderBy("_p").rowsBetween(W.unboundedPreceding, -1)  # five rows at most
        parts = counts.withColumn("_under", F.col("below") + F.coalesce(F.sum("_c").over(before), F.lit(0)))
        wanted = cut(parts.where((F.col("_under") <= F.col("rank")) & (F.col("rank") < F.col("_under") + F.col("_c"))).select(
            *keys, "rank", F.col("_l").alias("lo"), F.col("_h").alias("hi"), F.col("_under").alias("below"), F.col("_c").alias("inside")))
        done = done.unionByName(wanted.where((F.col("inside") <= most) | (F.col("lo") == F.col("hi"))))
    single = done.where(F.col("lo") == F.col("hi")).select(*keys, "rank", F.col("lo").alias("value"))
    several = _met(rows, done.where(F.col("lo") < F.col("hi")), keys).where((F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
    counted = several.groupBy(*keys, "rank", "below", F.col("_v").alias("value")).agg(F.count("*").alias("_c"))
    upto = W.partitionBy(*keys, "rank").orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.col("below") + F.sum("_c").over(upto)
    ranked = counted.withColumn("_last", last).where((F.col("rank") < F.col("_last")) & (F.col("rank") >= F.col("_last") - F.col("_c")))
    return single.unionByName(ranked.select(*keys, "rank", "value"))


def describe(df: DataFrame, col: str) -> DataFrame:
    """One row per statistic of a number column, as pandas names them."""
    v = F.col(col).cast("double")
    base = df.agg(F.count(v).cast("double").alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                  F.min(v).alias("min"), F.max(v).alias("max"))
    stats = base.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("stat"), F.col(n).alias("value")) for n in ("count", "mean", "std", "min", "max")])))
    names = F.concat(F.format_string("%.0f", F.col("prob") * 100), F.lit("%"))
    quart = exact_percentiles(df, col, [0.25, 0.5, 0.75]).select(names.alias("stat"), "value")
    return stats.unionByName(quart)


def describe_text(df: DataFrame, col: str) -> DataFrame:
    """Count, number of distinct values, the most frequent value and its frequency."""
    n = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col(col).alias("v")))
    return n.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.count("*").alias("unique"), best.alias("_b")).select(
        "count", "unique", F.col("_b.v").alias("top"), (-F.col("_b.m")).alias("freq"))


def share(cond: Column) -> Column:
    """Share of rows where ``cond`` holds; NULL counts as no."""
    return F.avg(F.coalesce(cond, F.lit(False)).cast("double"))
