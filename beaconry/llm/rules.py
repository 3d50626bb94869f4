"""Quality rules: text statistics, fixed base rules and robust multivariate outliers, all in DataFrame functions.

Per language and source the transformed statistics get a minimum-covariance-determinant estimate: from coordinate medians and
deviations, concentration steps keep the share ``SHARE`` of rows nearest by Mahalanobis distance and estimate mean and covariance
anew. Each step lowers the determinant. The covariance is regularised by a diagonal floor, since in clean groups some
statistics hardly vary at all; small groups so lean on the floor. Rows beyond ``CUTOFF`` are rejected.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import GAP, WORD, prepare, stored

WINDOW = 8
SHARE = 0.75
STEPS = 4
CUTOFF = 40.0  # about the 1 - 1.5e-7 quantile of chi-square with five degrees of freedom
CONSISTENCY = 1.41  # covariance of the nearest 75 % of five normal variables to that of all
PRIOR_ROWS = 20.0  # weight of the floor against the rows of a group
FLOOR = {"x0": 1.0, "x1": 0.2, "x2": 0.35, "x3": 0.35, "x4": 0.35}  # standard deviations
NAMES = list(FLOOR)
BINS = 64  # to the unit, for ranks


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed of every whole text."""
    text = F.coalesce("text", F.lit(""))
    words = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        F.array_remove(F.split(text, GAP, -1), "").alias("words"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD)).alias("lines"))
    counted = words.select(
        "doc_id", "lang", "source", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = counted.select("*", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))).alias("windows")).drop("hashes")
    # only texts with a repeated window are sorted
    ordered = windows.select("*", F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.array_sort(
        F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("ordered")).drop("windows")
    same = lambda x, i, step: F.coalesce(F.get("ordered", i + step)["h"] == x["h"], F.lit(False))
    starts = ordered.select("*", F.array_sort(F.transform(
        F.filter("ordered", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"])).alias("starts")).drop("ordered")
    covered = F.aggregate(F.transform("starts", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", i + 1) - p, F.lit(WINDOW)))),
                          F.lit(0).cast("long"), lambda total, n: total + n)
    out = starts.select("*", F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words")).drop("starts")
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _vector() -> list[Column]:
    n = F.greatest("n_words", F.lit(1)).cast("double")
    chars = F.greatest("word_chars", F.lit(1)).cast("double")
    lines = F.greatest("n_lines", F.lit(1)).cast("double")
    return [F.log(n), F.log(chars / n), F.log1p(100 * F.col("n_symbols") / chars), F.log1p(10 * F.col("n_dup_lines") / lines),
            F.log1p(10 * F.col("n_repeat_words") / n)]


def _ranked(rows: DataFrame, by: list[str], value: Column, share: float) -> DataFrame:
    """The value of rank ``share`` within each group, to a bin of 1 / BINS: counts per bin, so no group is sorted."""
    counts = rows.groupBy(*by, F.floor(value * BINS).alias("bin")).agg(F.count("*").alias("c"))
    upto = Window.partitionBy(*by).orderBy("bin")
    whole = Window.partitionBy(*by)
    return (counts.withColumn("upto", F.sum("c").over(upto)).withColumn("all", F.sum("c").over(whole))
            .where(F.col("upto") >= share * F.col("all")).groupBy(*by).agg(((F.min("bin") + 1) / BINS).alias("value")))


def _per_name(rows: DataFrame, value) -> DataFrame:
    """The median of each statistic in each group, as columns."""
    long = rows.select("g", F.explode(F.array(*(F.struct(F.lit(k).alias("name"), value(k).alias("v")) for k in NAMES))).alias("e"))
    ranked = _ranked(long.select("g", "e.name", "e.v"), ["g", "name"], F.col("v"), 0.5)
    return ranked.groupBy("g").agg(*(F.max(F.when(F.col("name") == k, F.col("value"))).alias(f"m_{k}") for k in NAMES))


def _factor(groups: DataFrame) -> DataFrame:
    """From means and the lower covariances s_i_j of each group: the inverse of its Cholesky factor, w_i_j."""
    p = len(NAMES)
    for j in range(p):
        inner = reduce(add, [F.col(f"l_{j}_{k}") ** 2 for k in range(j)], F.lit(0.0))
        groups = groups.withColumn(f"l_{j}_{j}", F.sqrt(F.greatest(F.col(f"s_{j}_{j}") - inner, F.lit(1e-6))))
        groups = groups.withColumns({f"l_{i}_{j}": (F.col(f"s_{i}_{j}") - reduce(add, [F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}") for k in range(j)], F.lit(0.0)))
                                     / F.col(f"l_{j}_{j}") for i in range(j + 1, p)} or {"g": F.col("g")})
    for j in range(p):
        groups = groups.withColumn(f"w_{j}_{j}", 1 / F.col(f"l_{j}_{j}"))
        for i in range(j + 1, p):
            done = reduce(add, [F.col(f"l_{i}_{k}") * F.col(f"w_{k}_{j}") for k in range(j, i)])
            groups = groups.withColumn(f"w_{i}_{j}", -done / F.col(f"l_{i}_{i}"))
    return groups.select("g", *(f"m_{k}" for k in NAMES), *(f"w_{i}_{j}" for i in range(p) for j in range(i + 1)))


def _distance() -> Column:
    z = [F.col(k) - F.col(f"m_{k}") for k in NAMES]
    return reduce(add, [reduce(add, [F.col(f"w_{i}_{j}") * z[j] for j in range(i + 1)]) ** 2 for i in range(len(NAMES))])


def estimates(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """Centre and whitening matrix of every group ``g``, by concentration steps."""
    p = len(NAMES)
    centre = stored(_per_name(rows, F.col), "medians")
    spread = _per_name(rows.join(centre, "g"), lambda k: F.abs(F.col(k) - F.col(f"m_{k}"))).select(
        "g", *(F.col(f"m_{k}").alias(f"d_{k}") for k in NAMES))
    start = centre.join(spread, "g").select("g", *(f"m_{k}" for k in NAMES), *(
        (1 / F.greatest(1.4826 * F.col(f"d_{NAMES[i]}"), F.lit(FLOOR[NAMES[i]])) if i == j else F.lit(0.0)).alias(f"w_{i}_{j}")
        for i in range(p) for j in range(i + 1)))
    for _ in range(steps):
        start = stored(start, "step")
        far = rows.join(start, "g").select("g", *NAMES, F.log1p(_distance()).alias("far"))
        near = far.join(_ranked(far, ["g"], F.col("far"), SHARE), "g").where("far < value")
        moments = near.groupBy("g").agg(F.count("*").alias("n"), *(F.avg(k).alias(f"m_{k}") for k in NAMES), *(
            F.covar_pop(NAMES[i], NAMES[j]).alias(f"c_{i}_{j}") for i in range(p) for j in range(i + 1)))
        weight = F.col("n") / (F.col("n") + PRIOR_ROWS)
        start = _factor(moments.withColumns({f"s_{i}_{j}": CONSISTENCY * weight * F.col(f"c_{i}_{j}") + (F.lit(FLOOR[NAMES[i]] ** 2) if i == j else 0.0)
                                             for i in range(p) for j in range(i + 1)}))
    return stored(start, "step")


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Every document's statistics, base_failed, distance (null if base_failed) and kept.

    Null text has no words and fails the base rules. Null languages and sources form groups of their own. Repeated rows each
    count and each get a row; null ids are kept as rows; other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    group = F.to_json(F.array("lang", "source"))
    rows = stored(statistics(docs).withColumns({"g": group, **dict(zip(NAMES, _vector(), strict=True))}), "statistics")
    fitted = estimates(rows.where("NOT base_failed").select("g", *NAMES))
    out = rows.join(fitted, "g", "left").withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.coalesce(F.col("distance") <= cutoff, F.lit(False)).alias("kept"), "lang", "source", "distance")
