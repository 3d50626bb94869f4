"""Mixing of sources by temperature.

A source with share p of all tokens gets weight p ** t / sum of all p ** t. The exponent t is the smallest (flattest mixture) that
meets the limit: with a repetition limit no source is gone through more often than ``repeats`` times, with a target
entropy the mixture has at most that entropy. The budget is what gives the least favoured source one full pass, so no row is
lost: every source is passed through whole some times, and once more in part.

Each pass of a source is a permutation of its blocks, ordered by a hash of seed, pass and block; the last pass ends with the block that brings
it nearest to the budget. Blocks are hash classes of doc_id, a fixed number per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconry.llm.common import GAP, prepare, stored

BLOCKS = 512
REPEATS = 2.0
STEPS = 50


def exponent(shares: list[float], repeats: float | None = None, entropy: float | None = None) -> float:
    """Exponent in [0, 1] by bisection; 1 leaves the natural mixture."""
    def fits(t: float) -> bool:
        powers = [p ** t for p in shares]
        total = sum(powers)
        weights = [x / total for x in powers]
        if entropy is not None:
            return -sum(w * math.log(w) for w in weights if w > 0) <= entropy
        passes = [w / p for w, p in zip(weights, shares, strict=True)]
        return max(passes) <= repeats * min(passes) * (1 + 1e-12)

    if not shares or fits(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if fits(middle) else (middle, high)
    return high


def _place(*parts: Column) -> Column:
    """A number of 52 bits from the digest of the parts; the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("long")


def plan(sizes: DataFrame, repeats: float | None, entropy: float | None) -> DataFrame:
    """Per source its tokens, weight and budget. Bisection is over one number per source: their table is small, one row each."""
    rows = [r for r in sizes.groupBy("source_key").agg(F.sum("tokens").alias("tokens")).orderBy("source_key").collect() if r["tokens"] > 0]
    total = sum(r["tokens"] for r in rows)
    shares = [r["tokens"] / total for r in rows]
    t = exponent(shares, repeats, entropy)
    norm = sum(p ** t for p in shares)
    weights = [p ** t / norm for p in shares]
    budget = max((r["tokens"] / w for r, w in zip(rows, weights, strict=True)), default=0.0)
    return sizes.sparkSession.createDataFrame(
        [(r["source_key"], r["tokens"], w, int(round(w * budget))) for r, w in zip(rows, weights, strict=True)],
        "source_key string, source_tokens long, weight double, budget long")


def mix(docs: DataFrame, repeats: float | None = REPEATS, entropy: float | None = None, seed: int = 17, keep: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, source, n_tokens, weight, pass, block, place) of the mixture; ``keep`` names further columns to carry.

    ``pass`` counts from 0; within a source rows are read by pass, place, block and doc_id. Tokens are words. Rows without a word have no tokens and
    go along with their block; a source without any token is passed through once. A null source is a source of its own, null ids share a block;
    repeated rows are rows; long texts are counted whole. Other columns are dropped unless kept, and kept ones may not bear a name of the result; an
    empty table gives an empty mixture.
    """
    if clash := sorted({c.lower() for c in keep or ()} & {"n_tokens", "weight", "pass", "block", "place"}):
        raise ValueError(f"kept columns bear names of the result: {clash}")
    prepare(docs.sparkSession)
    words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), GAP, -1), "")).cast("long")
    key = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    block = F.pmod(_place(F.lit("block"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(BLOCKS)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words.alias("n_tokens"),
                       key.alias("source_key"), block.alias("block"), *[F.col(c).alias(f"_{c}") for c in keep or ()])
    blocks = stored(rows.groupBy("source_key", "block").agg(F.sum("n_tokens").alias("tokens")), "blocks")
    target = plan(blocks, repeats, entropy)
    # at most BLOCKS rows of a source meet in a window
    passes = (blocks.join(target, "source_key", "left")
              .withColumn("whole", F.coalesce(F.floor(F.col("budget") / F.col("source_tokens")), F.lit(1)).cast("int"))
              .withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("whole"))))
              .withColumn("place", _place(F.lit(str(seed)), "source_key", F.col("pass").cast("string"), F.col("block").cast("string"))))
    upto = Window.partitionBy("source_key", "pass").orderBy("place", "block")
    rest = F.col("budget") - F.col("whole") * F.col("source_tokens")
    before = F.sum("tokens").over(upto) - F.col("tokens")
    taken = (passes.withColumn("before", before)
             .where((F.col("pass") < F.col("whole")) | (2 * (rest - F.col("before")) > F.col("tokens"))))
    taken = taken.select("source_key", "block", F.coalesce("weight", F.lit(0.0)).alias("weight"), "pass", "place")
    return rows.join(taken, ["source_key", "block"]).select(
        "doc_id", "source", "n_tokens", "weight", "pass", "block", "place", *[F.col(f"_{c}").alias(c) for c in keep or () if c not in ("doc_id", "source")])
