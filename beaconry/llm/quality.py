"""Quality classifier by hierarchical empirical Bayes.

A logistic model on text statistics gives each document's evidence. Sites are judged by grouped aggregation: the evidence of a
path's documents is shrunk towards its host, a host's towards the corpus, each by a beta prior whose strength is estimated
from how much sites differ beyond chance. The posterior of a document adds the log odds of its path (its own evidence left
out) over the corpus to its own log odds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import prepare, shingle_sets, stored, text_blocks
from beaconry.llm.logistic import bounded, fit, logit, matrix

TRAIN_ROWS = 10_000  # of each label
THRESHOLD = 0.5
UNIT = 1_000_000  # probabilities are added as whole millionths: sums don't depend on their order
STRENGTH = (2.0, 10_000.0)  # bounds of a prior's rows


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z]+://(?:[^/@]*@)?([^/:?#]*)", 1))


def path_of(url: Column) -> Column:
    """The first directory of a URL's path."""
    return F.regexp_extract(url, r"^[a-zA-Z]+://[^/?#]*/([^/?#]*)", 1)


def measures(texts: list[bytes]) -> np.ndarray:
    """Per text: logarithm of its words, word length, shares of symbols, exclamation marks, bars, capitals and digits, repeated
    neighbours, distinct words, distinct shingles and distinct lines."""
    out = np.zeros((len(texts), 11))
    for row, text, shingles in zip(out, texts, shingle_sets(texts, 3), strict=True):
        words = text.split()
        n = max(1, len(words))
        counts = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
        lines = [x for x in text.split(b"\n") if x]
        row[:] = (np.log1p(len(words)), np.log1p(sum(map(len, words)) / n), np.log1p(10 * counts[list(b"#*$%&<>@")].sum() / n),
                  np.log1p(10 * counts[33] / n), np.log1p(10 * counts[124] / n), counts[65:91].sum() / max(1, len(text)),
                  counts[48:58].sum() / max(1, len(text)), sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
                  np.log(max(1, len(set(words))) / n), np.log(max(1, len(shingles)) / max(1, n - 2)),
                  np.log(max(1, len(set(lines))) / max(1, len(lines))))
    return out


def _evidence(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            p = 1 / (1 + np.exp(-logit(measures(texts), model))) if len(model[1]) else np.full(len(texts), 1 / (1 + np.exp(-model[0][0])))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("host"), part.column("path"),
                                              pa.array(np.rint(p * UNIT).astype(np.int64)), part.column("text_hash")],
                                             names=["doc_id", "host", "path", "p", "text_hash"])

    return run


def _sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_blocks(batches):
        yield pa.RecordBatch.from_arrays([pa.array(list(measures(texts)), pa.list_(pa.float64())), part.column("quality"), part.column("weight")],
                                         names=["x", "quality", "weight"])


def _strength(rates: DataFrame) -> Column:
    """Rows that a prior is worth, by moments, from groups with columns n, s (sum of probabilities) and prior rate m."""
    rate = F.col("s") / F.col("n")
    spread = F.sum(F.col("n") * (rate - F.col("m")) ** 2) / F.sum("n")
    chance = F.sum(F.col("m") * (1 - F.col("m"))) / F.sum("n")  # of the means, were all sites alike
    within = F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))) / F.sum("n")
    return F.least(F.greatest(within / F.greatest(spread - chance, F.lit(1e-9)) - 1, F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))


def site_posteriors(scored: DataFrame) -> DataFrame:
    """Rows (host, path, n, s, prior, strength): what a path's documents say and the prior that its host gives it."""
    paths = stored(scored.groupBy("host", "path").agg(F.count("*").alias("n"), (F.sum("p") / UNIT).alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    corpus = hosts.agg((F.sum("s") / F.sum("n")).alias("m"))  # one row
    level = hosts.join(F.broadcast(corpus))
    host_strength = level.agg(_strength(level).alias("k"))  # one row
    theta = level.join(F.broadcast(host_strength)).select(
        F.col("host").alias("of"), "m", ((F.col("s") + F.col("k") * F.col("m")) / (F.col("n") + F.col("k"))).alias("theta"))
    below = paths.join(theta, F.col("host").eqNullSafe(F.col("of"))).drop("of")
    path_strength = below.select("n", "s", F.col("theta").alias("m")).agg(_strength(below).alias("strength"))  # one row
    return below.join(F.broadcast(path_strength)).select("host", "path", "n", "s", "m", F.col("theta").alias("prior"), "strength")


def quality_classifier(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
                       threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS, with_row: bool = False) -> DataFrame:
    """Per row doc_id, evidence, site (posterior rate of its path without the row itself), posterior and kept; ``with_row`` adds
    host, path and text_hash, which name a row among those that share its id.

    ``host`` and ``path`` are columns of ``docs``; by default its source and language. The model is fitted on at most about ``train_rows``
    rows of each quality label; of several labels of an id the greatest counts, null labels none. Null text counts as empty, and a text is
    measured whole, however long; null hosts and paths are sites of their own. Repeated rows count and are returned one by one, rows without id too. Without labels the evidence is
    the same for all and everything is kept. Other columns are ignored.
    """
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        (F.col("source") if host is None else host).cast("string").alias("host"),
                        (F.col("lang") if path is None else path).cast("string").alias("path"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    marks = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").cast("int").alias("quality"))
    marks = bounded(marks, "doc_id", "quality", train_rows).select("doc_id", "quality", "weight")  # about 2 * train_rows rows
    # one row of each id: marks are bounded, rows that repeat an id are not
    train = (texts.join(F.broadcast(marks), "doc_id").groupBy("doc_id")
             .agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.first("quality").alias("quality"), F.first("weight").alias("weight")))
    sample = train.select("text", "quality", "weight").mapInArrow(_sample, "x array<double>, quality int, weight double").collect()  # bounded
    model = fit(matrix([r["x"] for r in sample]), np.array([r["quality"] for r in sample], dtype=float), counts=np.array([r["weight"] for r in sample]))
    scored = stored(texts.mapInArrow(_evidence(model), "doc_id long, host string, path string, p long, text_hash long"), "evidence")
    sites = site_posteriors(scored).withColumnsRenamed({"host": "h", "path": "q"})
    found = scored.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    bound = lambda x: F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = lambda x: F.log(bound(x) / (1 - bound(x)))
    p = F.col("p") / UNIT
    site = (F.col("s") - p + F.col("strength") * F.col("prior")) / (F.col("n") - 1 + F.col("strength"))
    total = odds(p) + odds(F.col("site")) - odds(F.col("m"))
    row = ["host", "path", "text_hash"] if with_row else []
    return (found.withColumn("site", site).select("doc_id", p.alias("evidence"), "site", (1 / (1 + F.exp(-total))).alias("posterior"), *row)
            .withColumn("kept", F.col("posterior") >= threshold))
