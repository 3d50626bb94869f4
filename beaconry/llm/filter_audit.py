"""Interaction of document filters, by counting paths through the lattice of filter subsets.

A filter pipeline walks from the empty set of applied filters to the full one, one filter an edge. What an edge removes depends
only on the set it starts from: the documents that fail its filter and none applied before. So all orders share 2^n states and n * 2^(n - 1)
edges. Counting paths forward gives the orders that reach a state, counting backward those that lead on from it; their product over an
edge is the number of orders that walk it. Removals weighted by it are Shapley values (as sums over all orders), and the steps
of a single order are read off the edges on its path.

Documents are folded to the set of filters they fail before anything else: a part has at most 2^n rows, however many documents.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import GAP, prepare, stored

MOST_FILTERS = 7  # n! orders are listed


def lattice(n: int) -> list[tuple[int, int, int]]:
    """Edges (state, filter, orders that walk it) of the lattice of subsets of ``n`` filters; a state is the bit mask of those applied."""
    full = (1 << n) - 1
    forward, backward = [0] * (full + 1), [0] * (full + 1)
    forward[0] = backward[full] = 1
    for state in range(full + 1):
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in range(full, -1, -1):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return [(state, f, forward[state] * backward[state | 1 << f]) for state in range(full + 1) for f in range(n) if not state >> f & 1]


def audit(failed: DataFrame, filters: str) -> DataFrame:
    """What every filter does at every step of every order, from rows (part, mask, n, good, toxic).

    ``filters`` names each filter by one letter; bit i of ``mask`` says that ``n`` documents fail the i-th, ``good`` and ``toxic`` count
    such ones among them. Rows of one part and mask add up. Returns per part all orders with the columns filter_order, step, kept, removed, redundant,
    unique_fails, good_lost, toxic_lost and shapley; parts without rows don't appear.
    """
    n = len(filters)
    if n > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters: every order is listed")
    spark = failed.sparkSession
    edges = F.array(*(F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(1 << f).alias("bit"), F.lit(w).cast("long").alias("orders")) for s, f, w in lattice(n)))
    # at most 2^n rows a part are listed
    lists = (failed.groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
             .groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks")))

    def total(column: str, which) -> Column:
        return F.aggregate(F.filter("masks", lambda m: which(m["mask"])), F.lit(0).cast("long"), lambda t, m: t + m[column])

    fails = lambda m: m.bitwiseAND(F.col("bit")) != 0
    caught = lambda m: m.bitwiseAND(F.col("state")) != 0
    walked = (lists.select("part", "masks", F.explode(edges).alias("e")).select("part", "masks", "e.*").select(
        "part", "state", "filter", "orders",
        total("n", lambda m: ~fails(m) & ~caught(m)).alias("kept"), total("n", lambda m: fails(m) & ~caught(m)).alias("removed"),
        total("n", lambda m: fails(m) & caught(m)).alias("redundant"), total("n", lambda m: m == F.col("bit")).alias("unique_fails"),
        total("good", lambda m: fails(m) & ~caught(m)).alias("good_lost"), total("toxic", lambda m: fails(m) & ~caught(m)).alias("toxic_lost")))
    walked = stored(walked, "edges")
    shapley = walked.groupBy("part", "filter").agg(F.sum(F.col("removed") * F.col("orders")).alias("shapley"))
    steps = [("".join(filters[f] for f in order), k + 1, sum(1 << f for f in order[:k]), order[k])
             for order in permutations(range(n)) for k in range(n)]
    orders = spark.createDataFrame(steps, "filter_order string, step int, state int, filter int")  # n * n! rows
    return (walked.join(shapley, ["part", "filter"]).join(F.broadcast(orders), ["state", "filter"])
            .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))


FILTERS = "ABCDE"


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows (part, mask, n, good, toxic): how many documents of each source fail which of the five filters.

    A: under 50 words. B: under 65 % distinct words. C: over 5 % capitals A-Z. D: a character of ``#$%&*|``. E: the text of a smaller
    doc_id. Copies of a text fold into one row a source before they meet, so a text on a third of all documents is no hot key.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"),
        F.array_remove(F.split(text, GAP, -1), "").alias("words"))
    fails = [F.size("words") < 50, 100 * F.size(F.array_distinct("words")) < 65 * F.size("words"),
             100 * F.length(F.regexp_replace("text", "[^A-Z]+", "")) > 5 * F.length("text"), F.col("text").rlike(r"[#$%&*|]")]
    mask = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails)), F.lit(0))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        *(F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(to) for c, to in (("quality", "good"), ("toxic", "toxic"))))
    kind = ["digest", "part", "mask", "good", "toxic"]
    # one row an id and text, then one a text and source: its documents, and how many of them bear the smallest id
    single = (rows.join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
              .groupBy("doc_id", *kind).agg(F.count("*").alias("n")))
    contents = stored(single.groupBy(*kind).agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNotNull(), F.col("n"))), F.lit(0)).alias("named"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least")), "contents")
    first = contents.groupBy("digest").agg(F.min("least.doc_id").alias("first"))
    copies = F.col("named") - F.when(F.col("least.doc_id") == F.col("first"), F.col("least.n")).otherwise(0)
    both = (contents.join(first, "digest").withColumn("copies", copies)
            .select("part", "good", "toxic", F.explode(F.array(F.struct("mask", (F.col("n") - F.col("copies")).alias("n")),
                                                               F.struct((F.col("mask") + 16).alias("mask"), F.col("copies").alias("n")))).alias("e"))
            .where("e.n > 0"))
    counted = lambda c: F.sum(F.when(F.col(c), F.col("e.n")).otherwise(0)).alias(c)
    return both.groupBy("part", F.col("e.mask").alias("mask")).agg(F.sum("e.n").alias("n"), counted("good"), counted("toxic"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters of ``failures`` for every source: 120 orders of five steps each.

    Null text counts as empty, however long a text is it is judged whole; a null source is the empty string. Rows without id fail E never and
    make no other fail it; rows that repeat an id each count, and are no copies of each other. Of several labels of an id the greatest counts.
    Other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    return audit(stored(failures(docs, labels), "failures"), FILTERS)
