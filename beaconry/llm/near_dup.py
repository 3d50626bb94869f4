"""Near-duplicate documents by a chosen-path similarity join.

Documents with equal shingle sets form a class; only classes take part. A class is embedded as ``COORDINATES`` minwise
tokens. In each of several independent trees a node picks one coordinate (sometimes two) by its own path, and every member goes to
the child named by its minwise token there, so two documents part with probability 1 - similarity at each level. Nodes
of at most ``leaf`` members are compared exhaustively on their minwise tokens; larger nodes branch again. What is still large after
``MOST_LEVELS`` levels is compared in chunks, every chunk with every other.

The number of trees follows from the depth that was really reached: a linked pair survives d levels of a tree with the probability
of ``survival``, and trees are added for the members of deep nodes until a pair is missed by all with probability below ``MISSED``.

A leaf reports the components of its look-alikes as bags of members rather than as pairs, and equal bags of several trees count once. The
full shingle sets of a bag are then compared breadth first, each set against those not yet reached, so the exact components come out without a
row per pair. Bags with too many shingles for one task are compared in chunks, every chunk with every other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.common import connected, give_back, prepare, shingle_sets, stored, text_blocks

COORDINATES = 128
MISSED = 1e-4  # probability that no tree compares a pair just similar enough
SHALLOW = 3  # levels that the first trees are counted for
SKETCH = 64  # coordinates compared inside a leaf
LEAF = 4096
MOST_LEVELS = 16
PART_TOKENS = 4_000_000  # shingles that a task compares at once

_SEEDS = np.array([int.from_bytes(hashlib.blake2b(f"minwise {i}".encode(), digest_size=8).digest(), "big") | 1
                   for i in range(COORDINATES)], dtype=np.uint64)


def minwise(tokens: np.ndarray) -> np.ndarray:
    """For each coordinate 32 bits of the token that its hash function makes smallest."""
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(tokens), 2048):
        part = tokens[start:start + 2048]
        for i in range(0, COORDINATES, 32):
            x = part[None, :] * _SEEDS[i:i + 32, None]
            x ^= x >> np.uint64(29)
            out[i:i + 32] = np.minimum(out[i:i + 32], (x * _SEEDS[i:i + 32, None]).min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _embed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            count, key, tokens = [], [], []
            for own in shingle_sets(texts, size):
                count.append(len(own))
                key.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
                tokens.append(minwise(own) if len(own) else None)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(count, pa.int64()), pa.array(key, pa.binary()),
                 pa.array(tokens, pa.list_(pa.int32()))], names=["doc_id", "text_hash", "n_shingles", "key", "tokens"])

    return run


def _look_alikes(floor: float):
    """Bags of the members of one leaf that are connected by minwise tokens agreeing in a share of at least ``floor``."""

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_pylist()
        tokens = table.column("tokens").combine_chunks()
        rows = tokens.flatten().to_numpy().reshape(len(keys), SKETCH)
        rest = np.arange(len(keys))
        bags, members = [], []
        while len(rest) > 1:
            head, rest = rest[0], rest[1:]
            queue, own = [head], [keys[head]]
            while queue and len(rest):
                at = queue.pop()
                near = (rows[rest] == rows[at]).mean(axis=1) >= floor
                own += [keys[i] for i in rest[near]]
                queue.extend(rest[near])
                rest = rest[~near]
            if len(own) > 1:
                name = hashlib.blake2b(b"".join(sorted(own)), digest_size=8).digest()
                bags += [int.from_bytes(name, "little", signed=True)] * len(own)
                members += own
        return pa.table({"bag": pa.array(bags, pa.int64()), "key": pa.array(members, pa.binary())})

    return run


def _exact_forest(share: int):
    """Components of the members of one bag or chunk pair whose full sets satisfy 100 * |x & y| >= share * |x | y|, as stars."""

    def run(table: pa.Table) -> pa.Table:
        held = dict(zip(table.column("key").to_pylist(), table.column("shingles").to_pylist(), strict=True))  # equal rows count once
        keys, sets = list(held), [np.frombuffer(x, dtype=np.uint64) for x in held.values()]
        sizes = np.array([len(x) for x in sets])
        by = np.argsort(sizes, kind="stable")
        keys, sets, sizes = [keys[i] for i in by], [sets[i] for i in by], sizes[by]
        # local numbers of the shingles, so that membership is one look-up
        _, numbers = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        member = np.zeros(numbers.max() + 1, dtype=bool)
        rest = np.arange(len(keys))
        a, b = [], []
        while len(rest) > 1:
            head, rest = rest[0], rest[1:]
            queue = [head]
            while queue and len(rest):
                at = queue.pop()
                # sizes of similar sets differ by the same share at most
                lo = np.searchsorted(sizes[rest], sizes[at] * share / 100 - 1e-6)
                hi = np.searchsorted(sizes[rest], sizes[at] * 100 / share + 1e-6, side="right")
                some = rest[lo:hi]
                if not len(some):
                    continue
                own = numbers[ends[at] - sizes[at]:ends[at]]
                member[own] = True
                spans = sizes[some]
                place = np.repeat(ends[some] - np.cumsum(spans), spans) + np.arange(spans.sum())
                common = np.add.reduceat(member[numbers[place]].astype(np.int64), np.cumsum(spans) - spans)
                member[own] = False
                near = 100 * common >= share * (sizes[at] + spans - common)
                for i in some[near]:
                    a.append(keys[head])
                    b.append(keys[i])
                queue.extend(some[near])
                rest = np.concatenate([rest[:lo], some[~near], rest[hi:]])
        del held, sets, numbers, member
        give_back()
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _sets(size: int):
    """Texts with the parts that ask for them -> the text's set for each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_blocks(batches):
            # of rows that share an id only those with the text of the class
            rows = [(p, k, x) for x, k, asked in zip((s.tobytes() for s in shingle_sets(texts, size)), part.column("key").to_pylist(),
                                                     part.column("parts").to_pylist(), strict=True)
                    if hashlib.blake2b(x, digest_size=16).digest() == k for p in asked]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["part", "key", "shingles"])

    return run


def survival(similarity: float, depth: int) -> float:
    """Probability that a pair of this similarity shares a node after ``depth`` levels of one tree, coordinates taken as independent."""
    twice, alive = 1 / similarity - 1, 1.0
    for _ in range(depth):
        one = similarity * alive
        alive = (1 - twice) * one + twice * (1 - (1 - one) ** 2)
    return alive


def trees_for(similarity: float, depth: int, missed: float = MISSED) -> int:
    """Trees after which a pair is missed with probability below ``missed``, if nodes end ``depth`` levels down."""
    return math.ceil(math.log(missed) / math.log1p(-survival(similarity, depth)))


def _child(level: int, similarity: float):
    """Path of the children that a member enters: one coordinate by its node, and often enough a second one that 1 / similarity are expected."""
    at = lambda salt: F.pmod(F.xxhash64("path", F.lit(f"{salt} {level}")), F.lit(COORDINATES)).cast("int")
    child = lambda salt: F.xxhash64("path", at(salt), F.col("tokens")[at(salt)])
    twice = F.pmod(F.xxhash64("path", F.lit(f"twice {level}")), F.lit(1000)) < int(1000 * (1 / similarity - 1))
    return F.explode(F.when(twice & (at("one") != at("two")), F.array(child("one"), child("two"))).otherwise(F.array(child("one"))))


def _chunk_pairs(rows: DataFrame, by: str, key: str, chunks: Column) -> DataFrame:
    """Rows of groups that need several chunks, once for every pair of chunks that the row's own belongs to; ``by`` becomes the pair's name."""
    own = F.pmod(F.xxhash64(by, key, F.lit("chunk")), F.col("_n"))
    paired = (rows.withColumn("_n", chunks.cast("int")).withColumn("_own", own.cast("int"))
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).where("_own <> _other OR _n = 1"))
    return paired.withColumn(by, F.when(F.col("_n") == 1, F.col(by)).otherwise(
        F.xxhash64(by, F.least("_own", "_other"), F.greatest("_own", "_other")))).drop("_n", "_own", "_other")


def _grow(classes: DataFrame, similarity: float, trees: range, leaf: int) -> tuple[DataFrame, int, DataFrame | None]:
    """Rows (path, key) of the nodes with 2 to ``leaf`` members of some trees, the depth reached, and the members of nodes deeper than ``SHALLOW``."""
    nodes = classes.select("key", "tokens", F.explode(F.sequence(F.lit(trees.start), F.lit(trees.stop - 1))).alias("tree")).select(
        "key", "tokens", F.xxhash64(F.lit("root"), "tree").alias("path"))
    found = deep = None
    for level in range(1, MOST_LEVELS + 1):
        rows = stored(nodes.select("key", _child(level - 1, similarity).alias("path")), "nodes")
        size = rows.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
        small = rows.join(size.where(F.col("members") <= leaf).select("path"), "path")
        found = small if found is None else found.unionByName(small)
        large = stored(size.where(F.col("members") > leaf), "large")
        if large.isEmpty():
            return found, level, deep
        rows = rows.join(large.select("path"), "path")
        if level == SHALLOW:
            deep = stored(rows.select("key").distinct(), "deep")
        nodes = rows.join(classes.select("key", "tokens"), "key").select("key", "tokens", "path")
    # what agrees on so many coordinates: all chunks of half a leaf against each other
    rest = _chunk_pairs(rows.join(large, "path"), "path", "key", F.ceil(2 * F.col("members") / leaf))
    return found.unionByName(rest.select("path", "key")), MOST_LEVELS, deep


def leaves(classes: DataFrame, similarity: float, leaf: int, missed: float = MISSED) -> DataFrame:
    """Rows (path, key) of the nodes to compare, over as many trees as the depth reached asks for."""
    done = trees_for(similarity, SHALLOW, missed)
    found, depth, deep = _grow(classes, similarity, range(done), leaf)
    while deep is not None and (need := trees_for(similarity, depth, missed)) > done:
        more, reached, _ = _grow(classes.join(deep, "key", "left_semi"), similarity, range(done, need), leaf)
        found, depth, done = found.unionByName(more), max(depth, reached), need
    return found


def near_duplicates(docs: DataFrame, size: int = 5, share: int = 80, leaf: int = LEAF, missed: float = MISSED, with_hash: bool = False) -> DataFrame:
    """Per document doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept; ``with_hash`` adds text_hash.

    Sets are the distinct shingles of ``size`` words, A-Z folded; with fewer words the whole sequence is one shingle. Two
    documents are linked where 100 * |x & y| >= ``share`` * |x | y|; every link is confirmed on full sets. Text that is null, empty or
    without a word gives an empty set, linked with nothing: it is kept as its own component. Texts are read whole, however long. Rows that
    repeat an id each get a row; where they differ in their sets, each has the component of its own set, and one set at most is kept of a
    component. Rows with a null doc_id are returned with a null component and kept. Other columns are ignored; an empty table gives no rows.
    """
    prepare(docs.sparkSession)
    similarity = share / 100
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    embedded = stored(texts.mapInArrow(_embed(size), "doc_id long, text_hash long, n_shingles long, key binary, tokens array<int>"), "embedded")
    named = embedded.where("key IS NOT NULL AND doc_id IS NOT NULL")
    first = stored(named.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("n_shingles").alias("n")), "classes")
    classes = stored(named.join(first, "key").where("doc_id = first").select("key", "tokens").dropDuplicates(["key"]), "representatives")
    small = stored(leaves(classes, similarity, leaf, missed), "leaves")
    # four standard errors below the similarity
    floor = similarity - 4 * math.sqrt(similarity * (1 - similarity) / SKETCH)
    sketches = classes.select("key", F.slice("tokens", 1, SKETCH).alias("tokens"))
    bags = stored(small.join(sketches, "key").groupBy("path").applyInArrow(_look_alikes(floor), "bag long, key binary").distinct(), "bags")
    placed = bags.join(first, "key")
    weight = placed.groupBy("bag").agg(F.sum("n").alias("weight"))
    chunks = F.when(F.col("weight") <= PART_TOKENS, 1).otherwise(F.ceil(2 * F.col("weight") / PART_TOKENS))
    asked = (_chunk_pairs(placed.join(weight, "bag").select("bag", "key", "first", "weight"), "bag", "key", chunks)
             .groupBy(F.col("first").alias("doc_id"), "key").agg(F.collect_set("bag").alias("parts")))  # bounded by trees and chunks
    sets = asked.join(texts, "doc_id").select("parts", "key", "text").mapInArrow(_sets(size), "part long, key binary, shingles binary")
    links = stored(sets.groupBy("part").applyInArrow(_exact_forest(share), "a binary, b binary"), "links")
    joined = connected(links, "binary").select(F.col("id").alias("key"), "root")
    groups = (first.join(joined, "key", "left").withColumn("root", F.coalesce("root", "key")))
    lowest = groups.groupBy("root").agg(F.min(F.struct("first", "key")).alias("low"))
    component = groups.join(lowest, "root").select("key", F.col("low.first").alias("component_id"), F.col("low.key").alias("kept_key"))
    out = embedded.select("doc_id", "n_shingles", "key", "text_hash").join(component, "key", "left")
    kept = F.col("doc_id").isNull() | F.col("key").isNull() | ((F.col("doc_id") == F.col("component_id")) & (F.col("key") == F.col("kept_key")))
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
                     kept.alias("kept"), "text_hash")
    return out if with_hash else out.drop("text_hash")
