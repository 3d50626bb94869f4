"""Products of listed pairs of vectors against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from beaconry.functions import vectors as V
from beaconry.operators import pairs as P


def nodes(plan):
    yield plan
    children = plan.children()
    for i in range(children.size()):
        yield from nodes(children.apply(i))


def test_no_vector_travels_with_a_line(spark):
    """A join that gives a line's numbers and a vector would send the vector on with every line."""
    plan = entry.queries()["rec_cosine"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan()
    joins = [n.output().mkString(" ") for n in nodes(plan) if n.nodeName() == "Join"]
    types = [[n.output().apply(i).dataType().typeName() for i in range(n.output().size())] for n in nodes(plan) if n.nodeName() == "Join"]
    assert joins
    assert not [names for names, kinds in zip(joins, types, strict=True) if "l_partkey" in names and "l_suppkey" in names and "array" in kinds]


def table(spark, rows, key):
    df = spark.createDataFrame(rows, f"{key} long, embedding array<float>")
    return df.withColumn("norm", V.magnitude("embedding"))


@pytest.mark.parametrize(("most_pairs", "numbers"), [(1 << 21, 1 << 24), (40, 12)])
def test_products_match_a_join(spark, monkeypatch, most_pairs, numbers):
    """Null and repeated ids, vectors that are null, empty, zero, with nulls or of other lengths, and one id under a third of the pairs."""
    monkeypatch.setattr(P, "PAIRS", most_pairs)
    monkeypatch.setattr(P, "NUMBERS", numbers)
    rng = np.random.default_rng(1)
    vector = lambda n: [float(x) for x in rng.integers(-3, 4, n)]
    odd = [(None, vector(3)), (1, vector(3)), (2, None), (3, []), (4, [0.0] * 3), (5, [1.0, None, 2.0]), (6, vector(5)), (7, [float("inf"), 1.0]), (8, [1.0, 2.0, float("nan")])]
    left = table(spark, [*odd, *((i, vector(3)) for i in range(20))], "a")
    right = table(spark, [*odd, *((i, vector(3)) for i in range(9, 15)), (9, vector(2))], "b")
    listed = [(i, 1 if i % 3 == 0 else int(rng.integers(0, 25)), int(rng.integers(0, 20))) for i in range(300)]
    pairs = spark.createDataFrame([*listed, listed[0], (900, None, 1), (901, 1, None)], "line long, a long, b long")
    joined = (pairs.join(left.withColumnsRenamed({"embedding": "x", "norm": "nx"}), "a").join(right.withColumnsRenamed({"embedding": "y", "norm": "ny"}), "b")
              .select("line", "a", "b", F.round(V.cosine("x", "y", F.col("nx") * F.col("ny")), 9).alias("c")))
    out = P.dots(pairs, left, P.named(right, pairs, "b"), "a", "b").select("line", "a", "b", F.round(V.cosine(product="product", norms="norms"), 9).alias("c"))
    assert sorted(map(str, out.collect())) == sorted(map(str, joined.collect()))


def test_without_pairs_or_vectors(spark):
    left, right = table(spark, [(1, [1.0])], "a"), table(spark, [], "b")
    pairs = spark.createDataFrame([(1, 1)], "a long, b long")
    assert P.dots(pairs, left, right, "a", "b").count() == 0
    assert P.dots(pairs.limit(0), left, left.withColumnRenamed("a", "b"), "a", "b").count() == 0
