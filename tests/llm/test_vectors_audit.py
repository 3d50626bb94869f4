"""Whitening, M-tree search and filter audit against brute force."""

import itertools
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconry.llm import filter_audit as FA
from beaconry.llm import mtree as MT
from beaconry.llm import whitening as W

VECTORS = "vec_id long, embedding array<float>"


# whitening

@pytest.mark.parametrize("seed", range(4))
def test_spectrum_of_rotated_matrices(seed):
    rng = np.random.default_rng(seed)
    for values in ([1, 2, 3, 3, 3], [5] * 4, [0, 0, 1], [1e-9, 1, 1e9], list(range(40)), [1, 1 + 1e-9, 2], [0.0] * 3):
        q, _ = np.linalg.qr(rng.standard_normal((len(values),) * 2))
        a = q @ np.diag(values) @ q.T
        a = (a + a.T) / 2
        got, axes = W.spectrum(a)
        scale = max(values) or 1
        assert np.allclose(got, np.sort(values)[::-1], atol=1e-13 * scale * len(values))
        assert np.abs(a @ axes - axes * got).max() <= 1e-13 * scale * len(values) and np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-13
        few, some = W.spectrum(a, 2)
        assert np.allclose(few, got[:2], atol=1e-13 * scale * len(values)) and some.shape == (len(values), 2)


def test_polar_factor_is_the_matrix_sign():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.standard_normal((12, 12)))
    u = W.polar(q @ np.diag([1e-7, -1e-7, *range(1, 6), *range(-5, 0)]) @ q.T)
    assert np.abs(u @ u - np.eye(12)).max() < 1e-8 and round(np.trace(u)) == 0


def brute_whiten(rows, components=4):
    """Rows by plain numpy: an eigenvalue solver in place of the spectral division."""
    x = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows]
    fit = np.array(sorted({tuple(v) for _, v in x}), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    out = {}
    for i, v in x:
        off = [n * a - int(b) for a, b in zip(v, s, strict=True)]
        for c, (e, axis) in enumerate(zip(values, axes.T, strict=True)):
            out[i, c + 1] = (n, sum(o * o for o in off), float((np.array(v) - s / n) @ axis / np.sqrt(e)), float(e / np.trace(centred.T @ centred / n)))
    return out


def test_whitening_against_eigenvalue_solver(spark):
    rng = np.random.default_rng(7)
    mix = rng.standard_normal((8, 8))
    rows = [(i, [float(np.float32(c)) for c in mix @ rng.standard_normal(8)]) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(400)]  # copies weigh nothing
    bad = [(2000, None), (2001, [None] * 8), (2002, [float("nan")] * 8), (2003, [float("inf")] + [0.0] * 7), (2004, []), (2005, [1.0])]
    got = W.whiten(spark.createDataFrame(rows + bad, VECTORS).withColumn("x", F.lit("clash")).withColumn("component", F.lit(9))).collect()
    want = brute_whiten(rows)
    assert len(got) == len(want) == 4 * len(rows)
    flip = {c: np.sign(sum(r["whitened"] * want[r["vec_id"], c][2] for r in got if r["component"] == c)) for c in range(1, 5)}
    for r in got:
        n, far, at, share = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, far)
        assert r["whitened"] * flip[r["component"]] == pytest.approx(at, abs=1e-9) and r["explained"] == pytest.approx(share, rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in got}) == 1


def test_whitening_edge_cases(spark):
    def run(rows, kind=VECTORS):
        return [tuple(r) for r in W.whiten(spark.createDataFrame(rows, kind)).collect()]

    assert run([]) == [] and run([(1, None), (2, [])]) == []
    # one distinct vector spans nothing; repeated ids and rows without id each get rows
    one = run([(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.5, 1.0])])
    assert len(one) == 6 and all(r[2:] == (1, 0, None, None, None) for r in one)
    flat = run([(i, [float(i), 2.0 * i, 7.0]) for i in range(5)])  # rank one
    assert {r[1] for r in flat if r[4] is not None} == {1} and {r[1] for r in flat} == {1, 2, 3}
    assert all(r[6] < 1e-9 for r in flat)
    huge = run([(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 0.5])], "vec_id long, embedding array<double>")
    assert len(huge) == 6 and [r[3] for r in sorted(huge)] == [None] * 4 + [1, 1]  # beyond a long, and exact beside it
    assert all(math.isfinite(r[4]) for r in huge if r[4] is not None)
    assert run([(1, [-1 / 512, 0.0]), (2, [1 / 256, 0.0])])[0][3] in (4, 1)  # floor goes down


# M-tree

def brute_products(rows, is_query, k, scale=1024):
    usable = {(i, tuple(math.floor(scale * float(c)) for c in v)) for i, v in rows
              if i is not None and v and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for q in sorted({i for i, _ in usable if is_query(i)}):
        scored = []
        for _, x in [u for u in usable if u[0] == q]:
            scored += sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in usable if i != q and len(y) == len(x))[:k]
        out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def searched(spark, rows, k=10, **more):
    df = spark.createDataFrame(rows, VECTORS).withColumn("x", F.lit(1)).withColumn("block", F.lit("clash"))
    return MT.largest_products(df, F.col("vec_id") % 10 == 0, k=k, **more)


@pytest.mark.parametrize("k", [1, 10])
def test_products_against_brute_force(spark, k):
    rng = np.random.default_rng(k)
    centres = 2 * rng.standard_normal((6, 12))
    rows = [(i, [float(np.float32(c)) for c in centres[i % 6] * rng.uniform(0.2, 2) + 0.1 * rng.standard_normal(12)]) for i in range(700)]
    rows += [(i, rows[50][1]) for i in range(700, 1100)]  # a hot vector, among the queries too
    rows += rows[:30] + [(5, rows[6][1]), (10, rows[7][1])]  # repeated rows; an id with two vectors
    rows += [(1200, None), (1210, [None] * 12), (1220, [float("nan")] * 12), (None, rows[0][1]), (1230, []), (1240, [1.0, 2.0]), (1241, [1.0, 3.0]), (1250, [0.0] * 12)]
    got = searched(spark, rows, k, page=8, values=12 * 150).collect()
    assert sorted(tuple(r)[:4] for r in got) == brute_products(rows, lambda i: i % 10 == 0, k)


def test_products_of_small_and_empty_tables(spark):
    assert searched(spark, []).count() == 0
    assert searched(spark, [(10, [1.0])]).count() == 0  # no candidates
    assert [tuple(r)[:4] for r in searched(spark, [(10, [1.0]), (11, [-1.0])]).collect()] == [(10, 1, 11, -1024 * 1024)]
    big = [(10, [3e38, 1.0]), (11, [3e38, 2.0]), (12, [-3e38, 0.0]), (13, [0.0, 1.0])]
    got = [tuple(r)[:4] for r in searched(spark, big).orderBy("rank").collect()]
    assert [g[2] for g in got] == [11, 13, 12] and got[0][3] == (1 << 63) - 1 and got[2][3] == -(1 << 63)


def test_tree_bounds_hold_and_spare_products():
    rng = np.random.default_rng(0)
    centres = 400 * rng.standard_normal((40, 16))
    x = np.floor(centres[rng.integers(0, 40, 6000)] + 20 * rng.standard_normal((6000, 16))).astype(np.int64)
    pages = MT.build(np.arange(6000), x, 32)
    by = {p["page"]: p for p in pages}
    assert max(len(p["radii"]) for p in pages) <= 32 and sum(len(p["ids"]) for p in pages) == len(np.unique(x, axis=0))

    def objects(number):
        p = by[number]
        own = p["objects"].reshape(-1, 16).astype(float)
        own = np.c_[own, np.sqrt(np.maximum(p["length"] - (own * own).sum(axis=1), 0))]
        return (own, own) if p["leaf"] else (own, np.concatenate([objects(c)[1] for c in p["children"]]))

    for p in pages:  # covering radii cover, parent distances are those to the routing object
        if not p["leaf"]:
            for at, radius, child in zip(objects(p["page"])[0], p["radii"], p["children"], strict=True):
                below, under = objects(child)
                assert np.sqrt(((under - at) ** 2).sum(axis=1)).max() <= radius + 1e-6
                assert np.allclose(np.sqrt(((below - at) ** 2).sum(axis=1)), by[child]["to_parent"])
    tree = MT.Tree(MT._build(32)((MT.pa.scalar(16), MT.pa.scalar(0)), MT.pa.table(
        {"vec_id": np.arange(6000), "x": MT.pa.array(list(x), MT.pa.list_(MT.pa.int64()))})), 16)
    for q in x[:50]:
        scores, ids = tree.search(q, 10)
        want = sorted(zip((-(x @ q)).tolist(), range(6000), strict=True))[:10]
        assert list(zip(scores, ids, strict=True)) == [(-s, i) for s, i in want]
    assert tree.computed < 0.4 * 50 * 6000  # clustered vectors: most products are never computed
    before = tree.computed
    assert tree.search(x[0], 10, bar=1 << 60) == ([], []) and tree.computed - before < 600


# filter audit

def brute_audit(docs, labels):
    good, toxic = ({i for i, *marks in labels if marks[at] == 1 and i is not None} for at in (0, 1))
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    fails, parts = defaultdict(list), {s or "" for _, _, s in docs}
    for i, text, source in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
               "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and i > first[t]}
        fails[source or ""].append(({f for f in own if own[f]}, i in good, i in toxic))
    out = {}
    for part in parts:
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            left = list(fails[part])
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), sum(f in d[0] for d in fails[part]) - len(gone),
                                                   sum(d[0] == {f} for d in fails[part]), sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return sorted((*k, *v) for k, v in out.items())


def test_paths_are_counted():
    for n in range(1, 6):
        walked = Counter()
        for order in itertools.permutations(range(n)):
            for k, f in enumerate(order):
                walked[sum(1 << g for g in order[:k]), f] += 1
        assert {(s, f): w for s, f, w in FA.lattice(n)} == walked
    with pytest.raises(ValueError):
        FA.audit(None, "ABCDEFGH")


def test_audit_against_brute_force(spark):
    rng = np.random.default_rng(1)
    pool = [" ".join(rng.choice([f"w{i}" for i in range(int(v))], int(n))) + str(end)
            for n, v, end in zip(rng.integers(0, 120, 60), rng.integers(1, 200, 60), rng.choice(["", " A" * 30, " #", " *X", "é"], 60), strict=True)]
    docs = [(i, str(rng.choice(pool)), str(rng.choice(["s1", "s2", "hot", "hot", "hot"]))) for i in range(400)]
    docs += [(1000 + i, "the same text", "hot") for i in range(300)]
    docs += [(5, "the same text", "s1"), (5, "the same text", "s1"), (5, None, None), (None, "the same text", "s2"), (None, None, ""), (2000, "", "only"),
             (2001, "  \n ", "s1"), (2002, "long words " * 40_000, "s2"), (2003, "long words " * 40_000, "s2")]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 400, 2)] + [(0, 1, 0), (0, 0, None), (1001, 1, 1), (None, 1, 1), (7, None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumn("part", F.lit("clash")).withColumn("mask", F.lit(1))
    got = FA.filter_audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in got.collect()) == brute_audit(docs, labels)


def test_audit_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, source string")
    assert FA.filter_audit(empty, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
