"""Classifiers, vector forest, mixture and pipeline."""

import math
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconry.llm import ann_forest as A
from beaconry.llm import logistic
from beaconry.llm import mixing as M
from beaconry.llm import quality as Q
from beaconry.llm import toxicity as T

ROOT = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def tables(spark, root):
    return spark.read.parquet(f"{root}/documents.parquet"), spark.read.parquet(f"{root}/labels.parquet")


def test_logistic_regression_separates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - 2 * x[:, 1] > 0).astype(float)
    assert ((logistic.logit(x, logistic.fit(x, y)) > 0) == y).mean() > 0.98
    assert logistic.fit(x[:3], np.ones(3))[0][0] > 0 and logistic.fit(np.zeros((0, 3)), np.zeros(0))[0][0] == 0


def test_capped_fits_decide_as_whole_ones(spark):
    rng = np.random.default_rng(3)
    y = (rng.random(20_000) < 0.1).astype(int)
    x = rng.normal(size=(20_000, 2)) + 1.5 * y[:, None]
    rows = spark.createDataFrame([(i, int(n)) for i, n in enumerate(y)], "id long, y int")
    kept = logistic.bounded(rows, "id", "y", 1000).collect()
    at = np.array([r["id"] for r in kept])
    assert len(at) < 2300 and sum(r["weight"] for r in kept if r["y"] == 0) == pytest.approx((y == 0).sum(), rel=0.1)
    whole = logistic.logit(x, logistic.fit(x, y.astype(float))) > 0
    capped = logistic.logit(x, logistic.fit(x[at], y[at].astype(float), counts=np.array([r["weight"] for r in kept]))) > 0
    assert (whole == capped).mean() > 0.99
    assert (whole == (logistic.logit(x, logistic.fit(x[at], y[at].astype(float))) > 0)).mean() < 0.95  # without weights
    assert {r["weight"] for r in logistic.bounded(rows, "id", "y", 50_000).collect()} == {1.0}


def test_quality_on_rows_not_learned_from(spark):
    docs, labels = tables(spark, LARGER)
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    scored = Q.quality_classifier(docs, labels.where(~held)).join(labels.where(held), "doc_id").collect()
    assert np.mean([r["kept"] == (r["quality"] == 1) for r in scored]) > 0.95


def test_repeated_ids_train_once(spark):
    docs, labels = tables(spark, ROOT)
    hot = docs.join(labels.where("quality = 0"), "doc_id").select(docs["*"]).orderBy("doc_id").limit(1)
    more = docs.unionByName(hot.crossJoin(spark.range(500)).drop("id"))
    one, many = ({r["doc_id"]: r["evidence"] for r in Q.quality_classifier(d, labels).select("doc_id", "evidence").collect()} for d in (docs, more))
    assert len(one) == len(many) and max(abs(one[i] - many[i]) for i in one) < 1e-5


def test_sparse_sites_lean_on_their_host(spark):
    rows = [(h, "p", 900_000) for h in ("a",) for _ in range(500)] + [("a", "few", 100_000)] + [("b", "q", 100_000)] * 500 + [(None, None, 500_000)] * 3
    got = {(r["host"], r["path"]): r for r in Q.site_posteriors(spark.createDataFrame(rows, "host string, path string, p long")).collect()}
    assert got["a", "few"]["prior"] > 0.8 and got["b", "q"]["prior"] < 0.2 and got[None, None]["n"] == 3
    r = got["a", "few"]
    assert (r["s"] + r["strength"] * r["prior"]) / (r["n"] + r["strength"]) > 0.3  # one bad page does not condemn the path


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, None, "en", 0), (2, "", "s", None, 0), (None, "x " * 50, "s", "en", 1), (3, "y z", "s", "en", 1), (3, "y z", "s", "en", 1)],
                                 "doc_id long, text string, source string, lang string, p int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = Q.quality_classifier(docs, none).collect()
    assert len(got) == 5 and all(r["kept"] for r in got)
    some = spark.createDataFrame([(1, None, 0), (3, 1, 1), (3, 0, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert Q.quality_classifier(docs, some).count() == 5
    assert Q.quality_classifier(docs.limit(0), some).count() == 0
    urls = spark.createDataFrame([("https://u@WWW.x.org:8080/a/b?c=1",), ("nonsense",), (None,)], "url string")
    assert [tuple(r) for r in urls.select(Q.host_of(F.col("url")), Q.path_of(F.col("url"))).collect()] == [("www.x.org", "a"), ("", ""), (None, None)]


def edits(a, b):
    """Optimal string alignment: insertions, deletions, substitutions and swaps of neighbours."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i, *[0] * len(b)])
        for j, y in enumerate(b, 1):
            rows[i][j] = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                rows[i][j] = min(rows[i][j], rows[i - 2][j - 2] + 1)
    return rows[len(a)][len(b)]


def test_lexicon_meets_misspelled_words():
    terms = {"moron": 1, "worthless": 2, "idiot": 1, "scum": 1, "oaf": 0}
    words = T.Lexicon([*terms, "veq*"])
    rng = random.Random(1)
    tried = {"", "scmu", "skum", "1diot", "idoit", "xorthless", "niot", "oser", "csum"}
    for term in terms:  # every single error at every place
        for at in range(len(term) + 1):
            tried |= {term[:at] + c + term[at:] for c in "xos"} | {term[:at] + c + term[at + 1:] for c in "xos"} | {term[:at] + term[at + 1:]}
            tried.add(term[:at] + term[at:at + 2][::-1] + term[at + 2:])
    for _ in range(4000):
        word = list(rng.choice(list(terms)))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(word) + 1)
            word[at:at + rng.randint(0, 2)] = rng.choice(["", "x", "o", "s", "ro"])
        tried.add("".join(word))
    for word in tried:
        if not word.startswith("veq"):
            assert words.errors(word) == min((d for t, most in terms.items() if (d := edits(word, t)) <= most), default=None), word
    assert words.errors("veqabc") == 0 and words.errors("ve") is None and words.errors("") is None


def test_stems_meet_errors_inside():
    words = T.Lexicon(["degen*", "idiot"])
    assert words.match("degenerate") == (0, False)
    for word in ("dgeenerate", "deggenerate", "xegenerate", "dgenerate", "degfnerates", "degne"):
        assert words.match(word) == (1, True), word
    assert words.match("dege") is None and words.match("degree") is None and words.match("idoit") == (1, False)
    assert words.match("idiotic") is None


def test_quotation_is_told_from_abuse():
    words = T.Words(T.Lexicon(["moron"]))
    plain = T.hits("well you moron go away", words)
    quoted = T.hits('she said "he is a moron indeed" and left', words)
    assert plain == [(1, False, True)] and quoted == [(1, True, False)]
    assert T.hits("", words) == [] and T.hits("m0ron morron", words) == [(2, False, False)] * 2


def test_toxicity_on_held_out_rows(spark):
    docs, labels = tables(spark, "/root/testdata/sf0.1")
    rows = T.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in rows]) > 0.97
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    assert np.mean(caught) > 0.85 and all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 0), (None, "idiot", 1), (3, "idiot", 0), (3, "idiot", 0)], "doc_id long, text string, toxic int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = T.toxicity(docs, none).collect()
    assert len(got) == 5 and {r["score"] for r in got} == {0.5}
    some = spark.createDataFrame([(1, 0, 0), (2, 0, None), (3, 0, 1), (3, 1, 0)], "doc_id long, quality int, toxic int")
    assert T.toxicity(docs, some).count() == 5 and T.toxicity(docs.limit(0), some).count() == 0


def exact(ids, x, k):
    y = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % 50 == 0):
        s = y @ y[i]
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]]
        out[int(ids[i])] = [int(ids[j]) for j in order[:k]]
    return out


def test_forest_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    want = exact(np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float), 5)
    got = {}
    for r in A.nearest(df, F.col("vec_id") % 50 == 0, block=500).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[i] & set(w)) / len(w) for i, w in want.items()]) >= 0.9


def test_ascent_is_by_longest_prefix():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(300, 8)), rng.normal(size=8)
    index, keys = A.forest(x, 4), np.array(A.hashes(q[None, :], 4, A.SEED))[:, 0]
    lengths = np.max([[A.BITS - int(int(a) ^ int(k)).bit_length() for a in h] for h, k in zip(A.hashes(x, 4, A.SEED), keys, strict=True)], axis=0)
    for enough in (1, 10, 100, 300):
        met = A.candidates(index, keys, enough)
        depth = max(d for d in range(A.BITS + 1) if (lengths >= d).sum() >= enough)
        assert sorted(met) == np.flatnonzero(lengths >= depth).tolist() or enough == 300


def test_forest_edge_cases(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.0, 2.0]), (3, [3.0, 0.0]), (2, [1.0, 0.0]), (7, None), (8, []), (9, [0.0, 0.0]), (10, [None, 1.0]),
            (11, [float("nan"), 1.0]), (12, [float("inf"), 1.0]), (13, [1.0, 1.0, 1.0]), (100, [1.0]), (None, [1.0, 0.0]), (14, [1e-200, 0.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = {}
    for r in A.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], round(r["score"], 6)))
    assert got == {0: [(2, 1.0), (3, 1.0), (14, 1.0), (50, 0.0)], 50: [(0, 0.0), (2, 0.0), (3, 0.0), (14, 0.0)]}
    assert A.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_exponent_meets_its_limit():
    shares = [0.7, 0.2, 0.1]
    t = M.exponent(shares, repeats=2.0)
    passes = [p ** (t - 1) for p in shares]
    assert max(passes) / min(passes) == pytest.approx(2.0, rel=1e-6)
    e = M.exponent(shares, entropy=1.0)
    w = np.array([p ** e for p in shares]) / sum(p ** e for p in shares)
    assert -(w * np.log(w)).sum() == pytest.approx(1.0, abs=1e-6)
    assert M.exponent(shares, repeats=7.0) == 0.0 and M.exponent(shares, entropy=math.log(3)) == 0.0 and M.exponent([], repeats=2.0) == 0.0


def test_mixture_matches_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["a"] * 8 + ["b", "c"]), "w " * rng.randint(0, 40)) for i in range(600)] + [(900, None, "x y"), (901, "none", ""), (902, "a", None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, source string, text string, block int")
    got = sorted((r["doc_id"], r["pass"]) for r in M.mix(df, repeats=2.0, seed=3).collect())
    assert got == brute.mixture(rows, 2.0, 3, M.BLOCKS)
    assert {i for i, _ in got} == {r[0] for r in rows}  # nothing is lost
    assert M.mix(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        M.mix(df.withColumn("weight", F.lit(1)), keep=["weight"])
    ids = spark.createDataFrame([(None, "a", "x"), (1, "a", "x"), (1, "a", "x")], "doc_id long, source string, text string")
    assert M.mix(ids).count() == 3


def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {r["doc_id"] for r in Q.quality_classifier(docs, spark.read.parquet(f"{ROOT}/labels.parquet")).collect() if r["kept"]}
    left = brute.components([(i, rows[i]["text"]) for i in kept], 5, 80)
    kept = [(i, rows[i]["text"]) for i, c in left.items() if c[2]]
    clean = brute.repeated(kept)
    texts = {i: w[4].decode("utf-8", "ignore") for i, w in clean.items() if w[1] == 0 or brute.WORD.search(w[4].decode("utf-8", "ignore"))}
    mixed = brute.mixture([(i, rows[i]["source"], t) for i, t in texts.items()], 2.0, 17, M.BLOCKS)
    got = P.run(spark, ROOT).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in mixed)
    import hashlib

    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in got)
    assert len(P.STAGES) == 5 and P.ORACLE_SQL is None
    for name, stage in P.STAGES[:-1]:
        assert stage(spark, docs.limit(0), ROOT).columns == P.COLUMNS, name
