"""Similarity, ranking and collaborative filtering against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconry.operators import campaigns as K
from beaconry.operators import collaborative as CF
from beaconry.operators import dense
from beaconry.operators import neighbours as N
from beaconry.operators import serving
from beaconry.operators import vector_index as VI


def pairs(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long")


def brute_neighbours(rows, k):
    items = {}
    for u, i in rows:
        items.setdefault(u, set()).add(i)
    out = {}
    for u, a in items.items():
        best = sorted(((-(len(a & b) ** 2) / len(b), v) for v, b in items.items() if v != u and a & b))
        out[u] = [v for _, v in best[:k]]
    return out


def skewed(seed, users=120, items=40):
    """One item held by all, a third of the users sharing one item set, the rest random."""
    rng = np.random.default_rng(seed)
    rows = set()
    for u in range(users):
        rows.add((u, 0))
        own = range(1, 4) if u % 3 == 0 else rng.choice(np.arange(1, items), rng.integers(1, 8), replace=False)
        rows.update((u, int(i)) for i in own)
    return sorted(rows)


@pytest.mark.parametrize("per_chunk", [10_000, 17])
def test_neighbours_match_brute_force(spark, per_chunk):
    rows = skewed(1)
    got = {}
    for r in N.neighbours(pairs(spark, rows), 5, per_chunk).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["neighbour"])
    assert got == brute_neighbours(rows, 5)


def test_neighbours_with_text_ids(spark):
    rows = [(f"u{a}", f"i{b}") for a, b in [(1, 1), (1, 2), (2, 1), (2, 2), (3, 2), (4, 9)]]
    df = spark.createDataFrame(rows, "user_id string, item_id string")
    got = [(r[0], r[1]) for r in N.neighbours(df, 2).orderBy("user_id", "rank").select("user_id", "neighbour").collect()]
    assert got == [("u1", "u2"), ("u1", "u3"), ("u2", "u1"), ("u2", "u3"), ("u3", "u1"), ("u3", "u2")]


@pytest.mark.parametrize("per_chunk", [10_000, 13])
def test_overlap_summary(spark, per_chunk):
    rows = skewed(2, users=60)
    items = {}
    for u, i in rows:
        items.setdefault(u, set()).add(i)
    for r in N.overlap_summary(pairs(spark, rows), per_chunk).collect():
        a = items[r["user_id"]]
        sims = [len(a & b) / np.sqrt(len(a) * len(b)) for v, b in items.items() if v != r["user_id"] and a & b]
        assert r["overlapping_users"] == len(sims)
        assert r["similarity_sum"] == pytest.approx(sum(sims))
        assert r["lowest_similarity"] == pytest.approx(min(sims)) and r["highest_similarity"] == pytest.approx(max(sims))


def test_similarity_stats(spark):
    rows = [(1, 1), (2, 1), (3, 1), (3, 2)]
    full = N.similarity_stats(pairs(spark, rows)).first()
    assert full["min_similarity"] == pytest.approx(1 / np.sqrt(2)) and full["max_similarity"] == pytest.approx(1.0)
    assert N.similarity_stats(pairs(spark, rows), n_users=4).first()["min_similarity"] == 0.0


def test_twin_is_kept_and_self_is_not(spark):
    got = N.neighbours(pairs(spark, [(1, 1), (1, 2), (2, 1), (2, 2), (3, 2)]), 1)
    assert {(r["user_id"], r["neighbour"]) for r in got.collect()} == {(1, 2), (2, 1), (3, 1)}


def test_golden_matrix(spark):
    """The 10 x 50 matrix of seed 42: list lengths and seen counts are known, scores never rise."""
    np.random.seed(42)
    m = np.random.binomial(n=1, p=0.3, size=(10, 50))
    rows = [(int(u), int(i)) for u, i in zip(*np.nonzero(m))]
    inter = pairs(spark, rows)
    items = spark.range(50).select(F.col("id").alias("item_id"))
    topn = CF.cf_topn(inter, items, 5, 100)
    recs = CF.recommendation_records(topn, inter, "2025-12-02 12:20:59").orderBy("user_id").collect()
    assert [(r["num_recommendations"], r["num_previously_seen"]) for r in recs] == [
        (39, 11), (31, 19), (35, 15), (35, 15), (35, 15), (34, 16), (39, 11), (32, 18), (31, 19), (35, 15)]
    norm = m / np.sqrt(m.sum(axis=1))[:, None]
    sim = norm @ norm.T
    for r in recs:
        u = r["user_id"]
        assert len(r["ads"]) == 100
        got = [a for a in r["ads"] if a is not None]
        assert set(got) == set(np.flatnonzero(m[u] == 0))
        others = sorted((v for v in range(10) if v != u), key=lambda v: (-sim[u, v], v))[:5]
        score = sum(sim[u, v] * m[v] for v in others)
        assert all(score[a] >= score[b] - 1e-9 for a, b in zip(got, got[1:]))
    assert CF.validate_recommendations(CF.recommendation_records(topn, inter, "2025-12-02"), inter).count() == 0


def test_topn_fills_with_unscored_items_in_order(spark):
    inter = pairs(spark, [(1, 10), (2, 10), (2, 12)])
    items = spark.createDataFrame([(i,) for i in (3, 10, 12, 70_000, 140_000, 5)], "item_id long")
    got = CF.cf_topn(inter, items, 5, 4).orderBy("user_id", "rank").collect()
    assert [(r["item_id"], r["rank"]) for r in got if r["user_id"] == 1] == [(12, 1), (3, 2), (5, 3), (70_000, 4)]
    assert [r["item_id"] for r in got if r["user_id"] == 2] == [3, 5, 70_000, 140_000]


def test_topn_for_users_without_interactions(spark):
    inter = pairs(spark, [(1, 10), (2, 12)])
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    items = inter.select("item_id")
    got = {r["user_id"]: r["items"] for r in CF.cf_topn(inter, items, users=users).groupBy("user_id").agg(
        F.sort_array(F.collect_list("item_id")).alias("items")).collect()}
    assert got == {1: [12], 2: [10], 3: [10, 12]}


def test_dense_index_of_text(spark):
    df = spark.createDataFrame([(f"ad_{i}",) for i in range(30)], "item_id string")
    got = {r["item_id"]: r["pos"] for r in CF.dense_index(df, "item_id").collect()}
    assert got == {a: i + 1 for i, a in enumerate(sorted(got))}


def test_validation_finds_planted_issues(spark):
    recs = spark.createDataFrame([(1, [5, 5, None]), (2, [7, 8, None]), (3, [9, None, None])], "user_id long, ads array<long>")
    issues = CF.validate_recommendations(recs, pairs(spark, [(2, 7), (3, 1)])).collect()
    assert {(r["user_id"], r["issue"]) for r in issues} == {("1", "duplicate items"), ("2", "1 items already seen")}


# -- campaigns -----------------------------------------------------------------------

def vectors(spark, key, rows, kind="long"):
    return spark.createDataFrame(rows, f"{key} {kind}, embedding array<double>")


def world(spark, users=90, camps=70, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    u = [(i, [float(x) for x in rng.normal(size=dim * (1 + i % 3))]) for i in range(users)]
    u[0] = (0, [0.0] * dim)
    c = [(f"C{i:03d}", [float(x) for x in rng.normal(size=dim)]) for i in range(camps)]
    c[5] = ("C005", [0.0] * dim)
    c[6] = ("C006", [])
    c[7] = ("C007", None)
    return u, c, vectors(spark, "user_id", u), vectors(spark, "campaign_id", c, "string")


def brute_topk(u, c, k):
    out = {}
    for uid, a in u:
        scored = []
        for cid, b in c:
            if not b:
                continue
            n = np.linalg.norm(a) * np.linalg.norm(b)
            scored.append((-(round(float(np.dot(a[:len(b)], b[:len(a)]) / n), 4) if n else 0.0), cid))
        out[uid] = [cid for _, cid in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("tiled", [False, True])
def test_campaign_topk_matches_brute_force(spark, monkeypatch, tiled):
    if tiled:  # as if the campaigns were too many to ship
        monkeypatch.setattr(K, "LOCAL_ROWS", 10)
        monkeypatch.setattr(K, "USERS_PER_CHUNK", 40)
        monkeypatch.setattr(K, "CAMPAIGNS_PER_CHUNK", 25)
    u, c, users, camps = world(spark)
    got = {}
    for r in K.campaign_topk(users, camps, 10).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["campaign_id"])
    assert got == brute_topk(u, c, 10)


def test_length_mismatch_and_mean_policy(spark):
    users = vectors(spark, "user_id", [(1, [1.0, 0.0, 0.0, 1.0])])
    camps = vectors(spark, "campaign_id", [("A", [1.0, 0.0]), ("B", [0.0, 1.0])], "string")
    cut = {r["campaign_id"]: r["similarity_score"] for r in K.campaign_topk(users, camps).collect()}
    assert cut == {"A": 0.7071, "B": 0.0}
    mean = {r["campaign_id"]: r["similarity_score"] for r in K.campaign_topk(users, camps, dim_policy="mean", dim=2).collect()}
    assert mean == {"A": 0.7071, "B": 0.7071}


def test_items_with_other_field_names(spark):
    raw = spark.createDataFrame([("A", None, [1.0, 0.0], None), ("", "B", [], [0.0, 1.0]), ("C", None, None, None)],
                                "campaign_id string, cid string, campaign_embedding array<double>, embedding array<double>")
    camps = K.item_vectors(raw, ["campaign_id", "cid"], ["campaign_embedding", "embedding"])
    got = K.campaign_topk(vectors(spark, "user_id", [(1, [0.0, 2.0])]), camps).orderBy("rank").collect()
    assert [(r["campaign_id"], r["similarity_score"]) for r in got] == [("B", 1.0), ("A", 0.0)]


def test_no_campaigns(spark):
    users = vectors(spark, "user_id", [(1, [1.0])])
    none = vectors(spark, "campaign_id", [("A", None)], "string")
    assert K.campaign_topk(users, none).count() == 0
    status = serving.with_status(spark.createDataFrame([(7, 1)], "request_id long, user_id long"),
                                 K.campaign_topk(users, none).select("user_id", "campaign_id"), users).first()
    assert status["error_code"] == "CAMPAIGN_EMBEDDINGS_UNAVAILABLE"


def test_ann_recall(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(8, 16))

    def row(i):
        return [float(x) for x in centre[i % 8] + 0.6 * rng.normal(size=16)]

    users = vectors(spark, "user_id", [(i, row(i)) for i in range(80)])
    camps = vectors(spark, "campaign_id", [(f"C{i}", row(i)) for i in range(300)], "string")
    exact = {(r["user_id"], r["campaign_id"]) for r in K.campaign_topk(users, camps).collect()}
    near = {(r["user_id"], r["campaign_id"]) for r in K.campaign_topk_ann(users, camps, 16).collect()}
    assert len(exact & near) / len(exact) >= 0.9


def test_ann_splits_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(K, "USERS_PER_CHUNK", 16)
    monkeypatch.setattr(K, "CAMPAIGNS_PER_CHUNK", 32)
    rng = np.random.default_rng(6)
    users = vectors(spark, "user_id", [(i, [1.0, 0.01 * i]) for i in range(50)])
    camps = vectors(spark, "campaign_id", [(f"C{i:03d}", [1.0, float(x)]) for i, x in enumerate(rng.uniform(0, 0.1, 100))], "string")
    # One table with one bucket for all: the answer must be the exact one.
    near = K.campaign_topk_ann(users, camps, 2, bucket_length=50.0, tables=1).select("user_id", "campaign_id", "rank")
    exact = K.campaign_topk(users, camps).select("user_id", "campaign_id", "rank")
    assert near.count() in (500,) and near.exceptAll(exact).count() == 0


@pytest.mark.parametrize("tiled", [False, True])
def test_serving(spark, monkeypatch, tiled):
    if tiled:
        monkeypatch.setattr(K, "LOCAL_ROWS", 1)
        monkeypatch.setattr(K, "CAMPAIGNS_PER_CHUNK", 2)
    users = vectors(spark, "user_id", [(1, [1.0, 0.0])])
    camps = spark.sql("""SELECT * FROM VALUES ('A', 'a', 5, DATE '2025-01-01', DATE '2025-01-31'), ('B', 'b', 4, DATE '2025-01-01', DATE '2025-12-31'),
        ('C', 'c', 3, DATE '2025-06-01', DATE '2025-12-31') AS t(campaign_id, name, priority, start_date, end_date)""")
    vecs = vectors(spark, "campaign_id", [("A", [1.0, 0.0]), ("B", [1.0, 1.0]), ("C", [0.0, 1.0])], "string")
    reqs = spark.sql("""SELECT * FROM VALUES (1L, 1L, NULL, NULL, NULL, NULL), (2L, 1L, 1, array('A'), NULL, NULL),
        (3L, 1L, 50, array('Z', NULL), DATE '2025-07-01', NULL), (4L, 1L, 5, NULL, NULL, DATE '2025-02-01'), (5L, 9L, 5, NULL, NULL, NULL)
        AS t(request_id, user_id, num_recommendations, exclude_campaign_ids, window_start, window_end)""")
    got = {}
    for r in K.serve_requests(reqs, users, camps, vecs).orderBy("request_id", "rank").collect():
        got.setdefault(r["request_id"], []).append((r["campaign_id"], r["priority"]))
    assert got == {1: [("A", "high"), ("B", "medium"), ("C", "low")], 2: [("B", "medium")],
                   3: [("B", "medium"), ("C", "low")], 4: [("A", "high"), ("B", "medium")]}


def test_request_status(spark):
    users = vectors(spark, "user_id", [(1, [1.0]), (2, [])])
    reqs = spark.createDataFrame([(1, 1), (2, 2), (3, 3), (4, None)], "request_id long, user_id long")
    got = {r["request_id"]: r["error_code"] for r in serving.request_status(reqs, users).collect()}
    assert got == {1: None, 2: "EMBEDDING_NOT_AVAILABLE", 3: "USER_NOT_FOUND", 4: "INVALID_REQUEST"}


def test_index_search_is_whole_and_near(spark, tmp_path):
    rng = np.random.default_rng(11)
    centres = rng.standard_normal((20, 16))
    camps = [(f"C{i:04d}", (centres[i % 20] + 0.3 * rng.standard_normal(16)).tolist()) for i in range(900)] + [("ZERO", [0.0] * 16), ("NONE", None), ("EMPTY", [])]
    users = [(u, (centres[u % 20] + 0.3 * rng.standard_normal(16)).tolist() + rng.standard_normal(16).tolist()) for u in range(200)]
    users += [(900, [0.0] * 32), (901, [0.0] * 16 + [1.0] * 16), (902, None)]
    c = spark.createDataFrame(camps, "campaign_id string, embedding array<double>")
    u = spark.createDataFrame(users, "user_id long, embedding array<double>")
    path = str(tmp_path / "index")
    VI.build_index(c, u, path, 16)
    got = VI.search(u, c, path, 16).collect()
    exact = {(r["user_id"], r["campaign_id"]): r["similarity_score"] for r in K.campaign_topk(u, c, 10).collect()}
    assert {i: sorted(r["rank"] for r in got if r["user_id"] == i) for i, _ in users[:-1]} == {i: list(range(1, 11)) for i, _ in users[:-1]}
    near = {(r["user_id"], r["campaign_id"]): r["similarity_score"] for r in got}
    assert len(near.keys() & exact.keys()) / len(exact) >= 0.9 and all(near[p] == exact[p] for p in near.keys() & exact.keys())
    assert np.mean([r["candidates"] for r in got if r["user_id"] < 900]) < 0.3 * 901  # most campaigns are never scored
    assert {k for k in near if k[0] >= 900} == {k for k in exact if k[0] >= 900}
    # one cell a user holds too few for a long list: those users are ranked exactly
    long = VI.search(u, c, path, 16, k=100, probes=1).groupBy("user_id").count().collect()
    assert {r["count"] for r in long} == {100} and len(long) == 202
    empty = str(tmp_path / "empty")
    VI.build_index(c.limit(0), u, empty, 16)
    assert VI.search(u, c.limit(0), empty, 16).count() == 0


def test_index_search_moves_no_vectors_to_few_campaigns(spark, tmp_path, monkeypatch):
    """Beside few campaigns a user is answered where its row lies; the rows are those of the tiles, for repeated users too."""
    rng = np.random.default_rng(11)
    u = spark.createDataFrame([(i % 280, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 12)))] + [(None, [1.0] * 12), (900, [0.0] * 12)],
                              "user_id long, embedding array<double>")
    c = spark.createDataFrame([(f"C{i}", [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(90, 4)))], "campaign_id string, embedding array<double>")
    path = str(tmp_path / "index")
    VI.build_index(c, u, path, 4)

    def tiled(*_):
        raise AssertionError("tiles")

    with monkeypatch.context() as m:
        m.setattr(VI.tiles, "cell_tiles", tiled)
        few = VI.search(u, c, path, 4, k=5, probes=2).collect()
    monkeypatch.setattr(K, "LOCAL_ROWS", 0)
    many = VI.search(u, c, path, 4, k=5, probes=2).collect()
    assert sorted(map(repr, few)) == sorted(map(repr, many)) and {r.user_id for r in few} == {*range(280), None, 900}


def test_windows_and_exclusions_drop_rows_in_their_own_joins(spark):
    import datetime as dt

    at = lambda d, h=0, m=0: dt.datetime(2024, 1, d, h, m)
    camps = [("A", dt.date(2024, 1, 1), dt.date(2024, 1, 3)), ("B", dt.date(2024, 1, 3), dt.date(2024, 1, 9)), ("C", dt.date(2024, 1, 12), dt.date(2024, 1, 12)),
             ("D", None, dt.date(2024, 1, 5)), ("E", dt.date(2024, 1, 8), dt.date(2024, 1, 2))]
    c = spark.createDataFrame(camps, "campaign_id string, start_date date, end_date date")
    windows = {1: (None, None), 2: (at(3, 23), at(3, 23, 30)), 3: (at(3, 23, 59), at(4)), 4: (at(9, 23, 59), at(12)), 5: (at(10), at(11, 23)), 6: (at(10), None),
               7: (None, at(2, 12)), 8: (at(12, 23, 59, ) + dt.timedelta(seconds=59, milliseconds=500), None)}
    w = spark.createDataFrame([(i, *x) for i, x in windows.items()], "window_id long, window_start timestamp, window_end timestamp")
    got = {}
    for r in serving.window_overlaps(w, c).collect():
        got.setdefault(r["window_id"], []).append(r["campaign_id"])
    want = {1: "ABC", 2: "AB", 3: "AB", 4: "BC", 6: "C", 7: "A"}
    assert {i: sorted(x) for i, x in got.items()} == {i: list(x) for i, x in want.items()}
    vecs = spark.createDataFrame([(x, [1.0, float(i)]) for i, x in enumerate("ABC")], "campaign_id string, embedding array<double>")
    users = spark.createDataFrame([(7, [1.0, 0.0])], "user_id long, embedding array<double>")
    reqs = w.select(F.col("window_id").alias("request_id"), F.lit(7).cast("long").alias("user_id"), "window_start", "window_end",
                    F.when(F.col("window_id") == 1, F.array(F.lit("A"), F.lit("Z"))).otherwise(F.array()).cast("array<string>").alias("exclude_campaign_ids"))
    ranked = K.campaign_topk(users, vecs, 3)
    found = {(r["request_id"], r["campaign_id"]) for r in serving.best_in_window(reqs, ranked, c, 1).collect()}
    assert found == {(i, x[0]) for i, x in want.items()}
    allowed = {r["request_id"]: r["campaign_id"] for r in serving.best_allowed(reqs, ranked, 1).collect()}
    assert allowed == {1: "B", **{i: "A" for i in range(2, 9)}}
    # the serving kernel compares times of day as well
    named = c.withColumns({"name": F.col("campaign_id"), "priority": F.lit(1)})
    served = K.serve_requests(reqs.withColumns({"num_recommendations": F.lit(10), "exclude_campaign_ids": F.array().cast("array<string>")}), users, named, vecs)
    assert {(r["request_id"], r["campaign_id"]) for r in served.collect()} == {(i, x) for i, xs in want.items() for x in xs}


@pytest.mark.parametrize("by_matrix", [True, False])
@pytest.mark.parametrize("columns", [2048, 7])
def test_neighbours_by_matrix_and_by_lists(spark, monkeypatch, by_matrix, columns):
    """Both ways to count the pairs give the same neighbours; many ties, twins and lists of a single item included."""
    monkeypatch.setattr(dense, "COLUMNS", columns)
    monkeypatch.setattr(dense, "CELLS", 64 * columns)
    monkeypatch.setattr(dense, "LISTS_PER_CHUNK", 2048 if columns > 7 else 40)
    rows = skewed(3) + [(1000 + u, 500 + u % 3) for u in range(8)] + [(2000, 900)]
    got = {u: [] for u, _ in rows}
    for r in N.neighbours(pairs(spark, rows), 5, by_matrix=by_matrix).orderBy("user_id", "rank").collect():
        got[r["user_id"]].append(r["neighbour"])
    assert got == brute_neighbours(rows, 5)
    text = pairs(spark, rows).selectExpr("concat('u', user_id) AS user_id", "concat('i', item_id) AS item_id")
    assert N.neighbours(text, 5, by_matrix=by_matrix).count() == sum(map(len, got.values()))


@pytest.mark.parametrize("by_matrix", [True, False])
def test_overlap_by_matrix_and_by_lists(spark, monkeypatch, by_matrix):
    monkeypatch.setattr(dense, "COLUMNS", 7)
    monkeypatch.setattr(dense, "LISTS_PER_CHUNK", 25)
    rows = skewed(4, users=60) + [(1000 + u, 500 + u % 3) for u in range(5)] + [(2000, 900)]
    items = {}
    for u, i in rows:
        items.setdefault(u, set()).add(i)
    got = {r["user_id"]: r for r in N.overlap_summary(pairs(spark, rows), by_matrix=by_matrix).collect()}
    assert set(got) == set(items)
    for u, r in got.items():
        shared = [(len(items[u] & b), len(b)) for v, b in items.items() if v != u and items[u] & b]
        sims = [c / np.sqrt(len(items[u]) * n) for c, n in shared]
        assert (r["overlapping_users"], r["shared_items"]) == (len(sims), sum(c for c, _ in shared))
        assert r["similarity_sum"] == pytest.approx(sum(sims), abs=1e-9)
        assert r["lowest_similarity"] == (pytest.approx(min(sims)) if sims else None)
        assert r["highest_similarity"] == (pytest.approx(max(sims)) if sims else None)


def test_narrow_catalogues_are_counted_by_matrix(spark):
    """Users that share a few dozen items meet many times over under inverted lists; over a wide catalogue hardly ever."""
    rng = np.random.default_rng(5)
    narrow = [(u, int(i)) for u in range(300) for i in rng.choice(40, 12, replace=False)]
    wide = [(u, int(i)) for u in range(300) for i in rng.choice(3000, 12, replace=False)]
    assert dense.width_if_cheaper(N.profiles(pairs(spark, narrow))[1]) == 40
    assert dense.width_if_cheaper(N.profiles(pairs(spark, wide))[1]) is None


@pytest.mark.parametrize("sent", [1_000_000, 0])
def test_window_ranking_takes_one_list_a_user(spark, monkeypatch, sent):
    """Repeated requests and repeated campaigns of a user keep their rows; no row a campaign and request is made."""
    import datetime as dt

    monkeypatch.setattr(serving, "WINDOW_PAIRS", sent)
    day = lambda d: dt.date(2024, 1, d)
    c = spark.createDataFrame([(x, day(i), day(i + 2)) for i, x in enumerate("ABCDEF", 1)], "campaign_id string, start_date date, end_date date")
    scores = {1: "FEDCBA", 2: "ABCDEF", 3: "CCDDAABB", 5: "A"}
    rows = [(u, x, 1.0 - i / 10) for u, xs in scores.items() for i, x in enumerate(xs)]
    ranked = spark.createDataFrame(rows, "user_id long, campaign_id string, similarity_score double")
    asks = [(1, 1, None, None), (2, 1, day(3), day(3)), (3, 2, day(3), day(3)), (4, 3, day(3), day(3)), (5, 2, day(3), None), (5, 2, day(3), None),
            (6, 9, None, None), (7, 5, day(8), None), (8, None, None, None), (9, 1, day(1), day(1)), (9, 2, day(6), day(7))]
    reqs = spark.createDataFrame(asks, "request_id long, user_id long, window_start date, window_end date")
    want = {}
    for r, u, lo, hi in asks:
        runs = [x for i, x in enumerate("ABCDEF", 1) if (hi is None or day(i) <= hi) and (lo is None or lo <= day(i + 2))]
        want.setdefault(r, []).extend((-s, x) for v, x, s in rows if v == u and x in runs)
    expected = sorted((r, x) for r, found in want.items() for _, x in sorted(found)[:3])
    out = serving.best_in_window(reqs, ranked, c, 3)
    assert sorted(map(tuple, out.collect())) == expected
    assert "array_intersect" in out._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("by_matrix", [True, False])
def test_neighbour_at_the_bar_is_kept(spark, by_matrix):
    """100 / 22 * 22 is above 100 in doubles: the neighbour that sets the bar must still reach it."""
    rows = [(1, i) for i in range(10)] + [(2, i) for i in range(22)] + [(1, 90), (3, 90), (3, 91), (3, 92)]
    rows += [(u, i) for u in (4, 5) for i in range(10, 22)]  # so that the shared items are the rarest of both
    got = N.neighbours(pairs(spark, rows), 1, by_matrix=by_matrix).where("user_id = 1").collect()
    assert [(r["neighbour"], r["shared"]) for r in got] == [(2, 10)]


@pytest.mark.parametrize("by_matrix", [True, False])
@pytest.mark.parametrize("small", [False, True])
def test_all_partners_match_brute_force(spark, monkeypatch, by_matrix, small):
    """Without a number of neighbours nobody who shares an item is left out; ties, twins and lone users included."""
    from beaconry.operators import partners

    if small:
        for name, size in (("ASKING", 9), ("ROWS", 10), ("TALLIES", 5), ("MEMBERS", 4), ("PROBES", 7)):
            monkeypatch.setattr(partners, name, size)
        monkeypatch.setattr(dense, "LISTS_PER_CHUNK", 25)
        monkeypatch.setattr(dense, "CELLS", 64)
    rows = skewed(3) + [(1000 + u, 500 + u % 3) for u in range(8)] + [(2000, 900)]
    items = {}
    for u, i in rows:
        items.setdefault(u, set()).add(i)
    best = brute_neighbours(rows, len(items))
    want = {(u, v, len(items[u] & items[v]), round(len(items[u] & items[v]) / np.sqrt(len(items[u]) * len(items[v])), 12), i)
            for u, vs in best.items() for i, v in enumerate(vs, 1)}
    got = N.neighbours(pairs(spark, rows), None, 13 if small else 10_000, by_matrix).collect()
    assert len(got) == len(want) and {(*r[:3], round(r[3], 12), r[4]) for r in got} == want
    text = pairs(spark, rows).selectExpr("concat('u', user_id) AS user_id", "concat('i', item_id) AS item_id")
    named = N.neighbours(text, None, by_matrix=by_matrix).groupBy("user_id").agg(F.count("*").alias("n"), F.max("rank").alias("last")).collect()
    assert {(r[0], r[1]) for r in named} == {(f"u{u}", len(vs)) for u, vs in best.items() if vs} and all(r[1] == r[2] for r in named)


def test_user_similarity_holds_every_pair(spark):
    """The query gives the whole matrix, not a few neighbours of each user."""
    import __spark_entry__ as entry
    from beaconry.plans.bindings import Tables

    inter = Tables(spark, "/root/testdata/sf0.001").interactions
    other = inter.select(F.col("user_id").alias("neighbour"), "item_id")
    sharing = inter.join(other, "item_id").where("user_id <> neighbour").select("user_id", "neighbour").distinct()
    got = entry.queries()["rec_user_similarity"](spark, "/root/testdata/sf0.001")
    assert got.count() == sharing.count() and got.agg(F.max("rank")).first()[0] > 5


def test_all_partners_whatever_ranges_are_made(spark, monkeypatch):
    """The ranges of users are those that Spark made, more than were asked for included."""
    rows = skewed(6, users=40)
    inter = pairs(spark, rows)
    made = type(inter).repartitionByRange
    monkeypatch.setattr(type(inter), "repartitionByRange", lambda self, n, *cols: made(self, 3 * n + 4, *cols))
    got = {}
    for r in N.neighbours(inter, None, by_matrix=True).orderBy("user_id", "rank").collect():
        got.setdefault(r["user_id"], []).append(r["neighbour"])
    assert got == brute_neighbours(rows, 40)
