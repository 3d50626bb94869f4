"""Repeated passages and near duplicates against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest

from beaconry.llm import near_dup as N
from beaconry.llm import suffix_dedup as S
from beaconry.llm.common import RollingHash, connected, shingle_sets

ROOT = "/root/testdata/sf0.001"


def test_two_stage_sort_and_common_prefixes():
    rng = random.Random(3)
    for _ in range(150):
        n, k = rng.randint(1, 300), rng.choice([1, 2, 3, 256])
        data = bytes(rng.randrange(k) for _ in range(n))
        order = S.two_stage_sort(data, n + 1)
        assert order.tolist() == sorted(range(n), key=lambda i: data[i:])
        shared = S.common_prefixes(data, order, 50)
        for a in range(1, n):
            x, y = data[order[a - 1]:], data[order[a]:]
            m = 0
            while m < min(len(x), len(y), 50) and x[m] == y[m]:
                m += 1
            assert shared[a] == m
    assert len(S.two_stage_sort(b"", 5)) == 0


def test_only_suffixes_that_start_a_string_are_sorted(monkeypatch):
    rng = random.Random(8)
    for _ in range(150):
        n, k = rng.randint(1, 300), rng.choice([1, 2, 3, 256])
        data = bytes(rng.randrange(k) for _ in range(n))
        wanted = np.array([rng.random() < rng.choice([0.0, 0.1, 0.9, 1.0]) for _ in range(n)])
        order = S.two_stage_sort(data, n + 1, wanted)
        assert order.tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda i: data[i:])
    # units of 120 bytes hold 21 strings of 100 bytes each
    base = bytes(rng.randrange(256) for _ in range(110))
    segments = [base + bytes([i, *(rng.randrange(256) for _ in range(9))]) for i in range(40)]
    table = pa.table({"h": pa.array([1] * 40), "doc_id": pa.array(range(40)), "version": pa.array([0] * 40), "at": pa.array([7] * 40), "seg": pa.array(segments, pa.binary())})
    compared, real = [], S.direct_sort
    monkeypatch.setattr(S, "direct_sort", lambda text, some, depth: (compared.append(len(some)), real(text, some, depth))[1])
    got = {(r["doc_id"], r["lo"], r["hi"]) for r in S._later(100)(table).to_pylist()}
    assert got == {(i, 7, 17) for i in range(1, 40)} and sum(compared) <= 21 * 40


def passages(seed=5):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé ") for _ in range(900))
    rows = []
    for i in range(60):
        a, b = rng.randint(0, 400), rng.randint(500, 900)
        rows.append((i, "".join(rng.choice("abcdef ") for _ in range(rng.randint(0, 200))) + base[a:b] + "x" * rng.choice([0, 5, 300])
                     + "".join(rng.choice("ab") for _ in range(50))))
    return rows + [(100, "a" * 5000), (101, "ab" * 700), (102, None), (103, ""), (104, "a" * 99), (105, "a" * 100), (106, rows[3][1]),
                   (107, "x\0" * 100), (2**40, rows[4][1])]


@pytest.mark.parametrize("crowded", [8192, 1])
def test_passages_match_brute_force(spark, crowded):
    rows = passages()
    got = {r["doc_id"]: r for r in S.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string"), crowded=crowded).collect()}
    want = brute.repeated(rows)
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == {i: w[:4] for i, w in want.items()}
    assert all(got[i]["kept_text"] == w[4].decode("utf-8", "ignore") for i, w in want.items())


def test_passage_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, runs string, of long, h int")
    assert S.suffix_dedup(empty).count() == 0
    rows = [(1, "q" * 50 + "".join(map(str, range(100))), 1), (1, "q" * 50 + "".join(map(str, range(100))), 1), (None, "z" * 300, 2), (None, None, 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lo int")
    got = S.suffix_dedup(df, carry=["lo"]).collect()
    # a repeated row is the same document; rows without id come back whole
    assert sorted((r["doc_id"] or 0, r["n_removed"], r["lo"]) for r in got) == [(0, 0, 2), (0, 0, 3), (1, 0, 1), (1, 0, 1)]


def test_texts_that_share_an_id_keep_their_own_bytes(spark):
    one, two = "".join(f"{i} " for i in range(200)), "".join(f"{i}-" for i in range(300, 500))
    rows = [(5, one), (5, two), (7, one[100:400]), (9, two[:90] + "?" + two[90:])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_bytes"], r["n_removed"]) for r in S.suffix_dedup(df).collect())
    assert got == sorted([(5, len(one), 0), (5, len(two), 0), (7, 300, 300), (9, len(two) + 1, len(two) - 90)])
    # of two that share an id and a passage, one loses it
    both = S.suffix_dedup(spark.createDataFrame([(5, one), (5, "!" + one)], "doc_id long, text string")).collect()
    assert sorted(r["n_removed"] for r in both) == [0, len(one)]
    with pytest.raises(ValueError):
        S.suffix_dedup(df.withColumn("n_bytes", df.doc_id), carry=["n_bytes"])
    assert S.suffix_dedup(df.withColumn("runs", df.doc_id), carry=["runs"]).where("runs = doc_id").count() == 4


def test_passage_query_matches_brute_force(spark):
    from beaconry.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op2_suffix_dedup"](spark, ROOT).collect()}
    assert got == {i: w[:4] for i, w in brute.repeated(rows).items()}


def variants(seed=3):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(500)]
    rows = []
    for _ in range(30):
        base = [rng.choice(words) for _ in range(rng.choice([3, 20, 60, 150, 400]))]
        for _ in range(rng.choice([1, 2, 5, 30])):
            t = list(base)
            for _ in range(rng.randint(0, max(1, len(t) // 40))):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append((len(rows), " ".join(t).lower() if rng.random() < 0.5 else "  ".join(t)))
    n = len(rows)
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (n + 3, "one two"), (n + 4, "ONE\ttwo"), (n + 5, "é É"), (n + 6, "É é")]


@pytest.mark.parametrize("size,share,leaf", [(3, 85, 512), (5, 80, 16)])
def test_near_duplicates_match_brute_force(spark, size, share, leaf):
    rows = variants()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in N.near_duplicates(df, size, share, leaf=leaf).collect()}
    assert got == brute.components(rows, size, share)


def test_large_parts_are_searched_leaf_by_leaf(spark, monkeypatch):
    monkeypatch.setattr(N, "PART_TOKENS", 10)
    rows = variants(9)
    got = {r["doc_id"]: tuple(r)[1:] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    assert got == brute.components(rows, 3, 85)


def test_near_duplicate_edge_cases(spark):
    assert N.near_duplicates(spark.createDataFrame([], "doc_id long, text string, key string, root int")).count() == 0
    rows = [(7, "a b c d e f", 1), (7, "a b c d e f", 1), (3, "A B C D E F", 2), (None, "a b c d e f", 3), (9, None, 4)]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, part int")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [
        (0, 0, True), (3, 3, True), (7, 3, False), (7, 3, False), (9, 9, True)]


def test_trees_follow_the_depth():
    assert N.survival(0.85, 0) == 1 and 0.69 < N.survival(0.85, 3) < 0.71
    for depth in (1, 3, 10, 16):
        trees = N.trees_for(0.8, depth)
        assert (1 - N.survival(0.8, depth)) ** trees <= N.MISSED < (1 - N.survival(0.8, depth)) ** (trees - 1)


@pytest.mark.parametrize("leaf,levels", [(48, 16), (64, 2)])
def test_a_hub_keeps_its_one_link_copies(spark, monkeypatch, leaf, levels):
    monkeypatch.setattr(N, "MOST_LEVELS", levels)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(302)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):  # several leaves; each at 0.85 to 0.87 of the hub, far from each other
        t, at = list(base), rng.randrange(5, 280)
        for k in range(7):
            t[(at + 43 * k) % 295] = f"x{i}.{k}"
        rows.append((i, " ".join(t)))
    got = {r["doc_id"]: tuple(r)[1:] for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, leaf=leaf).collect()}
    assert got == brute.components(rows, 3, 85)
    assert sum(c == 0 for _, c, _ in got.values()) > 250


def test_long_words_do_not_clash(spark):
    word = "a"
    while len(word) < 1024:  # Thue-Morse words clash under polynomials modulo 2^64
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{word} y z"), (2, f"{other} y z"), (3, f"{word.upper()} Y z")]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {1: 1, 2: 2, 3: 1}


def test_near_duplicates_that_share_an_id(spark):
    text = " ".join(map(str, range(60)))
    rows = [(1, text), (5, text), (5, "quite another text of some words"), (8, text + " a"), (8, text + " b")]
    got = N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), with_hash=True).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in got) == [(1, 1, True), (5, 1, False), (5, 5, True), (8, 1, False), (8, 1, False)]
    alone = N.near_duplicates(spark.createDataFrame(rows[3:], "doc_id long, text string")).collect()
    assert sorted(r["kept"] for r in alone) == [False, True]  # one of a group


def test_near_duplicate_query_matches_brute_force(spark):
    from beaconry.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op3_near_dedup"](spark, ROOT).collect()}
    assert got == brute.components(rows, 3, 85)


def test_connected_components(spark):
    rng = random.Random(1)
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(0, 120)] + [(f"x{rng.randrange(80):02d}", f"x{rng.randrange(80):02d}") for _ in range(70)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    got = {r["id"]: r["root"] for r in connected(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for x in got} and len(got) >= 121
    assert connected(spark.createDataFrame([], "a string, b string")).count() == 0


def test_hashes_depend_on_content_only():
    data = np.frombuffer(b"spam eggs SPAM spam", dtype=np.uint8)
    h = RollingHash(data, lower=True)
    one = h.of(np.array([0, 10, 15]), np.array([4, 14, 19]))
    assert one[0] == one[1] == one[2] != h.of(np.array([5]), np.array([9]))[0]
    assert (h.every(4) == h.of(np.arange(16), np.arange(4, 20))).all() and len(h.every(19)) == 1 and len(h.every(20)) == 0
    a, b, c, d = shingle_sets([b"a b c d", b"A  B\tc\nd", b"", b"a b"], 3)
    assert len(a) == 2 and (a == b).all() and len(c) == 0 and len(d) == 1
