"""Token ids, chat formatting, language-model scores and quality rules."""

import hashlib
import random

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from beaconry.llm import bpe as B
from beaconry.llm import chat_format as C
from beaconry.llm import lm_score as L
from beaconry.llm import rules as R

ROOT = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def known():
    with open(PATH, "rb") as f:
        ranks = B.read_ranks(f.read())
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return plain, B.Texts(public_tokenizers.PATTERN, B.Pieces(B.Transducer(ranks)))


def test_ids_equal_the_library(known):
    plain, texts = known
    rng = random.Random(5)
    some = ["a", "e", "t", "h", " ", " ", "\n", "  ", "é", "ü", "1", "²", "!", "=", "'s", "'ll", "-", " the", "ing", "😀", "中", "_", "\x1c", "\x85",
            "\xa0", "​", "　", "\t", "\r\n", "<|endoftext|>", "\0"]
    cases = ["".join(rng.choice(some) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    cases += ["a" * 5000, "ab" * 3000, "=" * 4000, "thetheing" * 500 + " " * 3000 + "x", " a", "a ", " "]
    for text in cases * 2:  # the second time from what was kept
        assert np.frombuffer(texts.encode(text), dtype=np.int32).tolist() == plain.encode_ordinary(text), repr(text)


def test_transducer_on_any_bytes(known):
    plain, texts = known
    rng = random.Random(6)
    for _ in range(2000):
        data = bytes(rng.randrange(256) for _ in range(rng.randint(1, 12)))
        assert texts.pieces.transducer.encode(data) == plain._core_bpe.encode_single_piece(data)


def test_memories_start_afresh(known, monkeypatch):
    plain, _ = known
    monkeypatch.setattr(B, "MOST_STATES", 20)
    monkeypatch.setattr(B, "MOST_PIECES", 5)
    monkeypatch.setattr(B, "FLUSH", 16)
    texts = B.Texts(public_tokenizers.PATTERN, B.Pieces(B.Transducer(plain._mergeable_ranks)))
    for text in ("incomprehensibilities of antidisestablishmentarianism " * 3, "xyzzy" * 40, "la" * 100):
        assert np.frombuffer(texts.encode(text), dtype=np.int32).tolist() == plain.encode_ordinary(text)


def test_stream_decoding_waits_for_characters(known):
    tokens = known[1].pieces.transducer.tokens
    single = {token[0]: i for i, token in tokens.items() if len(token) == 1}
    rng = random.Random(7)
    for _ in range(2000):
        data = bytes(rng.choice([0x41, 0xC3, 0xA9, 0xE4, 0xB8, 0xAD, 0xF0, 0x9F, 0x98, 0x80, 0xED, 0xA0, 0xC0, 0xFF]) for _ in range(rng.randint(0, 9)))
        ids, cut = [single[b] for b in data], rng.randint(0, len(data))
        assert "".join(B.decode_stream([ids[:cut], ids[cut:]], tokens)) == data.decode("utf-8", "replace")
    machine = B.Utf8Machine()
    assert [machine.push(bytes([b])) for b in "é😀".encode()] == ["", "é", "", "", "", "😀"]


def test_token_query_round_trip(spark, known):
    from beaconry.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op7_bpe"](spark, ROOT).collect()}
    for i, text in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect():
        ids = known[0].encode_ordinary(text)
        assert (got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_token_edge_cases(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "x y", 5), (3, "x y", 6), (3, "x y", 6)], "doc_id long, text string, ids int")
    out = B.decode(B.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"], r["text"]) for r in out) == [(0, 2, "x y"), (1, 0, ""), (2, 0, ""), (3, 2, "x y"), (3, 2, "x y")]
    assert B.encode(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_escapes_are_reversible():
    rng = random.Random(2)
    for _ in range(3000):
        text = "".join(rng.choice(["\\", "#", "###", "</turn>", "</turn>\n", ": ", " ", "\n", "a", "### assistant: "]) for _ in range(rng.randint(0, 9)))
        assert C.unescape(C.escape(text)) == text
        one = f"{C.OPEN}{C.escape(text, role=True)}{C.MIDDLE}{C.escape(text)}{C.CLOSE}"
        assert C.parse(one * 2) == [(text, text)] * 2


def test_each_reply_is_an_example(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "a"), (1, 2, "assistant", "b ###"), (1, 3, "user", "c"), (1, 4, "assistant", "d"), (1, 5, "user", "e"),
            (2, 0, "user", None), (3, 0, None, "x"), (None, 0, "assistant", "y"), (4, 1, "assistant", "t"), (4, 1, "assistant", "t")]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    examples = C.prefix_examples(df)
    got = {(r["conv_id"], r["example"]): r for r in examples.collect()}
    assert sorted(k[1] for k in got if k[0] == 1) == [0, 1, 2]
    second = got[1, 1]
    assert C.parse(second["formatted"]) == [("system", "s"), ("user", "a"), ("assistant", "b ###"), ("user", "c"), ("assistant", "d")]
    assert second["formatted"][second["loss_start"]:second["loss_end"]] == "d" and got[1, 2]["loss_start"] is None
    back = {r["conv_id"]: r for r in C.read_back(examples).collect()}
    assert {k: (r["n_turns"], r["loss_chars"], r["n_examples"]) for k, r in back.items()} == {
        1: (6, 6, 3), 2: (1, 0, 1), 3: (1, 0, 1), None: (1, 1, 1), 4: (2, 2, 2)}
    assert back[1]["loss_sha256"] == hashlib.sha256(b"b ###d").hexdigest()
    assert C.prefix_examples(df.limit(0)).count() == 0


def test_scores_match_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    docs += [(None, "of the of"), (900, None), (901, " "), (902, docs[0][1]), (902, docs[0][1])]
    target = [t for _, t in docs[:20]]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double")
    got = L.cross_entropy_difference(df, spark.createDataFrame([(t,) for t in target], "text string"), most=50).collect()
    score = brute.bigram_losses(target, [t for _, t in docs], 50, L.SMOOTHING, L.WEIGHT)
    assert len(got) == len(docs)
    texts = dict(docs)
    for r in got:
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(score(texts[r["doc_id"]]), abs=1e-5)
        assert r["selected"] == (r["score"] < 0)
    assert L.cross_entropy_difference(df.limit(0), df.limit(0).select("text")).count() == 0


def test_chunks_of_texts_are_not_shuffled(spark, monkeypatch):
    """Ids of the target and answers meet the chunks where these are filed: no exchange carries their data."""
    monkeypatch.setattr(L, "CHUNK", 200)
    monkeypatch.setattr(L, "FILED", 500)
    docs = spark.createDataFrame([(i, f"word{i % 7} other{i % 5} again{i % 3}") for i in range(60)], "doc_id long, text string")
    wanted = spark.createDataFrame([(i,) for i in range(0, 60, 4)], "doc_id long")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = L.cross_entropy_difference(docs, target_ids=wanted)
        plan = got._jdf.queryExecution().executedPlan()
        rows = {r["doc_id"]: r for r in got.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    text = plan.toString().split("Initial Plan")[-1].splitlines()
    assert sum("Exchange" in line for line in text) == 2 and any("Bucketed: true" in line for line in text)  # the wanted ids and the answers
    plain = {r["doc_id"]: r for r in L.cross_entropy_difference(docs, target=docs.join(wanted, "doc_id").select("text")).collect()}
    assert rows == plain and len(rows) == 60


def test_scores_count_every_word(spark, monkeypatch):
    monkeypatch.setattr(L, "CHUNK", 1 << 15)  # several chunks a task
    docs = [tuple(r) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(900, "qzx vbk qzx"), (901, "wjq pfk wjq"), (902, None), (903, " ")]
    target = [t for _, t in docs[:80]] + ["qzx vbk qzx"]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.cross_entropy_difference(df, spark.createDataFrame([(t,) for t in target], "text string")).collect()}
    score = brute.bigram_losses(target, [t for _, t in docs], None, L.SMOOTHING, L.WEIGHT)
    assert len(got) == len(docs) and len({w for _, t in docs for w in (t or "").lower().split()}) > 1023
    for i, text in docs:
        assert (got[i]["target_loss"], got[i]["background_loss"]) == pytest.approx(score(text), abs=1e-6)
    assert got[900]["selected"] and not got[901]["selected"]  # words met twice and once tell them apart


def test_scoring_query_matches_brute_force(spark):
    from beaconry.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{ROOT}/documents.parquet").collect()}
    good = {r["doc_id"] for r in spark.read.parquet(f"{ROOT}/labels.parquet").collect() if r["quality"] == 1}
    score = brute.bigram_losses([docs[i] for i in good if i in docs], docs.values(), None, L.SMOOTHING, L.WEIGHT)
    got = QUERIES["op5_lm_scoring"](spark, ROOT).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(docs)
    for r in got:
        assert (r["target_loss"], r["background_loss"]) == pytest.approx(score(docs[r["doc_id"]]), abs=1e-6)


def test_numbers_are_packed_and_read_back():
    for x in ([], [0, 0], [255], [256, 3], [1 << 63, 7, 0], list(range(1000))):
        a = np.array(x, dtype=np.uint64)
        assert (L._unpacked(L._packed(a), len(a)) == a).all() and (any(x) or L._packed(a) == b"")


def test_statistics_match_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{ROOT}/documents.parquet").select("doc_id", "text").collect()]
    line = "one two three four five six seven eight nine"
    rows += [(1000, None), (1001, ""), (1002, "\n \n"), (1003, f"{line}\n{line}\n{line} x"), (1004, "a " * 40), (1005, f"{line} {line}"),
             (1006, "é\x0b#\r\n#"), (1007, f"{line} t {line} u")]
    df = spark.createDataFrame([(i, t, None if i % 5 == 0 else "en", "s", 3) for i, t in rows], "doc_id long, text string, lang string, source string, g int")
    got = {r["doc_id"]: r for r in R.quality_rules(df).collect()}
    for i, t in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute.statistics(t), i
        assert not (r["base_failed"] and r["kept"])
    assert R.quality_rules(df.limit(0)).count() == 0


def test_outliers_match_numpy(spark):
    """Medians, concentration steps and distances in numpy on the same statistics."""
    rng = np.random.default_rng(4)
    rows = [(i, 0, *(float(x) for x in rng.normal(size=5) * [0.5, 0.1, 0.02, 0.02, 0.02])) for i in range(400)]
    rows += [(400 + i, 0, 0.0, 0.0, 5.0, 0.0, 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, ["id", "k", *R.NAMES]).selectExpr("id", "'g' AS g", *R.NAMES)
    fit = R.estimates(df).first()
    x = np.array([r[2:] for r in rows])

    def ranked(v, share):
        bins = np.sort(np.floor(v * R.BINS))
        return (bins[int(np.ceil(share * len(v) - 1e-9)) - 1] + 1) / R.BINS

    floor = np.array(list(R.FLOOR.values()))
    centre = np.array([ranked(x[:, j], 0.5) for j in range(5)])
    white = np.diag(1 / np.maximum(1.4826 * np.array([ranked(np.abs(x[:, j] - centre[j]), 0.5) for j in range(5)]), floor))
    for _ in range(R.STEPS):
        far = np.log1p((((x - centre) @ white.T) ** 2).sum(axis=1))
        near = x[far < ranked(far, R.SHARE)]
        centre, n = near.mean(axis=0), len(near)
        cover = R.CONSISTENCY * n / (n + R.PRIOR_ROWS) * np.cov(near.T, bias=True) + np.diag(floor ** 2)
        white = np.linalg.inv(np.linalg.cholesky(cover))
    assert [fit[f"m_{k}"] for k in R.NAMES] == pytest.approx(centre.tolist(), abs=1e-9)
    assert [fit[f"w_{i}_{j}"] for i in range(5) for j in range(i + 1)] == pytest.approx([white[i, j] for i in range(5) for j in range(i + 1)], abs=1e-6)
    d = (((x - centre) @ white.T) ** 2).sum(axis=1)
    assert (d[400:] > R.CUTOFF).all() and (d[:400] < R.CUTOFF).all()


def test_rules_agree_with_labels(spark):
    from beaconry.llm.queries import QUERIES

    root = "/root/testdata/sf0.01"
    rows = QUERIES["op8_quality_rules"](spark, root).join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id").where("n_words >= 20").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.15
