"""Feature, profile, upsert and source operators."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry import schemas
from beaconry.operators import clean, embed
from beaconry.operators import features as X
from beaconry.operators import profile as P
from beaconry.sources import tables, upsert
from beaconry.sources.writers import parquet_chunks

D = dt.date


def purchases(spark, rows):
    return spark.createDataFrame([(f"p{i}", u, p, 1, float(a), float(a), d) for i, (u, p, a, d) in enumerate(rows)],
                                 "purchase_id string, user_id long, product_id long, quantity int, price double, total_amount double, purchase_date date")


def products(spark):
    return spark.createDataFrame([(1, "shoe", "Footwear"), (2, "shirt", "Apparel"), (2, "shirt", "Apparel"), (3, "sandal", "Footwear")],
                                 "product_id long, article_type string, master_category string")


def test_user_features_unknown_product_takes_a_rank(spark):
    day = D(2024, 1, 1)
    rows = [(1, 99, 10, day)] * 3 + [(1, 1, 10, day)] * 2 + [(1, 2, 5, D(2024, 2, 1))]
    users = spark.createDataFrame([(1, "Ann", "secret", "2023-12-31"), (2, "Bob", "secret", None)], "user_id long, name string, password_hash string, created_at string")
    r = X.user_features(purchases(spark, rows), users, products(spark), "2024-01-10", k=2).collect()
    assert len(r) == 1 and "password_hash" not in r[0].asDict()
    assert (r[0]["total_orders"], r[0]["total_spent"], r[0]["last_purchase_date"]) == (6, 55.0, D(2024, 2, 1))
    assert r[0]["top_article_types"] == "shoe" and r[0]["top_master_categories"] == "Footwear"
    assert r[0]["days_since_signup"] == 10 and r[0]["avg_order_value"] == pytest.approx(55 / 6)


def test_both_feature_forms_agree(spark):
    rnd = random.Random(1)
    rows = [(1 if i % 3 == 0 else rnd.randrange(9), rnd.choice([1, 2, 3, 99]), rnd.randrange(50), D(2024, 1, 1 + rnd.randrange(28))) for i in range(300)]
    p, cat = purchases(spark, rows), X.one_per_product(products(spark))
    users = spark.createDataFrame([(i, f"n{i}", D(2023, 1, 1)) for i in range(9)], "user_id long, name string, created_at date")
    one = X.user_features(p, users, cat, "2024-03-01", 2)
    many = X.joined_user_features(p, users, cat, "2024-03-01", 2)
    cols = sorted(one.columns)
    assert sorted(map(str, one.select(cols).collect())) == sorted(map(str, many.select(cols).collect()))


def test_positions_and_pages(spark):
    rows = [(1, i, 1, D(2024, 1, 1 + i % 5)) for i in range(23)] + [(2, 5, 1, D(2024, 1, 1))]
    p = purchases(spark, rows)
    pos = [r["product_id"] for r in X.purchase_positions(p).filter("user_id = 1").orderBy("position").collect()]
    assert pos == [i for _, i in sorted((-(i % 5), i) for i in range(23))]
    pages = X.purchase_lists(p, page=10).orderBy("user_id", "page").collect()
    assert [(r["user_id"], r["page"], len(r["purchases"])) for r in pages] == [(1, 0, 10), (1, 1, 10), (1, 2, 3), (2, 0, 1)]
    assert [x["product_id"] for r in pages[:3] for x in r["purchases"]] == pos


def test_last_k(spark):
    p = purchases(spark, [(1, i, 1, D(2024, 1, 1 + i)) for i in range(7)])
    assert [r["product_id"] for r in X.last_k(p, 3).orderBy("rn").collect()] == [6, 5, 4]
    assert [r["product_id"] for r in X.last_k(p, 3, order="purchase_id").orderBy("rn").collect()] == [0, 1, 2]


def test_user_embeddings(spark):
    p = purchases(spark, [(1, 1, 1, D(2024, 1, 1)), (1, 9, 1, D(2024, 1, 2))])
    vecs = spark.createDataFrame([(1, [1.0, 2.0])], "product_id long, embedding array<double>")
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    got = {r["user_id"]: r["embedding"] for r in embed.user_embeddings(users, p, vecs, 3, 2).collect()}
    assert got == {1: [0.0, 0.0, 1.0, 2.0, 0.0, 0.0], 2: [0.0] * 6}
    assert embed.user_embeddings(users, p, vecs, 3, 2, include_inactive=False).count() == 1


def test_encoder_plug_in(spark):
    def load():
        return lambda texts: [[float(len(t)), 1.0] for t in texts]

    df = spark.createDataFrame([("ab", None)], "name string, status string")
    assert embed.embed_text(df, ["name", "status"], 2, load).first()["embedding"] == [3.0, 1.0]


def test_delta_equals_full(spark):
    cur = spark.createDataFrame([(i, f"word{i} red", None) for i in range(20)], "campaign_id long, name string, description string")
    old = cur.filter("campaign_id < 15").withColumn("name", F.when(F.col("campaign_id") % 2 == 0, "blue").otherwise(F.col("name")))
    stored = embed.embed_text(embed.content_hash(old, embed.CAMPAIGN_TEXT), embed.CAMPAIGN_TEXT, 8)
    assert embed.changed_rows(cur, stored, "campaign_id", embed.CAMPAIGN_TEXT).count() == 5 + 8
    out = embed.delta_embeddings(stored, cur, "campaign_id", embed.CAMPAIGN_TEXT, 8).select("campaign_id", "embedding")
    full = embed.embed_text(cur, embed.CAMPAIGN_TEXT, 8).select("campaign_id", "embedding")
    assert out.exceptAll(full).count() == 0 and out.count() == 20


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_exact_percentiles(spark, accuracy):
    """With a coarse sketch the bracket really cuts; the result must stay exact."""
    rng = np.random.default_rng(2)
    hot = np.where(rng.random(9000) < 0.34, 7.0, rng.lognormal(size=9000))
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.95, 0.999, 1.0]
    df = spark.createDataFrame([(i % 3, float(v)) for i, v in enumerate(hot)] + [(0, None)], "g int, v double")
    got = {r["prob"]: r["value"] for r in P.exact_percentiles(df, "v", probs, accuracy=accuracy).collect()}
    assert [got[p] for p in probs] == pytest.approx([float(np.quantile(hot, p)) for p in probs])
    by = {(r["g"], r["prob"]): r["value"] for r in P.exact_percentiles(df, "v", probs, ["g"], accuracy=accuracy).collect()}
    for g in range(3):
        assert [by[g, p] for p in probs] == pytest.approx([float(np.quantile(hot[g::3], p)) for p in probs])


def test_describe_text_and_profiles(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "x string")
    assert tuple(P.describe_text(df, "x").first()) == (5, 3, "a", 2)
    assert tuple(P.key_profile(df, ["x"]).first()) == (4, 6)
    assert tuple(P.null_profile(df).first()) == ("x", 1, 5)
    assert [tuple(r) for r in P.value_counts(df, "x").collect()] == [("a", 2), ("b", 2), ("c", 1), (None, 1)]


# -- upserts and files ---------------------------------------------------------------

def test_upserts_are_idempotent(spark, tmp_path):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "k long, v string, n int")
    delta = spark.createDataFrame([(2, "c", 2), (2, "d", 3), (3, "e", 1)], "k long, v string, n int")
    want = [(1, "a", 1), (2, "d", 3), (3, "e", 1)]
    path = str(tmp_path / "t")
    for df in (base, delta, delta):
        upsert.upsert_table(path, df, ["k"], [F.col("n").desc()], buckets=4)
        rows = sorted(tuple(r) for r in upsert.read_table(spark, path).select("k", "v", "n").collect())
    assert rows == want
    once = upsert.upsert_merge(base, delta.filter("n > 2 or k = 3"), ["k"], ["v"])
    again = upsert.upsert_merge(once, delta.filter("n > 2 or k = 3"), ["k"], ["v"])
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, again.collect())) == [(1, "a", 1), (2, "d", 1), (3, "e", None)] \
        or sorted(map(str, once.collect())) == sorted(map(str, again.collect()))


def test_merge_can_set_null_and_add_columns(spark):
    base = spark.createDataFrame([(1, "a")], "k long, v string")
    delta = spark.createDataFrame([(1, None, 5)], "k long, v string, w int")
    assert upsert.upsert_merge(base, delta, ["k"], ["v", "w"]).first().asDict() == {"k": 1, "v": None, "w": 5}


def test_csv_modes(spark, tmp_path):
    path = tmp_path / "u.csv"
    path.write_text('user_id,name,email,created_at\nU1,"Smith, Jo ☃",j@x.org,2024-01-02\nU2,Al,a@x.org,nonsense\n', encoding="utf-8")
    ok = tables.read_csv(spark, str(path), schemas.USERS, "DROPMALFORMED").collect()
    assert [(r["name"], r["created_at"]) for r in ok] == [("Smith, Jo ☃", D(2024, 1, 2))]
    good, bad = tables.read_csv_quarantine(spark, str(path), schemas.USERS)
    assert [r["user_id"] for r in good.collect()] == ["U1"] and bad.collect()[0]["raw"].startswith("U2")
    assert dict(tables.read_csv(spark, str(path)).dtypes)["name"] == "string"


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", None])], "k long, l array<string>")
    tables.write_csv(df, str(tmp_path / "c"))
    assert tables.read_csv(spark, str(tmp_path / "c")).first()["l"] == '["a",null]'
    tables.write_table(spark.range(100).repartition(8), str(tmp_path / "p"), files=1)
    assert len(list((tmp_path / "p").glob("part-*"))) == 1
    empty = tables.ensure_table(spark, str(tmp_path / "e"), T.StructType([T.StructField("k", T.LongType())]))
    assert empty.count() == 0 and tables.ensure_table(spark, str(tmp_path / "e"), empty.schema).count() == 0
    tables.foreach_partition_sink(spark.range(25), parquet_chunks(str(tmp_path / "w")), chunk=4)
    tables.foreach_partition_sink(spark.range(25), parquet_chunks(str(tmp_path / "w")), chunk=4)  # a retry adds nothing
    assert spark.read.parquet(str(tmp_path / "w")).count() == 25


def test_active_and_lookup(spark):
    c = spark.createDataFrame([("a", "active", D(2024, 1, 1), D(2024, 1, 31)), ("b", "paused", D(2024, 1, 1), D(2024, 1, 31)),
                               ("c", "active", D(2024, 2, 1), D(2024, 2, 2))], "campaign_id string, status string, start_date date, end_date date")
    assert [r[0] for r in clean.active_campaigns(c, "2024-01-31").collect()] == ["a"]
    keys = spark.createDataFrame([("c",), ("c",)], "campaign_id string")
    assert tables.lookup(c, keys, ["campaign_id"]).count() == 1


def test_percentiles_whose_bracket_misses(spark, monkeypatch):
    """A sketch far too coarse, a small bound and wild values: brackets miss or hold too much, the values stay exact."""
    import numpy as np

    rng = np.random.default_rng(2)
    probs = [0.0, 0.01, 0.5, 0.95, 0.999, 1.0]
    groups = {"wild": 10.0 ** rng.uniform(-300, 300, 900), "two": rng.choice([0.0, 1.0], 800), "one": np.full(500, 7.0), None: rng.normal(size=700)}
    rows = [(g, float(x)) for g, v in groups.items() for x in v]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r["g"], r["prob"]): r["value"] for r in P.exact_percentiles(df, "v", probs, ["g"], accuracy=3, most=20).collect()}
    assert got == {(g, p): pytest.approx(np.percentile(v, 100 * p)) for g, v in groups.items() for p in probs}
    values = np.array([x for _, x in rows])
    whole = {r["prob"]: r["value"] for r in P.exact_percentiles(df, "v", probs, accuracy=5, most=100).collect()}
    assert whole == {p: pytest.approx(np.percentile(values, 100 * p)) for p in probs}
    # a first bracket that misses its rank: the sketch's edges are shifted
    real = F.percentile_approx
    shifted = lambda c, e, a: F.transform(real(c, e, a), lambda x: x + 1e6) if a == 50 else real(c, e, a)
    monkeypatch.setattr(P.F, "percentile_approx", shifted)
    assert P.exact_percentiles(spark.range(2000).select(F.col("id").cast("double").alias("v")), "v", [0.25], accuracy=50).first()["value"] == 499.75
