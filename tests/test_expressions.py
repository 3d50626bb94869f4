"""Column and vector expressions on hand-made rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from beaconry.functions import columns as C
from beaconry.functions import vectors as V
from beaconry.operators import clean


def one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_lenient_numbers_and_dates(spark):
    df = spark.createDataFrame([("abc",), ("12.7",), (" 5 ",), (None,)], "x string")
    got = [r[0] for r in df.select(C.lenient("x", "int")).collect()]
    assert got == [None, 12, 5, None]
    days = spark.createDataFrame([("31-01-2024",), ("2024-01-31",), ("99-99-2024",)], "d string")
    assert [r[0] for r in clean.reformat_date(days, "d").collect()] == ["2024-01-31", None, None]


def test_composed_text_keeps_blanks(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(C.joined_text(["x", "y", "z"])).first()[0] == "a  c"


def test_falsy_chain(spark):
    df = spark.createDataFrame([(0.0, 0.4, ""), (None, None, "n")], "a double, b double, s string")
    rows = df.select(C.first_truthy_number(["a", "b"]), C.first_truthy_text(["s"], "UNKNOWN")).collect()
    assert [tuple(r) for r in rows] == [(0.4, "UNKNOWN"), (0.0, "n")]


def test_empty_array_is_missing(spark):
    r = one(spark, C.first_truthy_array([F.array().cast("array<double>"), F.array(F.lit(1.0))]))
    assert r[0] == [1.0]


def test_decimal_roundtrip(spark):
    df = spark.createDataFrame([(0.1,), (1e-5,), (12345.678,)], "x double")
    assert [r[0] for r in df.select(C.to_double(C.to_decimal("x"))).collect()] == [0.1, 1e-5, 12345.678]


def test_padding(spark):
    r = one(spark, C.pad_list(F.array(F.lit("a")), 3), C.pad_vector(F.array(F.lit(2.0)), 3),
            C.pad_vector(F.lit(None).cast("array<double>"), 2))
    assert r[0] == ["a", None, None] and r[1] == [2.0, 0.0, 0.0] and r[2] == [0.0, 0.0]


def test_slots_and_duplicates(spark):
    r = one(spark, C.free_slots(F.array(*[F.lit(i) for i in range(22)])),
            C.has_duplicates(F.array(F.lit(1), F.lit(None), F.lit(None))), C.has_duplicates(F.array(F.lit(1), F.lit(1))))
    assert r[0] == [22, 23] and r[1] is False and r[2] is True


@pytest.mark.parametrize("category,band", [("Footwear", (1200, 3499)), ("Apparel", (800, 2499)),
                                           ("Accessories", (300, 1999)), ("Home", (500, 1999)), (None, (500, 1999))])
def test_price_bands(spark, category, band):
    df = spark.createDataFrame([(i, category, None) for i in range(50)], "product_id long, master_category string, price double")
    rows = clean.price_band_check(clean.impute_price(df)).collect()
    assert all((r["band_low"], r["band_high"]) == band and r["in_band"] for r in rows)


def vec(*xs):
    return F.array(*[F.lit(float(x)) for x in xs])


def test_cosine_uses_short_dot_and_full_norms(spark):
    r = one(spark, V.cosine(vec(1, 2, 3, 4), vec(1, 1)), V.cosine(vec(0, 0), vec(1, 1)), V.cosine(vec(1, 1), vec(0, 0)))
    assert r[0] == pytest.approx(3 / (math.sqrt(30) * math.sqrt(2)))
    assert r[1] == 0.0 and r[2] == 0.0


def test_cosine_is_symmetric_and_bounded(spark):
    df = spark.range(200).select(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.sin(i * (F.col("id") + 1))).alias("a"),
                                 F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.cos(i * (F.col("id") + 2))).alias("b"))
    for x, y in df.select(V.cosine("a", "b"), V.cosine("b", "a")).collect():
        assert x == pytest.approx(y) and -1 - 1e-9 <= x <= 1 + 1e-9


def test_hashed_words(spark):
    import hashlib

    text = "Red shoe  red SHOE hat"
    want = [0.0] * 16
    for w in text.lower().split():
        want[int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 16] += 1
    norm = math.sqrt(sum(x * x for x in want))
    df = spark.createDataFrame([(text,), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(V.hashed_words("t", 16)).collect()]
    assert got[0] == pytest.approx([x / norm for x in want])
    assert got[1] == [0.0] * 16 and got[2] == [0.0] * 16


def test_block_mean_and_unit(spark):
    r = one(spark, V.block_mean(vec(1, 2, 3, 4), 2), V.unit(vec(3, 4)), V.unit(vec(0, 0)))
    assert r[0] == [2.0, 3.0] and r[1] == pytest.approx([0.6, 0.8]) and r[2] == [0.0, 0.0]


def test_require_columns(spark):
    with pytest.raises(ValueError, match="user_id"):
        clean.require_columns(spark.range(1), ["user_id"])


def test_event_id_repeats(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1)], "x string, y int")
    ids = [r["id"] for r in clean.event_id(df).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_cosine_with_given_norms(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([1.0, 2.0, 2.0], [2.0]), ([0.0], [1.0])], "a array<double>, b array<double>")
    norms = V.magnitude("a") * V.magnitude("b")
    for x, y in df.select(V.cosine("a", "b"), V.cosine("a", "b", norms)).collect():
        assert x == y


def test_embedding_is_spread_over_tasks(spark):
    """A catalogue that is read as one task is embedded by many."""
    from beaconry.operators import embed

    one_task = spark.range(1000).selectExpr("concat('w', id) AS name").coalesce(1)
    assert embed.embed_text(one_task, ["name"], 8).rdd.getNumPartitions() > 1


def test_rounded_small_is_round(spark):
    """The shortcut gives the doubles of ``F.round``; halves, what lies beside them, large and special numbers included."""
    rng = random.Random(3)
    xs = [rng.uniform(-2, 2) for _ in range(2000)] + [rng.randrange(-10**6, 10**6) / 1e5 + 5e-9 for _ in range(500)]
    xs += [float(f"0.{rng.randrange(10**8):08d}5") for _ in range(500)] + [a / math.sqrt(b) for a in range(1, 40) for b in range(a * a, a * a + 40)]
    xs += [0.0, -0.0, -1e-12, 1e9, -3e300, math.inf, -math.inf, math.nan, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select(C.rounded_small("x", 8).alias("a"), F.round("x", 8).alias("b"), F.col("x")).where("NOT (a <=> b) OR string(a) <> string(b)").collect()
    assert not got
