"""Edge rows of the text cleaners (expected values worked out by hand)."""

import pytest
from pyspark.sql import functions as F

from etalage.functions import clean as C
from etalage.functions.keys import hash_key
from etalage.operators.filters import valid_key


def col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_price(spark):
    got = col(spark, ["2,50 €", "À partir de 2,50€", "1 299,00 €", "abc", "", None], C.parse_price)
    assert got == [2.5, 2.5, 1299.0, None, None, None]


def test_price_fixups(spark):
    assert col(spark, ["2150", "1975", "3.10"], C.parse_price_fixups) == [2.15, 1.975, 3.1]


def test_discounted_price(spark):
    df = spark.createDataFrame([("10", "20%"), ("10", ""), ("10", None), ("+10€", "50%")], "p string, d string")
    got = [r[0] for r in df.select(C.discounted_price("p", "d")).collect()]
    assert got == [pytest.approx(8.0), 10.0, None, 5.0]


def test_parse_stock(spark):
    got = col(spark, ["12", "3.5", "En Stock", "rupture", "", None, "-4"], C.parse_stock)
    assert got == [12.0, 3.5, -1.0, 0.0, 0.0, 0.0, 0.0]


def test_unit_price_text(spark):
    texts = ["12.50 € / KG", "3,20 € / L", "le flacon de 250ml", "1,067.50 € / KG", "n/a", "", None]
    assert col(spark, texts, C.leading_number) == [12.5, 3.2, None, None, None, None, None]
    assert col(spark, texts[:4], C.unit_after_slash) == ["KG", "L", "ml", "KG"]


def test_feed_c_units(spark):
    # price 3.00 with '12.50 € / KG' -> 240 g at 12500 (the model's factor), 0.0125 consistent
    df = spark.createDataFrame([(3.0, "12.50 € / KG")], "price double, t string")
    q = C.pack_size(F.col("price"), C.leading_number("t"))
    u = C.unit_after_slash("t")
    r = df.select(
        C.scale_quantity(q, u).alias("q"), C.rename_unit(u).alias("u"),
        C.scale_unit_price(C.leading_number("t"), u, q).alias("p"),
        C.scale_unit_price(C.leading_number("t"), u, q, consistent=True).alias("pc"),
    ).first()
    assert r.q == pytest.approx(240.0) and r.u == "g"
    assert r.p == pytest.approx(12500.0) and r.pc == pytest.approx(0.0125)


def test_rename_unit_whole_token(spark):
    assert col(spark, ["U", "kg", "UNITE", "Ul"], C.rename_unit) == ["UNITE", "g", "UNITE", "Ul"]


def test_clamp_and_zero(spark):
    assert col(spark, [9849.0, 9850.0, 10000.0, 10001.0], C.clamp_sentinel, "double") == [9849.0, 1.0, 1.0, 10001.0]
    assert col(spark, [0.0, 5.0, None], C.zero_to_null, "double") == [None, 5.0, None]


def test_hash_key(spark):
    df = spark.createDataFrame([("img/1-A", "item F"), ("ab", "c"), ("a", "bc"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(hash_key("a", "b")).collect()]
    assert got[0] == 306718228021784142
    assert got[1] == got[2]
    assert got[3] is None


def test_valid_key(spark):
    df = spark.createDataFrame([(None,), ("",), ("nan",), ("NaN",), ("x",)], "u string")
    assert [r.u for r in df.filter(valid_key("u")).collect()] == ["x"]
