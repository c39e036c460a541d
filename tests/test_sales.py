"""Sales from stock deltas."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from etalage.operators.sales import estimate_sales, sales_from_delta

D0 = dt.date(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(
        [(pic, name, D0 + dt.timedelta(days=d), None if s is None else float(s), 1, 1.0, 1.0, 1.0, "g")
         for pic, name, d, s in rows],
        "image_url string, name string, date date, stock double, product_id long, price double, "
        "quantity double, price_per_quantity double, unit string",
    )


def test_restock_rule(spark):
    df = frame(spark, [("p", "n", i, s) for i, s in enumerate([10, 7, 7, 12, 11])])
    got = [r.sales for r in estimate_sales(df).orderBy("date").collect()]
    assert got == [0.0, 3.0, 0.0, pytest.approx(4 / 3), 1.0]


def test_restock_without_depletion(spark):
    df = frame(spark, [("p", "n", 0, 3), ("p", "n", 1, 9)])
    assert [r.sales for r in estimate_sales(df).orderBy("date").collect()] == [0.0, None]


@pytest.mark.parametrize("chunks", [None, 1, 2, 7, 60])
def test_chunked_form_equals_window_form(spark, chunks):
    rnd = random.Random(11)
    rows = []
    for i in range(2500):
        pic = "hot" if i % 3 == 0 else f"p{rnd.randint(0, 30)}"
        rows.append((pic, f"n{rnd.randint(0, 40)}", rnd.randint(0, 60),
                     None if rnd.random() < 0.1 else float(rnd.randint(0, 20))))
    df = frame(spark, rows).dropDuplicates(["image_url", "name", "date"])
    df = df.withColumn("image_url", F.when(F.col("image_url") != "p7", F.col("image_url")))
    _compare(df, estimate_sales(df, keep=["image_url", "name"], chunks=chunks))


def test_one_hot_day_is_cut(spark):
    """A picture whose third of all rows lies on one day goes to many chunks; the carry crosses them."""
    rows = [("hot", f"n{i:05d}", 3, float(i * 37 % 11)) for i in range(1500)] + [("hot", "z", d, float(d)) for d in (1, 2, 4, 5)]
    rows += [(f"p{i % 500}", "n", i // 500, float(i * 13 % 7)) for i in range(3000)]
    df = frame(spark, rows)
    _compare(df, estimate_sales(df, keep=["image_url", "name"], chunks=40))
    from etalage.operators.ranges import range_of, sampled_bounds

    keys = ["image_url", "date", "name"]
    bounds = sampled_bounds(df, keys, 40, df.count())
    hot = df.filter("image_url = 'hot' and date = '2024-01-04'").groupBy(range_of(df, keys, bounds).alias("chunk")).count().collect()
    assert len(hot) > 8 and max(r["count"] for r in hot) < 500


def test_null_series_key_is_a_series(spark):
    df = frame(spark, [(None, "n", i, s) for i, s in enumerate([10, 7, 7, 12, 11])])
    for chunks in (None, 3):
        got = [r.sales for r in estimate_sales(df, chunks=chunks).orderBy("date").collect()]
        assert got == [0.0, 3.0, 0.0, pytest.approx(4 / 3), 1.0]


def _compare(df, ours):
    w = Window.partitionBy("image_url").orderBy("date", "name")
    d = df.withColumn("diff", F.col("stock") - F.lag("stock").over(w))
    mean = F.avg(F.when(F.col("diff") <= 0, F.abs("diff"))).over(Window.partitionBy("image_url"))
    plain = d.select("image_url", "name", "date", sales_from_delta("diff", mean).alias("sales"))

    def key(r):
        return (r.image_url, r.name, r.date)

    a = {key(r): r.sales for r in ours.collect()}
    b = {key(r): r.sales for r in plain.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k])
