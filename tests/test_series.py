"""Series spine, fill and the one-pass fill against the join formulation."""

import datetime as dt
import random

from pyspark.sql import functions as F

from etalage.operators.series import date_spine, fill_series, forward_fill, spine_left_join

D0 = dt.date(2024, 1, 1)


def day(n):
    return D0 + dt.timedelta(days=n)


def test_spine_limit_is_the_callers(spark):
    df = spark.createDataFrame([("k", day(0)), ("k", day(400)), ("j", day(5)), ("n", None)], "k string, date date")
    assert date_spine(df, ["k"], "date").count() == 402
    rows = date_spine(df, ["k"], "date", max_days=370).groupBy("k").agg(F.count("*").alias("n"), F.max("date").alias("last"))
    got = {r.k: (r.n, r.last) for r in rows.collect()}
    assert got == {"k": (371, day(370)), "j": (1, day(5))}


def test_forward_fill_values(spark):
    vals = [None, 5, None, None, 7]
    df = spark.createDataFrame([("k", day(i), v) for i, v in enumerate(vals)], "k string, date date, v int")
    got = [r.v for r in forward_fill(df, ["k"], "date", ["v"]).orderBy("date").collect()]
    assert got == [None, 5, 5, 5, 7]


def _join_form(df, keys, cols, max_days):
    joined = spine_left_join(df, keys, cols, "date", max_days)
    return forward_fill(joined, keys, "date", cols)


def test_fill_series_equals_join_form(spark):
    rnd = random.Random(5)
    rows = []
    for key in range(40):
        days = sorted(rnd.sample(range(900), rnd.randint(1, 12)))
        for d in days:
            rows.append((f"p{key % 7}", f"n{key}", day(d),
                         None if rnd.random() < 0.4 else rnd.randint(0, 50),
                         None if rnd.random() < 0.5 else rnd.choice("abc")))
    df = spark.createDataFrame(rows, "pic string, name string, date date, stock int, cat string")
    for max_days in (370, None, 3):
        fast = fill_series(df, ["pic", "name"], ["stock", "cat"], "date", max_days=max_days, hash_col=None)
        slow = _join_form(df, ["pic", "name"], ["stock", "cat"], max_days)
        cols = ["pic", "name", "date", "stock", "cat"]
        assert sorted(fast.select(cols).collect()) == sorted(slow.select(cols).collect())


def test_fill_series_ids_consecutive(spark):
    rows = [("p", f"n{i % 5}", day(i * 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "pic string, name string, date date").withColumn("v", F.lit(1))
    out = fill_series(df, ["pic", "name"], ["v"], "date", id_col="id").collect()
    ordered = sorted(out, key=lambda r: (r.pic, r.name, r.date))
    assert [r.id for r in ordered] == list(range(1, len(out) + 1))


def test_null_date_costs_its_row_only(spark):
    rows = [("p", None, 9), ("p", day(0), 1), ("p", day(3), 2), ("q", None, 5)]
    df = spark.createDataFrame(rows, "k string, date date, v int")
    for max_days in (None, 370):
        out = fill_series(df, ["k"], ["v"], "date", max_days=max_days, hash_col=None)
        assert [(r.date, r.v) for r in out.orderBy("date").collect()] == [(day(0), 1), (day(1), 1), (day(2), 1), (day(3), 2)]
