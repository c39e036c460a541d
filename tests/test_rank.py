"""Distributed global rank equals row_number over the whole table."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from etalage.operators.rank import global_rank


def _check(df, order, **kw):
    ours = global_rank(df, order, out="id", **kw)
    plain = df.withColumn("id", F.row_number().over(Window.orderBy(*[F.col(c).asc_nulls_first() for c in order])))
    a = sorted(ours.select("id", *order).collect(), key=lambda r: r.id)
    b = sorted(plain.select("id", *order).collect(), key=lambda r: r.id)
    assert [r.id for r in a] == list(range(1, df.count() + 1))
    assert repr(a) == repr(b)  # NaN is equal to itself here


def test_rank_with_nulls_and_hot_key(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        hot = i % 3 == 0  # a third of the rows share one leading value
        rows.append(("hot" if hot else (None if i % 17 == 0 else f"k{rnd.randint(0, 300)}"),
                     None if i % 13 == 0 else rnd.randint(0, 10**6), i))
    df = spark.createDataFrame(rows, "a string, b long, c long")
    for m in (1, 4, 16, 64):
        _check(df, ["a", "b", "c"], ranges=m)


def test_rank_uniform_leading(spark):
    rows = [(None if i % 11 == 0 else (i * 7919) % (1 << 20), i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "p long, d long").dropDuplicates()
    _check(df, ["p", "d"], uniform_leading=(0, 1 << 20), ranges=8)


def test_rank_dates_and_empty(spark):
    df = spark.range(500).select(
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 37 % 400).cast("int")).alias("d"),
        F.col("id").alias("i"),
    )
    _check(df, ["d", "i"], ranges=6)
    assert global_rank(df.limit(0), ["d", "i"]).count() == 0


def test_rank_of_every_type_and_of_equal_keys(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 5 > 0, F.expr("timestamp_micros(id % 7 * 1000003)")).alias("t"),
        F.expr("timestamp_ntz'2020-01-01 00:00:00.000001' + make_interval(0, 0, 0, 0, 0, 0, id % 9 / 1000000)").alias("n"),
        F.when(F.col("id") % 3 > 0, (F.col("id") % 11 / 7).cast("double")).otherwise(float("nan")).alias("f"),
        (F.col("id") % 4).cast("decimal(12,3)").alias("m"), F.expr("id % 2 = 0").alias("b"),
        F.concat(F.lit("é\"\\ "), F.col("id") % 13).alias("s"), F.col("id").alias("i"))
    _check(df, ["t", "n", "f", "m", "b", "s", "i"], ranges=20)
    same = spark.range(300).select(F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"))
    assert sorted(r.id for r in global_rank(same, ["a", "b"], ranges=9).collect()) == list(range(1, 301))


def test_running_total_of_weights(spark):
    from etalage.operators.rank import running_total

    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), (F.col("id") % 5).alias("w"))
    for m in (1, 8):
        got = running_total(df, ["k"], "before", "w", ranges=m).orderBy("k").collect()
        total = 0
        for r in got:
            assert r.before == total
            total += r.w


def test_rank_refuses_no_ranges(spark):
    import pytest

    with pytest.raises(ValueError):
        global_rank(spark.range(3), ["id"], ranges=0)
