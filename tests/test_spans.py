"""Silver as spans of days: the same rows, with a row per observation until days are needed."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from etalage.operators import series
from etalage.operators.sales import estimate_sales
from etalage.operators.series import THROUGH, fill_series, fill_spans, spine_left_join, unfold
from etalage.operators.sort import zorder_for_write
from etalage.plans import dims
from etalage.queries import REGISTRY
from etalage.sources import bindings as B

from conftest import SF_SMALL
from test_plans import executed, keyed_by, plan

D0 = dt.date(2024, 1, 1)
COLS = ["stock", "price", "quantity", "price_per_quantity", "unit"]


def observed(spark, names=4):
    rnd = random.Random(3)
    rows = {}
    for _ in range(600):
        pic = rnd.choice(["hot", "hot", "a", "b"])
        rows[pic, f"n{rnd.randint(0, names)}", D0 + dt.timedelta(days=rnd.randint(0, 200))] = (
            None if rnd.random() < 0.2 else float(rnd.randint(0, 20)), 1.0, 1.0, 1.0, "g")
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()], "image_url string, name string, date date, stock double, "
                                 "price double, quantity double, price_per_quantity double, unit string")


def same_rows(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    assert sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


@pytest.mark.parametrize("chunks", [None, 2, 9, 70])
@pytest.mark.parametrize("key", ["image_url", "unit"])
def test_sales_of_spans_are_those_of_days(spark, chunks, key):
    keys = ["image_url", "name"]
    dense, spans = fill_series(observed(spark), keys, COLS), fill_spans(observed(spark), keys, COLS)
    tie = ("name",) if key == "image_url" else ("image_url", "name")
    a = estimate_sales(dense, [key], tie_break=tie, keep=keys)
    b = estimate_sales(spans, [key], tie_break=tie, keep=keys, chunks=chunks, through=THROUGH)
    rounded = F.round("sales", 9).alias("sales")
    same_rows(a.withColumn("sales", rounded), b.withColumn("sales", rounded))


def test_a_long_series_is_cut_and_short_ones_are_not(spark, monkeypatch):
    spans = fill_spans(observed(spark), ["image_url", "name"], COLS)
    p = executed(estimate_sales(spans, through=THROUGH))
    assert "Join" not in p and p.count("repartition") <= 1
    monkeypatch.setattr(series, "ROWS_PER_CHUNK", 100)
    assert "Join" in plan(estimate_sales(spans, through=THROUGH))


def test_many_short_series_need_no_chunks(spark, monkeypatch):
    monkeypatch.setattr(series, "ROWS_PER_CHUNK", 2000)
    dense = fill_series(observed(spark), ["image_url", "name"], COLS)
    assert dense.count() > 2000
    p = plan(estimate_sales(dense, ["image_url", "name"], tie_break=()))
    assert "Join" not in p


def test_sold_silver_moves_spans(spark):
    """The shuffle by series is below the generator of the days, and the days are never written."""
    p = executed(REGISTRY["estimate_sales"](spark, SF_SMALL))
    assert p.index("Generate explode") < p.index("hashpartitioning(_key") and len(keyed_by(p)) == 1


def test_surrogate_is_made_per_observation(spark):
    p = plan(B.obs_silver(spark, SF_SMALL))
    assert p.index("Generate explode") < p.index("md5(")


def test_spine_join_shuffles_observations_only(spark):
    df = observed(spark)
    p = plan(spine_left_join(df, ["image_url", "name"], ["stock"]))
    assert "Join" not in p and len(keyed_by(p)) == 1


def test_spine_join_keeps_repeated_days(spark):
    rows = [("k", D0, 1), ("k", D0, 2), ("k", D0 + dt.timedelta(days=2), 3), ("k", None, 4), (None, D0, 5)]
    df = spark.createDataFrame(rows, "k string, date date, v int")
    got = sorted((r.date.day, r.v or 0) for r in spine_left_join(df, ["k"], ["v"]).collect())
    assert got == [(1, 1), (1, 2), (2, 0), (3, 3)]


def test_days_of_spans(spark):
    spans = fill_spans(observed(spark), ["image_url", "name"], COLS)
    same_rows(dims.dim_date(unfold(spans)), dims.dim_date(spans, THROUGH))


def test_zorder_of_spans(spark):
    spans = fill_spans(observed(spark), ["image_url", "name"], COLS)
    out = zorder_for_write(spans, ["image_url", "date"], 6, bits=3, date="date", through=THROUGH)
    same_rows(out, unfold(spans))
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_total_sort_is_sorted_across_partitions(spark):
    out = REGISTRY["sort_total"](spark, SF_SMALL)
    p = plan(out)
    assert p.index("Generate explode") < p.index("rangepartitioning(image_url")  # spans are sorted, not days
    got = [(r.image_url, r.name, r.date) for r in out.select("image_url", "name", "date").collect()]
    assert got == sorted(got)


def test_raw_lines_are_made_once(spark):
    raw = B.raw_tables(spark, SF_SMALL)
    for name in ("auchan", "biocoop", "carrefour", "labellevie"):
        p = plan(raw[name])
        assert "Window" not in p and "Join" not in p


def test_a_feed_is_numbered_from_written_lines(spark):
    p = plan(REGISTRY["bronze_feed_unit_price"](spark, SF_SMALL))
    assert "lineitem" not in p and "l_partkey" not in p
