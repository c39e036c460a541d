"""The fact from spans of days: the rows of the fact from days."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from etalage.operators.series import THROUGH, fill_spans, unfold
from etalage.plans import dims, facts
from etalage.queries import REGISTRY

from conftest import SF_SMALL
from test_plans import plan
from test_spans import COLS, observed, same_rows


def silver_of(spark, shared):
    """Spans of two feeds; ``shared`` says whether they sell the same products."""
    spans = None
    for i, feed in enumerate(["f", "g"]):
        seen = observed(spark).withColumn("stock", F.col("stock") + i).withColumn("feed", F.lit(feed))
        if not shared:
            seen = seen.withColumn("image_url", F.concat("image_url", "feed"))
        part = fill_spans(seen, ["feed", "image_url", "name"], COLS, hash_of=["image_url", "name"])
        spans = part if spans is None else spans.unionByName(part)
    return spans.withColumn("date", F.col("date")).localCheckpoint()


@pytest.mark.parametrize("shared", [False, True])
@pytest.mark.parametrize("missing", [None, "product", "day", "order"])
def test_fact_of_spans_is_that_of_days(spark, shared, missing):
    spans = silver_of(spark, shared)
    products = spans.select("product_id").distinct()
    days = dims.dim_date(spans, THROUGH).select("date", "date_id")
    if missing == "product":
        products = products.filter(f"product_id <> {products.first()[0]}")
    if missing == "day":
        days = days.filter(F.col("date") != dt.date(2024, 1, 9))
    if missing == "order":
        days = days.withColumn("date_id", -F.col("date_id"))
    a = facts.fact_sales(unfold(spans), products, days)
    b = facts.fact_sales(spans, products, days, through=THROUGH)
    assert a.columns == b.columns
    rounded = F.round("sales", 9).alias("sales")
    same_rows(a.withColumn("sales", rounded), b.withColumn("sales", rounded))


def test_fact_moves_and_numbers_spans(spark):
    p = plan(REGISTRY["fact_sales"](spark, SF_SMALL))
    above = p[:p.index("Generate explode")]
    assert "Window" not in above and "Sort" not in above and "hashpartitioning" not in above
