"""Steps along spans: days are put in order inside a task, not as rows."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from etalage import queries
from etalage.operators import steps
from etalage.operators.sales import estimate_sales, mean_depletion_agg
from etalage.operators.series import THROUGH, fill_spans, lag_diff, unfold
from etalage.queries import REGISTRY
from etalage.sources import bindings as B

from conftest import SF_SMALL
from test_plans import plan
from test_spans import COLS, observed, same_rows


@pytest.mark.parametrize("chunks", [None, 7])
def test_no_day_is_sorted_or_moved(spark, chunks):
    spans = fill_spans(observed(spark), ["image_url", "name"], COLS)
    p = plan(estimate_sales(spans, through=THROUGH, chunks=chunks))
    above = p[:p.index("Generate explode")]
    assert "Sort" not in above and "Window" not in above and "Exchange" not in above and "Join" not in above


def test_mean_depletion_unfolds_nothing(spark):
    p = plan(REGISTRY["agg_mean_depletion"](spark, SF_SMALL))
    assert "Generate" not in p


@pytest.mark.parametrize("chunks", [None, 9])
def test_folded_means_are_those_of_days(spark, chunks):
    odd = F.when(F.col("price").isNotNull() & (F.dayofmonth("date") == 7), F.lit(float("nan"))).otherwise(F.col("stock"))
    spans = fill_spans(observed(spark).withColumn("stock", odd), ["image_url", "name"], COLS)
    a = mean_depletion_agg(lag_diff(unfold(spans), ["image_url"], "date", "stock", ["name"], diff="raw_stock_diff"), ["image_url"])
    b = mean_depletion_agg(lag_diff(spans, ["image_url"], "date", "stock", ["name"], prev=None, chunks=chunks, through=THROUGH, folded=True),
                           ["image_url"], folded=True)
    rounded = F.round("mean_negative_stock_diff", 9).alias("mean_negative_stock_diff")
    same_rows(a.withColumn("mean_negative_stock_diff", rounded), b.withColumn("mean_negative_stock_diff", rounded))


def test_series_stay_whole_across_batches(monkeypatch):
    monkeypatch.setattr(steps, "DAYS_AT_ONCE", 5)
    rnd = random.Random(1)
    lengths = [rnd.randint(1, 9) for _ in range(40)]
    rn = [i + 1 for n in lengths for i in range(n)]
    whole = pa.record_batch({"_rn": rn, "_days": [2] * len(rn)})
    batches = [whole.slice(i, 4) for i in range(0, len(rn), 4)]
    found = list(steps._groups(iter([whole.slice(0, 0), *batches])))
    assert all(t["_rn"][0].as_py() == 1 for t in found) and len(found) > 5
    assert [r for t in found for r in t["_rn"].to_pylist()] == rn


@pytest.mark.parametrize("name, columns", [
    ("dim_category", None), ("dim_date", None), ("dim_picture", None), ("dim_store", None), ("dim_product", 8),
    ("join_dim_lookup", 4), ("sales_from_delta", 5), ("agg_mean_depletion", 5)])
def test_silver_is_written_with_what_is_read(spark, monkeypatch, name, columns):
    """A model that reads silver once reads it unwritten; the others write no column that nobody reads."""
    written = []
    keep = queries.stored
    monkeypatch.setattr(queries, "stored", lambda df, label: written.append((label, len(df.columns))) or keep(df, label))
    REGISTRY[name](spark, SF_SMALL)
    assert written == ([("silver", columns)] if columns else [])


def test_series_are_sorted_by_a_hash_first(spark):
    assert "xxhash64(" in plan(B.obs_spans(spark, SF_SMALL))
