"""Plan shapes that matter at scale."""

import time

import numpy as np

from etalage.operators.rank import global_rank, offsets_frame, uniform_range
from etalage.operators.sales import estimate_sales, with_mean_depletion
from etalage.operators.series import fill_series
from etalage.plans import dims, facts
from etalage.queries import REGISTRY
from etalage.sources import bindings as B
from etalage.sources.io import stored

from conftest import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed_by(p):
    """The keys of the plan's shuffles."""
    return [line.split("hashpartitioning(")[1].split(",")[0].split("#")[0] for line in p.splitlines()
            if "Exchange hashpartitioning(" in line]


def test_fill_series_has_no_join_or_nested_loop(spark):
    daily = B.evt_daily(spark, SF_SMALL).drop("ts", "event_id")
    p = plan(fill_series(daily, ["user_id", "event_type"], ["value"], "date", hash_col=None))
    assert "Window" in p and "NestedLoop" not in p and "Cartesian" not in p and "Join" not in p


def test_date_spine_is_a_generator(spark):
    p = plan(REGISTRY["date_spine"](spark, SF_SMALL))
    assert "NestedLoop" not in p and "Generate" in p


def test_numbering_moves_no_rows_to_one_partition(spark):
    """Sampled ranges and the fact's arithmetic ranges: the rows are shuffled once, by range, and never written."""
    o = B.obs(spark, SF_SMALL).select("image_url", "date", "l_orderkey", "l_linenumber", "price")
    p = plan(global_rank(o, ["image_url", "date", "l_orderkey", "l_linenumber"], ranges=8))
    assert keyed_by(p).count("_range") == 1 and "SinglePartition" not in p and "Scan parquet" in p
    assert "etalage-ckpt" not in p and "from_json" not in p  # the source's own files; bounds are a literal
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    numbered = spark.range(100).withColumn("r", uniform_range("id", 0, 100, 8)).withColumn(
        "n", F.row_number().over(Window.partitionBy("r").orderBy("id")))
    assert "SinglePartition" not in plan(numbered)


def test_fact_shuffles_the_rows_by_day_and_by_product_only(spark):
    silver = stored(B.feeds_silver(spark, SF_SMALL), "plan")
    days = stored(dims.dim_date(silver), "plan")
    products = spark.createDataFrame([(1,)], "product_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(facts.fact_rows(silver, products, days))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    keys = keyed_by(p.split("== Initial Plan ==")[-1])
    # series + day; days of a series; product (rows, dimension); the branch of rows without a product repeats them by day
    assert set(keys) <= {"_key", "product_id", "date_id"}, keys
    assert "SinglePartition" not in p and "NestedLoop" not in p


def executed(df):
    """The plan as it ran, after adaptive planning."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().toString().split("== Initial Plan ==")[0]


def test_chunked_lag_shuffles_the_rows_once(spark):
    silver = stored(B.obs_silver(spark, SF_SMALL), "plan")
    p = executed(with_mean_depletion(silver.select("image_url", "name", "date", "stock"), chunks=16))
    # rows move by chunk and series, once; the summaries (a row per chunk and series) by series, and back
    assert "ReusedExchange" in p and p.count("Scan parquet") == 1
    assert "hashpartitioning(image_url" not in p and "hashpartitioning(_of" in p
    sold = executed(estimate_sales(stored(B.obs_silver(spark, SF_SMALL), "plan"), chunks=16))  # the series' key is not in its result
    assert "ReusedExchange" in sold and sold.count("Scan parquet") == 1
    small = executed(with_mean_depletion(silver.select("image_url", "name", "date", "stock")))
    assert len(keyed_by(small)) == 1 and "Join" not in small


def test_fill_numbers_observations_not_days(spark):
    p = plan(B.obs_silver(spark, SF_SMALL, with_id=True))
    assert p.index("Generate posexplode") < p.index("sum(_days")  # above the numbering: the days come last


def test_dim_product_multiplies_no_row(spark):
    silver = stored(B.feeds_silver(spark, SF_SMALL), "plan")
    cat, pic = dims.dim_category(silver), dims.dim_picture(silver)
    p = plan(dims.dim_product(silver, cat, pic, dims.dim_store(silver, B.store_img(spark, SF_SMALL))))
    assert "min(id_category" in p


def test_many_ranges_cost_the_driver_little(spark):
    spark.range(1).count()
    t0 = time.time()
    df = offsets_frame(spark, np.arange(50_000, dtype=np.int32), np.ones(50_000, np.int64))
    df._jdf.queryExecution().executedPlan()
    assert time.time() - t0 < 2
    assert df.agg({"_offset": "max"}).first()[0] == 49_999


def test_scan_prunes_columns(spark):
    df = REGISTRY["source_scan"](spark, SF_SMALL)
    p = plan(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in p
