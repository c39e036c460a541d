"""Gold sales fact (K6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions.clean import clamp_sentinel
from etalage.operators.dedup import dedup_first
from etalage.operators.rank import global_rank, running_total
from etalage.operators.sales import SOLD, estimate_sales, unfold_sales
from etalage.operators.series import unfold
from etalage.sources.io import stored

# product_id is the first 15 hex digits of an md5: spread evenly over [0, 2^60)
PRODUCT_ID_RANGE = (0, 1 << 60)
FACT_COLS = ["stock", "sales", "price", "quantity", "price_per_quantity", "unit", "product_id", "date_id"]


def _keep_highest_stock() -> list[Column]:
    # stock first as the model says; the rest only break its ties, over every column
    down = [F.col(c).desc_nulls_last() for c in ("stock", "price", "quantity")]
    return [*down, F.col("unit").asc_nulls_last(), F.col("sales").desc_nulls_last(),
            F.col("price_per_quantity").desc_nulls_last()]


def fact_rows(
    silver: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    series_key: Sequence[str] = ("image_url",),
    feed_col: str | None = "feed",
    through: str | None = None,
) -> DataFrame:
    """The fact without its numbers. With ``through`` a silver row stands for all days up to that column's.

    Big-side shuffles: series + day for the estimate, then ``product_id`` once.
    Both dedups, and the product lookup between them, work on the ``product_id``
    partitioning: a matched row's dimension key is its own ``product_id``. Rows
    without a product (normally none, which is asked first) share the NULL key and are deduplicated per
    day on their own. The date lookup is a calendar: one row per day.
    """
    keys = list(series_key)
    if feed_col and feed_col in silver.columns:
        keys = [feed_col, *keys]
    est = estimate_sales(silver, series_key=keys, tie_break=("name",), through=through)
    first = dedup_first(est.repartition("product_id"), ["product_id", "date"], _keep_highest_stock())
    known = dim_product.select("product_id", F.lit(True).alias("_known"))
    days = F.broadcast(dim_date.select("date", "date_id"))  # bounded by the calendar
    met = first.join(known, "product_id", "left").join(days, "date", "left").withColumn("sales", clamp_sentinel("sales"))
    matched = dedup_first(met.filter("_known"), ["product_id", "date_id"], _keep_highest_stock())
    if silver.select("product_id").distinct().join(known, "product_id", "left_anti").isEmpty():
        return matched.select(*FACT_COLS)  # no row for the other branch, which would sort them all again
    unmatched = dedup_first(met.filter("_known is null"), ["date_id"], _keep_highest_stock()).withColumn(
        "product_id", F.lit(None).cast("bigint"))
    return matched.select(*FACT_COLS).unionByName(unmatched.select(*FACT_COLS))


def _plain(silver: DataFrame, dim_product: DataFrame, dim_date: DataFrame, through: str) -> bool:
    """Whether every product is known, and every day is in a calendar that numbers days once each, in order."""
    in_order = Window.orderBy("date")  # bounded by the calendar
    days = dim_date.select("date", "date_id")
    odd = F.col("date").isNull() | F.col("date_id").isNull() | (F.lag("date").over(in_order) == F.col("date")) | (
        F.lag("date_id").over(in_order) >= F.col("date_id"))
    if not days.select(odd.alias("odd")).filter("odd").isEmpty():
        return False
    if not unfold(silver.select("date", through).distinct(), "date", through).distinct().join(days, "date", "left_anti").isEmpty():
        return False
    return silver.select("product_id").distinct().join(dim_product.select("product_id"), "product_id", "left_anti").isEmpty()


def fact_spans(silver: DataFrame, series_key: Sequence[str], through: str) -> DataFrame:
    """Spans of the fact, one at most for a product and a day, for silver that is ``_plain``.

    Spans of a product that do not meet hold its days once each. Where some meet (a product of
    several feeds, two pictures of one key), the product's days are unfolded and the highest
    stock of each is kept, as a span of one day."""
    est = estimate_sales(silver, series_key=series_key, tie_break=("name",), through=through, folded=True)
    of_product = Window.partitionBy("product_id")
    before = F.max(through).over(of_product.orderBy("date", through).rowsBetween(Window.unboundedPreceding, -1))
    met = est.repartition("product_id").withColumn("_meets", F.coalesce(before >= F.col("date"), F.lit(False)))
    spans = stored(met.withColumn("_meets", F.max("_meets").over(of_product)), "fact")
    once, twice = spans.filter("not _meets").drop("_meets"), spans.filter("_meets").drop("_meets")
    if twice.isEmpty():
        return once
    prev, mean = SOLD
    days = unfold_sales(twice.withColumn("_was", F.col(prev)).withColumn("_mean", F.col(mean)).withColumn("_from", F.col("date")), through)
    days = days.withColumn(prev, F.array(F.get("_was", F.datediff("date", "_from")))).withColumnRenamed("_mean", mean)
    kept = dedup_first(days, ["product_id", "date"], _keep_highest_stock()).withColumn(through, F.col("date"))
    return stored(once.unionByName(kept.select(*once.columns)), "fact")


def fact_sales(
    silver: DataFrame,
    dim_product: DataFrame,
    dim_date: DataFrame,
    series_key: Sequence[str] = ("image_url",),
    feed_col: str | None = "feed",
    through: str | None = None,
) -> DataFrame:
    """K6: estimated daily sales per product.

    Per feed: estimate sales along each picture; all feeds together: keep the
    highest-stock row per (product, day), look up the product and date keys,
    clamp the sentinel range to 1, keep one row per (product_id, date_id) and
    number the rows by (product_id, date_id). The rows are written once, after
    the second dedup; the counting and the numbering read that table.

    With ``through`` a silver row stands for all days up to that column's, and is what is
    estimated, deduplicated (``fact_spans``), written and numbered, weighing its days; they are unfolded
    last. Where a product or a day is in no dimension, the days themselves are.
    """
    if through and _plain(silver, dim_product, dim_date, through):
        keys = [*([feed_col] if feed_col and feed_col in silver.columns else []), *series_key]
        spans = fact_spans(silver, keys, through).withColumn("_days", F.datediff(through, "date") + 1).withColumn("_from", F.col("date"))
        spans = running_total(spans, ["product_id", "date"], "_before", "_days", uniform_leading=PRODUCT_ID_RANGE)
        days = unfold_sales(spans, through).withColumn("sales", clamp_sentinel("sales"))
        number = F.col("_before") + F.datediff("date", "_from") + 1  # days are numbered in order, so dates are in the order of their keys
        known = F.broadcast(dim_date.select("date", "date_id"))  # bounded by the calendar
        return days.join(known, "date", "left").select(number.alias("id"), *FACT_COLS)
    rows = stored(fact_rows(silver, dim_product, dim_date, series_key, feed_col, through), "fact")
    return global_rank(rows, ["product_id", "date_id"], out="id", uniform_leading=PRODUCT_ID_RANGE)
