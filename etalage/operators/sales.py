"""Estimated sales from day-to-day stock changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.operators.series import lag_diff, unfold
from etalage.operators.steps import DOWN, DOWNS

#: what the sales of a span's days are told by: the stock before each, and the series' mean depletion
SOLD = ("_prev_stock", "mean_negative_stock_diff")


def sales_from_delta(diff: str | Column, mean_depletion: str | Column) -> Column:
    """L1: units sold on a day, from the stock difference to the previous day.

    A rise in stock is a restock, so the day is credited the series' mean
    depletion instead; a missing difference (first day) sells 0; otherwise the
    drop itself. A restock in a series that never dropped gives NULL.
    """
    d = F.col(diff) if isinstance(diff, str) else diff
    m = F.col(mean_depletion) if isinstance(mean_depletion, str) else mean_depletion
    return F.when(d > 0, m).when(d.isNull(), F.lit(0.0)).otherwise(F.abs(d)).cast("double")


def mean_depletion_agg(
    df: DataFrame, series_key: Sequence[str], diff: str = "raw_stock_diff", folded: bool = False
) -> DataFrame:
    """``avg(abs(diff)) where diff <= 0 group by series`` as a table.

    ``folded``: the rows are those of ``lag_diff(folded=True)``, spans with the sum and number of their falls."""
    if folded:
        mean = F.sum(DOWN) / F.sum(DOWNS)
        return df.filter(F.col(DOWNS) > 0).groupBy(*series_key).agg(mean.alias("mean_negative_stock_diff"))
    return (
        df.filter(F.col(diff) <= 0)
        .groupBy(*series_key)
        .agg(F.avg(F.abs(F.col(diff))).alias("mean_negative_stock_diff"))
    )


def with_mean_depletion(
    df: DataFrame, series_key: Sequence[str] = ("image_url",), date: str = "date", stock: str = "stock",
    tie_break: Sequence[str] = ("name",), chunks: int | None = None, through: str | None = None, folded: bool = False,
) -> DataFrame:
    """Stock difference and the series' mean depletion on every row.

    Adds ``raw_stock_diff`` and ``mean_negative_stock_diff``, without a self-join
    of the rows and without a task that holds a whole long series (see ``lag_diff``, also
    for ``through``: rows that stand for several days). ``folded`` leaves those as they are, with
    an array ``_prev_stock`` over their days instead of the difference.
    """
    stepped = lag_diff(df, series_key, date, stock, tie_break, prev="_prev_stock", diff="raw_stock_diff",
                       mean="mean_negative_stock_diff", chunks=chunks, through=through, folded=folded)
    return stepped if folded else stepped.drop("_prev_stock")


def estimate_sales(
    df: DataFrame,
    series_key: Sequence[str] = ("image_url",),
    date: str = "date",
    stock: str = "stock",
    tie_break: Sequence[str] = ("name",),
    product: str = "product_id",
    price: str = "price",
    quantity: str = "quantity",
    price_per_quantity: str = "price_per_quantity",
    unit: str = "unit",
    keep: Sequence[str] = (),
    chunks: int | None = None,
    through: str | None = None,
    folded: bool = False,
) -> DataFrame:
    """L2: one row per input row with its estimated ``sales``.

    The previous stock is taken along ``series_key`` ordered by ``date`` then
    ``tie_break`` (the picture, by default, although a product is picture +
    name; the tie-break makes rows of one day deterministic). Output:
    ``keep..., product_id, date, price, stock, quantity, price_per_quantity,
    unit, sales``. ``chunks`` is how many pieces the rows are cut into, and with
    ``through`` an input row stands for several days (see ``lag_diff``). ``folded`` then keeps the
    input's rows and ``through``, with ``SOLD`` in place of ``sales``: ``unfold_sales`` gives the days.
    """
    names = {product: "product_id", date: "date", price: "price", stock: "stock", quantity: "quantity",
             price_per_quantity: "price_per_quantity", unit: "unit"}
    needed = dict.fromkeys([*keep, *names, *series_key, *tie_break, *([through] if through else [])])
    stepped = with_mean_depletion(df.select(*needed), series_key, date, stock, tie_break, chunks, through, folded)
    out = [*keep, *[F.col(c).alias(as_) for c, as_ in names.items()]]
    if folded:
        return stepped.select(*out, through, *SOLD)
    return stepped.select(*out, sales_from_delta("raw_stock_diff", "mean_negative_stock_diff").alias("sales"))


def unfold_sales(spans: DataFrame, through: str) -> DataFrame:
    """The days of ``estimate_sales(folded=True)`` with their ``sales``."""
    days = unfold(spans, "date", through, [SOLD[0]])
    sales = sales_from_delta(F.col("stock") - F.col(SOLD[0]), F.col(SOLD[1]))
    return days.withColumn("sales", sales).drop(*SOLD)
