"""Gold dimensions (K1-K5).

Each takes the silver table of all feeds stacked by name (``stack_feeds``);
a UNION of the four feeds followed by DISTINCT is the DISTINCT of the stack,
and a UNION ALL of per-feed DISTINCTs is the DISTINCT of the stack including
its ``feed`` column. Silver is meant to be a written table: its narrow column
scan is what a dimension costs. Rows may be days or spans of days (``fill_spans``):
only ``dim_date`` needs to be told.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from etalage.operators.dedup import dedup_first
from etalage.operators.filters import not_blank
from etalage.operators.rank import global_rank
from etalage.operators.series import unfold
from etalage.sources.io import stored


def dim_category(silver: DataFrame) -> DataFrame:
    """K1: one row per (section, category), numbered by section then category."""
    pairs = silver.select("category", "section").filter(not_blank("category", "section")).distinct()
    return global_rank(stored(pairs, "pairs"), ["section", "category"], out="id_category").select("id_category", "section", "category")


def dim_date(silver: DataFrame, through: str | None = None) -> DataFrame:
    """K2: calendar of all days present, with day / month / year parts.

    With ``through`` a row stands for all days up to that column's: different spans are unfolded, not rows."""
    days = silver.select(F.col("date").cast("date").alias("date"), *([through] if through else [])).filter(
        F.col("date").isNotNull()).distinct()
    if through:
        days = unfold(days, "date", through).distinct()
    return global_rank(stored(days, "days"), ["date"], out="date_id").select(
        "date_id",
        F.dayofmonth("date").cast("long").alias("day"),
        F.month("date").cast("long").alias("month"),
        F.year("date").cast("long").alias("year"),
        "date",
    )


def dim_picture(silver: DataFrame) -> DataFrame:
    """K3: one row per non-blank picture URL."""
    pics = silver.select(F.col("image_url").alias("picture")).filter(not_blank("picture")).distinct()
    return global_rank(stored(pics, "pictures"), ["picture"], out="id_picture").select("id_picture", "picture")


def dim_store(silver: DataFrame, store_img: DataFrame) -> DataFrame:
    """K4: one row per non-blank store, with its first picture (by ``image_str``, NULLs last)."""
    stores = silver.select("store").filter(not_blank("store")).distinct()
    imgs = dedup_first(store_img.select("store", "image_str"), ["store"], [F.col("image_str").asc_nulls_last()])
    joined = stores.join(imgs, on="store", how="left")
    return global_rank(stored(joined, "stores"), ["store"], out="id_store").select("id_store", "store", "image_str")


def dim_product(
    silver: DataFrame,
    category: DataFrame,
    picture: DataFrame,
    store: DataFrame,
    feed_col: str | None = "feed",
) -> DataFrame:
    """K5: one row per product with its category, picture and store keys.

    The category is looked up by name alone although the dimension key is
    (section, category): the lowest ``id_category`` of the name is what the
    dedup keeps (NULLs first, so a product seen uncategorised keeps NULL), so it
    is taken before the join and no product row is multiplied. A feed that knows
    the brand wins over feeds without one.
    """
    cols = ["product_id", "name", "category", F.col("image_url").alias("picture"), "store"]
    cols.append("marque" if "marque" in silver.columns else F.lit(None).cast("string").alias("marque"))
    if feed_col and feed_col in silver.columns:
        cols.append(feed_col)
    products = silver.select(*cols).distinct()
    lowest = category.groupBy("category").agg(F.min("id_category").alias("id_category"))
    joined = (
        products.join(lowest, on="category", how="left")
        .join(picture.select("picture", "id_picture"), on="picture", how="left")
        .join(store.select("store", "id_store"), on="store", how="left")
    )
    order = [F.col(c).asc_nulls_first() for c in ("id_category", "id_store", "id_picture", "name")]
    return dedup_first(joined, ["product_id"], [*order, F.col("marque").asc_nulls_last()]).select(
        "product_id", "name", "marque", "id_category", "id_picture", "id_store"
    )
