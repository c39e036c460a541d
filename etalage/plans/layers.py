"""The whole build: landing -> bronze -> silver -> gold -> product snapshot.

Every model is written in full, to a new version of its table, and read back by
the models that use it. Reading a written layer cuts the lineage: a lost
executor recomputes from the last written layer, not from the raw feeds, and
the six gold models do not each recompute the silver series. A step only reads
what the step before has published.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.operators.series import fill_series
from etalage.operators.snapshot import SnapshotTable
from etalage.plans import dims, facts
from etalage.plans import feeds as K
from etalage.plans.feeds import stack_feeds
from etalage.sources.io import read_model, write_layer

SERIES_KEYS = ["image_url", "name"]
SERIES_COLS = ["price", "stock", "quantity", "unit", "price_per_quantity", "category", "section", "marque", "store"]
FEEDS = ("auchan", "biocoop", "carrefour", "labellevie")


def silver_from_bronze(bronze: DataFrame, feed_col: str = "feed", max_days: int | None = None) -> DataFrame:
    """Dense daily series per feed, picture and name.

    ``id`` numbers the rows of all feeds together (feed, picture, name, day), so it
    is a key of the one silver table; a feed's own order is kept within it.
    """
    keys = [feed_col, *SERIES_KEYS] if feed_col in bronze.columns else list(SERIES_KEYS)
    cols = [c for c in SERIES_COLS if c in bronze.columns]
    return fill_series(
        bronze, keys, cols, "date", max_days=max_days, hash_of=SERIES_KEYS, id_col="id",
    )


def bronze_feeds(raw: dict[str, DataFrame], tie_break: Sequence[str], calendar: K.Calendar = None,
                 keep: bool = False) -> dict[str, K.Feed]:
    """The four feed models over raw tables: the feeds, and ``cat``, ``section``, ``norm``. ``keep``: a feed's
    numbered rows are written once for its clean rows and its rejects."""
    cat, sec, norm = raw["cat"], raw["section"], raw["norm"]
    return {
        "auchan": K.bronze_feed_norm_left(raw["auchan"], cat, sec, norm, tie_break, calendar=calendar, keep=keep),
        "biocoop": K.bronze_feed_phrase_stock(raw["biocoop"], cat, sec, tie_break, calendar=calendar, keep=keep),
        "carrefour": K.bronze_feed_unit_price(raw["carrefour"], cat, sec, tie_break, calendar=calendar, keep=keep),
        "labellevie": K.bronze_feed_discount(raw["labellevie"], cat, sec, norm, tie_break, calendar=calendar, keep=keep),
    }


class Lakehouse:
    """The tables below ``root``; each ``build_*`` writes a layer from the one before."""

    def __init__(self, spark: SparkSession, root: str, fmt: str | None = None):
        self.spark, self.root, self.fmt = spark, root, fmt

    def read(self, layer: str, name: str) -> DataFrame:
        return read_model(self.spark, self.root, layer, name, self.fmt)

    def _save(self, layer: str, name: str, df: DataFrame, partition_by: Sequence[str] | None = None) -> DataFrame:
        write_layer(df, self.root, layer, name, self.fmt, partition_by)
        return self.read(layer, name)

    def land(self, raw: dict[str, DataFrame]) -> None:
        """Raw feeds and lookups, as they come."""
        for name, df in raw.items():
            self._save("landing", name, df)

    def build_bronze(self, tie_break: Sequence[str], calendar: K.Calendar = None) -> None:
        """The four feeds and their rejected texts (``<feed>_rejects``); days beyond the calendar are rejected too."""
        raw = {n: self.read("landing", n) for n in (*FEEDS, "cat", "section", "norm")}
        for name, feed in bronze_feeds(raw, tie_break, calendar, keep=True).items():
            self._save("bronze", name, feed.clean)
            self._save("bronze", f"{name}_rejects", feed.rejects)

    def build_silver(self, feeds: Sequence[str] = FEEDS, max_days: int | None = None) -> DataFrame:
        """All feeds' series in one table, a folder per feed."""
        stacked = stack_feeds({n: self.read("bronze", n) for n in feeds})
        return self._save("silver", "silver", silver_from_bronze(stacked, max_days=max_days), ["feed"])

    def build_gold(self) -> dict[str, DataFrame]:
        """The dimensions, then the product dimension, then the fact (a folder per year)."""
        silver = self.read("silver", "silver")
        out = {
            "dim_category": self._save("gold", "dim_category", dims.dim_category(silver)),
            "dim_picture": self._save("gold", "dim_picture", dims.dim_picture(silver)),
            "dim_store": self._save("gold", "dim_store", dims.dim_store(silver, self.read("landing", "store_img"))),
            "dim_date": self._save("gold", "dim_date", dims.dim_date(silver)),
        }
        out["dim_product"] = self._save("gold", "dim_product", dims.dim_product(
            silver, out["dim_category"], out["dim_picture"], out["dim_store"]))
        fact = facts.fact_sales(silver, out["dim_product"], out["dim_date"])
        years = F.broadcast(out["dim_date"].select("date_id", "year"))  # bounded by the calendar
        out["fact_sales"] = self._save("gold", "fact_sales", fact.join(years, "date_id", "left"), ["year"])
        return out

    def snapshot_products(self, as_of: str) -> DataFrame:
        """Version the product dimension; returns all versions."""
        table = SnapshotTable(self.spark, self.root, "product", "product_id", self.fmt)
        table.apply(self.read("gold", "dim_product"), as_of)
        return table.read()

    def build_all(self, raw: dict[str, DataFrame], tie_break: Sequence[str], as_of: str) -> dict[str, DataFrame]:
        """Everything, from raw feeds and lookups (``store_img`` among them); the gold tables."""
        self.land(raw)
        self.build_bronze(tie_break)
        self.build_silver()
        gold = self.build_gold()
        gold["product_snapshot"] = self.snapshot_products(as_of)
        return gold
