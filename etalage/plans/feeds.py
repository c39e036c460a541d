"""Bronze feeds (K0a-K0d): raw retailer text -> one clean row per picture and day.

The four feeds share one shape: clean the text columns, number the rows by raw
date (``id``), attach category / section (and for two feeds the pack norm)
from lookup tables reduced to one row per name, optionally drop invalid
picture URLs, and keep the first row (by ``id``) per picture and day. They
differ only in which cleaners apply and how the lookups join, so each feed is
a short composition of ``etalage.functions.clean``.

``tie_break`` columns make the whole-table ``id`` order total; they are
dropped from the output.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.functions import clean as C
from etalage.operators.dedup import dedup_first
from etalage.operators.filters import valid_key
from etalage.operators.rank import global_rank
from etalage.sources.io import stored

BRONZE_COLS = [
    "id", "name", "price", "stock", "quantity", "unit", "price_per_quantity",
    "category", "section", "date", "store", "image_url",
]


def first_category(cat: DataFrame) -> DataFrame:
    """``*_cat`` reduced to the first category (alphabetical) per product name."""
    return dedup_first(cat.select("product_name", "category"), ["product_name"], [F.col("category")])


def first_section(sec: DataFrame) -> DataFrame:
    return dedup_first(sec.select("product_name", "section"), ["product_name"], [F.col("section")])


def first_norm(norm: DataFrame) -> DataFrame:
    """``*_norm`` reduced to one row per name: largest parsed pack quantity
    ('0' = unknown, so NULL, sorted last), ties by unit."""
    parsed = norm.select(
        "name", "unit", C.zero_to_null(C.to_number(F.col("quantity"), C.PRICE_DECIMAL)).cast("double").alias("quantity")
    )
    return dedup_first(parsed, ["name"], [F.col("quantity").desc_nulls_last(), F.col("unit").asc_nulls_first()])


class Feed(NamedTuple):
    """A bronze feed: its clean rows, and the texts that its cleaners could not read."""

    clean: DataFrame
    rejects: DataFrame


#: first and last day that a feed may have, or None
Calendar = tuple[str, str] | None

#: feed, id of the raw row, its picture, the column, its text
REJECT_COLS = ["feed", "id", "image_url", "column", "text"]


def _parsed(
    raw: DataFrame, feed: str, tie_break: Sequence[str], image: str, columns: dict[str, Column],
    casts: dict[str, tuple[Column, Column]], calendar: Calendar = None, keep: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Clean, then number the raw rows by date: ``id`` = rank over (date, tie_break).

    ``casts`` names, per raw column, the text that is cast and the value; a text
    that is there and not blank but gives NULL is rejected. Only the order key,
    the cleaned columns and the (mostly empty) list of rejects are numbered. A row whose date
    cannot be read, or is not in the ``calendar`` (one misread year would make a series
    of millions of days), is on no day: it is among the rejects only. ``keep`` writes the numbered
    rows, for a caller that reads both results.
    """
    day = F.col("date").try_cast("date")
    if calendar:
        day = F.when(day.between(*[F.lit(d).cast("date") for d in calendar]), day)
    casts = {**casts, "date": (F.col("date").cast("string"), day)}
    odd = {c: F.coalesce((F.trim(text) != "") & value.isNull(), F.lit(False)) for c, (text, value) in casts.items()}
    listed = F.filter(
        F.array(*[F.when(o, F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"))) for c, o in odd.items()]),
        lambda x: x.isNotNull())
    bad = F.when(reduce(or_, odd.values()), listed)  # the filter is interpreted, so only rows with a reject come to it
    rows = raw.select(
        F.col("date").alias("_raw_date"), *[F.col(c).alias(f"_tie_{c}") for c in tie_break],
        day.alias("date"), F.col(image).alias("image_url"), *[v.alias(k) for k, v in columns.items()], bad.alias("_bad"))
    numbered = global_rank(rows, ["_raw_date", *[f"_tie_{c}" for c in tie_break]], out="id")
    numbered = stored(numbered, f"{feed}_numbered") if keep else numbered
    clean = numbered.filter(F.col("_raw_date").isNull() | F.col("date").isNotNull()).select("id", "date", "image_url", *columns)
    rejects = numbered.select(F.lit(feed).alias("feed"), "id", "image_url", F.explode("_bad").alias("_bad")).select(
        "feed", "id", "image_url", "_bad.column", "_bad.text")
    return clean, rejects


def _enrich(df: DataFrame, cat: DataFrame, sec: DataFrame, how: str) -> DataFrame:
    c = first_category(cat).withColumnRenamed("product_name", "name")
    s = first_section(sec).withColumnRenamed("product_name", "name")
    return df.join(c, on="name", how=how).join(s, on="name", how=how)


def _daily(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per (picture, day): the lowest ``id``."""
    return dedup_first(df, ["image_url", "date"], [F.col("id")]).select(*cols)


def bronze_feed_norm_left(
    raw: DataFrame, cat: DataFrame, sec: DataFrame, norm: DataFrame, tie_break: Sequence[str], feed: str = "auchan",
    calendar: Calendar = None, keep: bool = False,
) -> Feed:
    """Price text with 'from' prices, numeric stock, pack size from the
    norm table, LEFT lookups (unmatched rows kept), invalid URLs dropped."""
    stock, price = C.parse_stock_number("quantity_stock"), C.parse_price("price")
    r, rejects = _parsed(
        raw, feed, tie_break, "image_url",
        {"name": F.col("name"), "stock": stock, "price": price, "marque": F.col("marque"), "store": F.col("store")},
        {"quantity_stock": (F.col("quantity_stock"), stock), "price": (C.price_text("price"), price)}, calendar, keep)
    j = _enrich(r, cat, sec, "left").join(first_norm(norm), on="name", how="left").filter(valid_key("image_url"))
    j = j.withColumn("price_per_quantity", C.price_per_quantity("price", "quantity"))
    return Feed(_daily(j, [*BRONZE_COLS[:-2], "marque", "store", "image_url"]), rejects)


def bronze_feed_phrase_stock(
    raw: DataFrame, cat: DataFrame, sec: DataFrame, tie_break: Sequence[str], feed: str = "biocoop",
    calendar: Calendar = None, keep: bool = False,
) -> Feed:
    """Stock phrases, patched prices, pack size derived from the unit
    price text, kilo -> gram scaling, INNER lookups, no URL filter."""
    unit_text = C.keep_digits(F.replace(F.col("price_per_quantity"), F.lit(","), F.lit(".")))
    unit_price, price = C.to_number(unit_text), C.parse_price_fixups("price")
    r, rejects = _parsed(
        raw, feed, tie_break, "img",
        {"name": F.col("name"), "stock": C.parse_stock("stock"), "price": price,
         "raw_unit": C.keep_letters("price_per_quantity", drop=(C.EURO, " ")),
         "raw_quantity": C.pack_size(price, unit_price, digits=3), "store": F.col("store")},
        {"price": (C.replace_all("price", C.PRICE_FIXUPS), price), "price_per_quantity": (unit_text, unit_price)}, calendar, keep)
    kilo = F.col("raw_unit") == "kg"
    size = F.when(kilo, F.col("raw_quantity") * 1000).otherwise(F.col("raw_quantity"))
    j = _enrich(r, cat, sec, "inner").select(
        "*", size.alias("quantity"), F.replace(F.col("raw_unit"), F.lit("kg"), F.lit("g")).alias("unit"),
        F.try_divide(F.col("price"), size).alias("price_per_quantity"))
    return Feed(_daily(j, BRONZE_COLS), rejects)


def bronze_feed_unit_price(
    raw: DataFrame, cat: DataFrame, sec: DataFrame, tie_break: Sequence[str],
    consistent_units: bool = False, feed: str = "carrefour", calendar: Calendar = None, keep: bool = False,
) -> Feed:
    """Promotional price ratio, unit and unit price captured from text,
    pack size = price / unit price, unit scaling and renames, INNER lookups."""
    stock, price = C.parse_stock_number("quantity_stock"), C.parse_price("price", from_prefix=False)
    unit_price, promo = C.leading_number("price_per_quantity"), C.price_text("promotion", False)
    r, rejects = _parsed(
        raw, feed, tie_break, "image_url",
        {"name": F.col("name"), "stock": stock, "price": price,
         "raw_unit": C.unit_after_slash("price_per_quantity"), "price_per_unit": unit_price,
         "raw_quantity": C.pack_size(price, unit_price), "store": F.col("store")},
        {"quantity_stock": (F.col("quantity_stock"), stock), "price": (C.price_text("price", False), price),
         "promotion": (promo, C.to_number(promo, C.PRICE_DECIMAL)),
         "price_per_quantity": (C.unit_price_text("price_per_quantity"), unit_price)}, calendar, keep)
    j = _enrich(r, cat, sec, "inner").select(
        "*",
        C.scale_quantity("raw_quantity", "raw_unit").alias("quantity"),
        C.rename_unit("raw_unit").alias("unit"),
        C.scale_unit_price("price_per_unit", "raw_unit", "raw_quantity", consistent_units).alias(
            "price_per_quantity"
        ),
    )
    return Feed(_daily(j, BRONZE_COLS), rejects)


def bronze_feed_discount(
    raw: DataFrame, cat: DataFrame, sec: DataFrame, norm: DataFrame, tie_break: Sequence[str], feed: str = "labellevie",
    calendar: Calendar = None, keep: bool = False,
) -> Feed:
    """K0d: day-truncated timestamps, digits-only stock, percent discounts,
    pack size from the norm table, INNER lookups, invalid URLs dropped."""
    stock_text = C.keep_digits("quantity_stock")
    stock = C.to_number(stock_text, C.PRICE_DECIMAL).cast("double")
    base = C.discount_base_text("price")
    r, rejects = _parsed(
        raw, feed, tie_break, "image_url",
        {"name": F.col("name"), "stock": stock, "price": C.discounted_price("price", "promotion"), "store": F.col("store")},
        {"quantity_stock": (stock_text, stock), "promotion": (C.discount_text("promotion"), C.discount_fraction("promotion")),
         "price": (base, C.to_number(base, C.PRICE_DECIMAL))}, calendar, keep)
    j = _enrich(r, cat, sec, "inner").join(first_norm(norm), on="name", how="inner").filter(valid_key("image_url"))
    j = j.withColumn("price_per_quantity", C.price_per_quantity("price", "quantity"))
    return Feed(_daily(j, BRONZE_COLS), rejects)


def stack_feeds(feeds: dict[str, DataFrame], feed_col: str = "feed") -> DataFrame:
    """All feeds as one frame tagged by ``feed``; missing columns become NULL.

    Downstream models partition by ``feed`` plus their own keys, which is the
    same as running them per feed and taking UNION ALL, with one plan and one
    shuffle per step instead of four.
    """
    out = None
    for name, df in feeds.items():
        tagged = df.withColumn(feed_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("no feeds")
    return out
