"""Bindings of the generated test tables to the retail data model.

The reference reads scraped retailer feeds that are not shipped with it; the
checks run on the driver-generated TPC-H-like tables instead. The bindings
below map those tables onto the feed schema. Each has a twin in
``etalage.oracle`` written in plain SQL, so both engines see the same rows.

* ``obs``  - one observation per ``lineitem`` row: picture = supplier +
  return flag, name = line status (two names per picture), price / stock with
  NULLs injected by order key, attributes from ``part``.
* ``evt``  - one observation per ``events`` row, key ``(user_id, event_type)``.
* ``raw_*`` - the same observations rendered as the four retailers' text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from etalage.operators.dedup import dedup_first
from etalage.operators.series import fill_series, fill_spans, unfold
from etalage.sources.io import read_source, stored

# Fixed values of the bindings (shared with the SQL oracle).
PRICE_NULL_MOD = 7   # price is NULL when l_orderkey % 7 = 0
STOCK_NULL_MOD = 11  # stock is NULL when l_orderkey % 11 = 0
STORES = 4           # store = 'store' || l_suppkey % 4
EVT_NULL_MOD = 5     # value is NULL when event_id % 5 = 0
DATE_NULL_MOD = 61   # the day is NULL when l_orderkey % 61 = 0
IMAGE_NULL_MOD = 7   # a store picture is NULL when n_nationkey % 7 = 0
FEEDS = ["auchan", "biocoop", "carrefour", "labellevie"]  # by l_suppkey % 4, as the store
BRAND_FEED = "auchan"  # the one feed that knows the brand

SILVER_COLS = [
    "price", "stock", "quantity", "unit", "price_per_quantity",
    "category", "section", "marque", "store",
]


def obs(spark: SparkSession, root: str) -> DataFrame:
    """Observation rows with the tie-break columns ``l_orderkey, l_linenumber``."""
    li = read_source(
        spark, root, "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
         "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    part = read_source(spark, root, "part", ["p_partkey", "p_brand", "p_type", "p_size"])
    j = li.join(part, li.l_partkey == part.p_partkey, "left")
    price = F.when(F.col("l_orderkey") % PRICE_NULL_MOD != 0, F.col("l_extendedprice"))
    quantity = F.col("p_size").cast("double")
    return j.select(
        F.concat(F.lit("img/"), F.col("l_suppkey"), F.lit("-"), F.col("l_returnflag")).alias("image_url"),
        F.concat(F.lit("item "), F.col("l_linestatus")).alias("name"),
        F.when(F.col("l_orderkey") % DATE_NULL_MOD != 0, F.to_date("l_shipdate")).alias("date"),
        price.alias("price"),
        F.when(F.col("l_orderkey") % STOCK_NULL_MOD != 0, F.col("l_quantity")).alias("stock"),
        quantity.alias("quantity"),
        F.when(F.col("p_size") % 2 == 0, F.lit("g")).otherwise(F.lit("L")).alias("unit"),
        F.try_divide(price, quantity).alias("price_per_quantity"),
        F.col("p_brand").alias("category"),
        F.col("p_type").alias("section"),
        F.col("p_brand").alias("marque"),
        F.concat(F.lit("store"), F.col("l_suppkey") % STORES).alias("store"),
        "l_orderkey",
        "l_linenumber",
    )


def obs_tiebreak() -> list[Column]:
    # (l_orderkey, l_linenumber) is not unique in the generated table
    return [F.col(c).asc_nulls_first() for c in ("l_orderkey", "l_linenumber", "name", "price", "stock", "section")]


def obs_daily(spark: SparkSession, root: str) -> DataFrame:
    """Bronze rule on OBS: one row per picture and day, first by tie-break."""
    return dedup_first(obs(spark, root), ["image_url", "date"], obs_tiebreak())


def obs_silver(spark: SparkSession, root: str, with_id: bool = False) -> DataFrame:
    """Silver OBS: dense daily series per (picture, name), forward filled."""
    return fill_series(
        obs_daily(spark, root).drop("l_orderkey", "l_linenumber"),
        keys=["image_url", "name"],
        cols=SILVER_COLS,
        date="date",
        id_col="id" if with_id else None,
    )


def obs_spans(spark: SparkSession, root: str) -> DataFrame:
    """Silver OBS before its days are unfolded."""
    return fill_spans(obs_daily(spark, root).drop("l_orderkey", "l_linenumber"), ["image_url", "name"], SILVER_COLS, "date")


def feeds_daily(spark: SparkSession, root: str) -> DataFrame:
    """OBS split by store into four feeds; only one of them has a brand."""
    feed = F.element_at(F.array(*[F.lit(f) for f in FEEDS]), (F.substring("store", 6, 1).cast("int") + 1))
    daily = obs_daily(spark, root).drop("l_orderkey", "l_linenumber").withColumn("feed", feed)
    return daily.withColumn("marque", F.when(F.col("feed") == BRAND_FEED, F.col("marque")))


def feeds_silver(spark: SparkSession, root: str) -> DataFrame:
    """Silver of the four feeds stacked, per (feed, picture, name)."""
    return unfold(feeds_spans(spark, root))


def feeds_spans(spark: SparkSession, root: str) -> DataFrame:
    """Silver of the four feeds before its days are unfolded."""
    return fill_spans(feeds_daily(spark, root), ["feed", "image_url", "name"], SILVER_COLS, "date",
                      hash_of=["image_url", "name"])


def evt(spark: SparkSession, root: str) -> DataFrame:
    ev = read_source(spark, root, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    return ev.select(
        "user_id",
        "event_type",
        F.to_date("ts").alias("date"),
        F.when(F.col("event_id") % EVT_NULL_MOD != 0, F.col("value")).alias("value"),
        "ts",
        "event_id",
    )


def evt_daily(spark: SparkSession, root: str) -> DataFrame:
    """One event per (user, type, day): the earliest, ties by event id."""
    return dedup_first(
        evt(spark, root), ["user_id", "event_type", "date"], [F.col("ts"), F.col("event_id")]
    )


def store_img(spark: SparkSession, root: str) -> DataFrame:
    """Store pictures: several per store, from ``nation``."""
    n = read_source(spark, root, "nation", ["n_nationkey", "n_name"])
    return n.select(
        F.concat(F.lit("store"), F.col("n_nationkey") % STORES).alias("store"),
        F.when(F.col("n_nationkey") % IMAGE_NULL_MOD != 0, F.col("n_name")).alias("image_str"),
    )


# -- RAW: the observations rendered as scraped retailer text ----------------
# Fixed values of the rendering (shared with the SQL oracle).
URL_NULL_MOD, URL_EMPTY_MOD, URL_NAN_MOD = 17, 19, 23
FROM_PRICE_MOD = 13      # 'À partir de ...' prices
BAD_STOCK_MOD = 29       # unparseable stock text
FIX_2150_MOD, FIX_1975_MOD = 31, 37
JUNK_FLACON_MOD, JUNK_KILO_MOD = 41, 43
COMMA_UNIT_PRICE_MOD = 5              # unit price with a decimal comma
BAD_DATE_MOD, NULL_DATE_MOD = 47, 53  # date text that is no date; no date
SCRAPE_START = "2020-01-01"           # the first day of every feed
NORM_ZERO_MOD = 9        # norm quantity '0' = unknown
CARREFOUR_UNITS = ["KG", "kg", "Kg", "ml", "L", "U"]  # by p_size % 6
BIOCOOP_UNITS = ["kg", "L", "unite"]                  # by p_size % 3

RAW_TIEBREAK = ["l_suppkey", "l_returnflag", "l_orderkey", "l_linenumber"]


def _fmt2(col) -> Column:
    return F.format_string("%.2f", col)


def raw_lines(spark: SparkSession, root: str) -> DataFrame:
    """lineitem + part with the shared text columns of all four feeds.

    A picture has two names (those of two parts, by line status). Its observations, in order
    of their ship date, are made on consecutive days, as a daily scrape would: each has a day
    of its own, whatever the table's size, so the daily rule drops none of a valid picture.
    """
    li = read_source(
        spark, root, "lineitem",
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
         "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"],
    )
    part = read_source(spark, root, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_retailprice"])
    names = read_source(spark, root, "part", ["p_partkey", "p_name"]).withColumnRenamed("p_partkey", "n_partkey")
    names = names.withColumn("n_suppkey", F.expr("(n_partkey + pmod(n_partkey, 2)) div 2"))
    seen = Window.partitionBy("l_suppkey", "l_returnflag").orderBy("l_shipdate", "l_orderkey", "l_linenumber")
    day = F.date_add(F.lit(SCRAPE_START).cast("date"), F.row_number().over(seen) - 1).cast("timestamp_ntz")
    # the lines of a supplier are together for the days and for the names; which of its two, is no key to shuffle by
    other = 2 * F.col("l_suppkey") - F.when(F.col("l_linestatus") == "O", 1).otherwise(0) - F.col("n_partkey")
    j = li.repartition("l_suppkey").withColumn("_day", day).join(
        names, (F.col("l_suppkey") == F.col("n_suppkey")) & (other == 0), "left").join(
        part, li.l_partkey == part.p_partkey, "left")
    k = F.col("l_orderkey")
    url = (
        F.when(k % URL_NULL_MOD == 0, F.lit(None).cast("string"))
        .when(k % URL_EMPTY_MOD == 0, F.lit(""))
        .when(k % URL_NAN_MOD == 0, F.when(F.col("l_linenumber") % 2 == 0, F.lit("nan")).otherwise(F.lit("NaN")))
        .otherwise(F.concat(F.lit("img/"), F.col("l_suppkey"), F.lit("-"), F.col("l_returnflag")))
    )
    return j.select(
        F.col("_day").alias("date"),
        F.col("p_name").alias("name"),
        url.alias("image_url"),
        F.concat(F.lit("store"), F.col("l_suppkey") % STORES).alias("store"),
        F.col("p_brand").alias("marque"),
        "l_quantity", "l_extendedprice", "p_size", "p_retailprice", *RAW_TIEBREAK,
    )


def stored_lines(spark: SparkSession, root: str) -> DataFrame:
    """The lines, written once: a feed's numbering reads its rows more than once."""
    return stored(raw_lines(spark, root), "lines")


def raw_auchan(spark: SparkSession, root: str, lines: DataFrame | None = None) -> DataFrame:
    r = lines or raw_lines(spark, root)
    k = F.col("l_orderkey")
    comma_price = F.replace(_fmt2("l_extendedprice"), F.lit("."), F.lit(","))
    return r.select(
        "date", "name",
        F.when(k % BAD_STOCK_MOD == 0, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("quantity_stock"),
        F.when(k % FROM_PRICE_MOD == 0, F.concat(F.lit("À partir de "), comma_price, F.lit("€")))
        .otherwise(F.concat(comma_price, F.lit(" €"))).alias("price"),
        F.concat(_fmt2("p_retailprice"), F.lit(" € / kg")).alias("price_per_quantity"),
        F.concat(F.col("p_size").cast("string"), F.lit(" x 125g")).alias("quantity"),
        "marque", "store", "image_url", *RAW_TIEBREAK,
    )


def raw_biocoop(spark: SparkSession, root: str, lines: DataFrame | None = None) -> DataFrame:
    r = lines or raw_lines(spark, root)
    k, ln = F.col("l_orderkey"), F.col("l_linenumber")
    stock = (
        F.when(ln == 1, F.lit("En Stock")).when(ln == 2, F.lit("disponible"))
        .when(ln == 3, F.lit("rupture")).when(ln == 4, F.lit(""))
        .when(ln == 5, F.lit(None).cast("string"))
        .when(ln == 6, F.format_string("%.1f", "l_quantity"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    )
    price = (
        F.when(k % FIX_2150_MOD == 0, F.lit("2150")).when(k % FIX_1975_MOD == 0, F.lit("1975"))
        .otherwise(_fmt2("l_extendedprice"))
    )
    unit = F.element_at(F.array(*[F.lit(u) for u in BIOCOOP_UNITS]), (F.col("p_size") % 3 + 1).cast("int"))
    ppq = F.concat(F.replace(_fmt2("p_retailprice"), F.lit("."), F.lit(",")), F.lit(" € / "), unit)
    return r.select(
        "date", "name", stock.alias("stock"), price.alias("price"), ppq.alias("price_per_quantity"),
        "store", F.col("image_url").alias("img"), *RAW_TIEBREAK,
    )


def raw_carrefour(spark: SparkSession, root: str, lines: DataFrame | None = None) -> DataFrame:
    r = lines or raw_lines(spark, root)
    k = F.col("l_orderkey")
    comma = lambda c: F.replace(_fmt2(c), F.lit("."), F.lit(","))
    unit = F.element_at(F.array(*[F.lit(u) for u in CARREFOUR_UNITS]), (F.col("p_size") % 6 + 1).cast("int"))
    ppq = (
        F.when(k % JUNK_FLACON_MOD == 0, F.lit("le flacon de 250ml"))
        .when(k % JUNK_KILO_MOD == 0, F.lit("1,067.50 € / KG"))
        .otherwise(F.concat(F.when(k % COMMA_UNIT_PRICE_MOD == 0, comma("p_retailprice")).otherwise(_fmt2("p_retailprice")),
                            F.lit(" € / "), unit))
    )
    date = (
        F.when(k % BAD_DATE_MOD == 0, F.date_format("date", "dd/MM/yyyy")).when(k % NULL_DATE_MOD == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format("date", "yyyy-MM-dd"))
    )
    promo = (
        F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(comma("p_retailprice"), F.lit(" €")))
    )
    return r.select(
        date.alias("date"), "name",
        F.when(k % BAD_STOCK_MOD == 0, F.lit("n/a"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string")).alias("quantity_stock"),
        F.concat(comma("l_extendedprice"), F.lit(" €")).alias("price"),
        promo.alias("promotion"), ppq.alias("price_per_quantity"),
        "store", "image_url", *RAW_TIEBREAK,
    )


def raw_labellevie(spark: SparkSession, root: str, lines: DataFrame | None = None) -> DataFrame:
    r = lines or raw_lines(spark, root)
    k = F.col("l_orderkey")
    promo = (
        F.when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit(None).cast("string")).otherwise(F.lit("20%"))
    )
    price = F.concat(
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("+")).otherwise(F.lit("")),
        _fmt2("l_extendedprice"), F.lit("€"),
    )
    return r.select(
        "date", "name",
        F.concat(F.lit("Stock: "), F.col("l_quantity").cast("bigint").cast("string")).alias("quantity_stock"),
        promo.alias("promotion"), price.alias("price"), "image_url", "store", *RAW_TIEBREAK,
    )


def raw_category(spark: SparkSession, root: str) -> DataFrame:
    """``*_cat``: several categories per product name."""
    p = read_source(spark, root, "part", ["p_name", "p_brand"])
    return p.select(F.col("p_name").alias("product_name"), F.col("p_brand").alias("category"))


def raw_section(spark: SparkSession, root: str) -> DataFrame:
    p = read_source(spark, root, "part", ["p_name", "p_type"])
    return p.select(F.col("p_name").alias("product_name"), F.col("p_type").alias("section"))


def raw_norm(spark: SparkSession, root: str) -> DataFrame:
    """``*_norm``: pack quantity text per name ('0' = unknown) and unit."""
    p = read_source(spark, root, "part", ["p_partkey", "p_name", "p_size"])
    return p.select(
        F.col("p_name").alias("name"),
        F.when(F.col("p_partkey") % NORM_ZERO_MOD == 0, F.lit("0"))
        .otherwise(F.col("p_size").cast("string")).alias("quantity"),
        F.when(F.col("p_size") % 2 == 0, F.lit("g")).otherwise(F.lit("L")).alias("unit"),
    )


def raw_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All raw feeds and lookups. The lines that the feeds render are made once."""
    lines = stored_lines(spark, root)
    return {
        "auchan": raw_auchan(spark, root, lines), "biocoop": raw_biocoop(spark, root, lines),
        "carrefour": raw_carrefour(spark, root, lines), "labellevie": raw_labellevie(spark, root, lines), "cat": raw_category(spark, root), "section": raw_section(spark, root),
        "norm": raw_norm(spark, root), "store_img": store_img(spark, root),
    }
