"""SQL twins of ``etalage.queries`` for DuckDB (the independent oracle).

They are written from the behaviour each operator promises, with DuckDB's own
means: ``generate_series`` for the days of a series, ``last_value ... IGNORE
NULLS`` for the fill, filtered window aggregates for the mean depletion,
``QUALIFY`` for "first per key", a plain ``row_number`` for ids. Ordering ties are
broken the same way as on the Spark side, and every NULL order is spelled out
because DuckDB sorts NULLs last by default and Spark first.
"""

from __future__ import annotations

# -- bindings (same fixed values as etalage.sources.bindings) ----------------

OBS = """
obs AS (
  SELECT 'img/' || l.l_suppkey || '-' || l.l_returnflag AS image_url,
         'item ' || l.l_linestatus AS name,
         CASE WHEN l.l_orderkey % 61 <> 0 THEN CAST(l.l_shipdate AS DATE) END AS date,
         CASE WHEN l.l_orderkey % 7 <> 0 THEN l.l_extendedprice END AS price,
         CASE WHEN l.l_orderkey % 11 <> 0 THEN l.l_quantity END AS stock,
         CAST(p.p_size AS DOUBLE) AS quantity,
         CASE WHEN p.p_size % 2 = 0 THEN 'g' ELSE 'L' END AS unit,
         (CASE WHEN l.l_orderkey % 7 <> 0 THEN l.l_extendedprice END)
           / NULLIF(CAST(p.p_size AS DOUBLE), 0) AS price_per_quantity,
         p.p_brand AS category,
         p.p_type AS section,
         p.p_brand AS marque,
         'store' || (l.l_suppkey % 4) AS store,
         l.l_orderkey, l.l_linenumber
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

OBS_DAILY = OBS + """,
obs_daily AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY image_url, date
                                 ORDER BY l_orderkey, l_linenumber, name, price NULLS FIRST,
                                          stock NULLS FIRST, section NULLS FIRST) AS rn
    FROM obs) WHERE rn = 1
)"""

_FILL_COLS = ["price", "stock", "quantity", "unit", "price_per_quantity",
              "category", "section", "marque", "store"]


def _days(src: str, keys: list[str], name: str) -> str:
    """Every day of every series, from its first observation to its last."""
    k = ", ".join(keys)
    known = " AND ".join(f"{c} IS NOT NULL" for c in [*keys, "date"])
    return f"""
{name} AS (
  SELECT {k}, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
  FROM {src} WHERE {known} GROUP BY {k}
)"""


def _fill_sql(src: str, keys: list[str], cols: list[str], name: str, hash_of: list[str] | None) -> str:
    """The days of each series, each column with its last known value."""
    k = ", ".join(keys)
    product = f"CAST('0x' || left(md5(concat({', '.join(hash_of)})), 15) AS BIGINT) AS product_id, " if hash_of else ""
    known = ", ".join(f"last_value({c} IGNORE NULLS) OVER upto AS {c}" for c in cols)
    return f""",{_days(src, keys, name + "_days")},
{name} AS (
  SELECT {product}{k}, date, {known}
  FROM {name}_days LEFT JOIN {src} USING ({k}, date)
  WINDOW upto AS (PARTITION BY {k} ORDER BY date ROWS UNBOUNDED PRECEDING)
)"""


SILVER = OBS_DAILY + _fill_sql("obs_daily", ["image_url", "name"], _FILL_COLS, "silver", ["image_url", "name"])

_FEEDS = ["auchan", "biocoop", "carrefour", "labellevie"]
_FEED_KEYS = ["feed", "image_url", "name"]
FEEDS_SILVER = OBS_DAILY + """,
feeds_daily AS (
  SELECT * REPLACE (CASE WHEN store = 'store0' THEN marque END AS marque),
         ['auchan', 'biocoop', 'carrefour', 'labellevie'][1 + CAST(right(store, 1) AS INTEGER)] AS feed
  FROM obs_daily
)""" + _fill_sql("feeds_daily", _FEED_KEYS, _FILL_COLS, "fsilver", ["image_url", "name"])

EVT_DAILY = """
evt AS (
  SELECT user_id, event_type, CAST(ts AS DATE) AS date,
         CASE WHEN event_id % 5 <> 0 THEN value END AS value, ts, event_id
  FROM events
),
evt_daily AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type, date ORDER BY ts, event_id) AS rn
    FROM evt) WHERE rn = 1
)"""

STORE_IMG = """
store_img AS (
  SELECT 'store' || (n_nationkey % 4) AS store, CASE WHEN n_nationkey % 7 <> 0 THEN n_name END AS image_str FROM nation
)"""


def _sales(src: str, series: str, ties: str, name: str = "sold") -> str:
    """Stock steps along a series, its mean depletion, and the units sold: a rise is a
    restock and counts as the mean depletion, no step sells nothing."""
    return f""",
{name}_steps AS (
  SELECT *, stock - lag(stock) OVER (PARTITION BY {series} ORDER BY date, {ties}) AS raw_stock_diff FROM {src}
),
{name} AS (
  SELECT *, CAST(if(raw_stock_diff > 0, mean_negative_stock_diff, coalesce(abs(raw_stock_diff), 0)) AS DOUBLE) AS sales
  FROM (SELECT *, avg(abs(raw_stock_diff)) FILTER (raw_stock_diff <= 0) OVER (PARTITION BY {series}) AS mean_negative_stock_diff
        FROM {name}_steps)
)"""


def _any_feed(cols: str) -> str:
    """UNION of the four feeds' rows."""
    return " UNION ".join(f"SELECT {cols} FROM fsilver WHERE feed = '{f}'" for f in _FEEDS)


def _id(order: str, name: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS {name}"


_DIM_CTES = "," + STORE_IMG + f""",
dim_category AS (
  SELECT {_id("section, category", "id_category")}, section, category FROM ({_any_feed("section, category")})
  WHERE trim(category) <> '' AND trim(section) <> ''
),
dim_date AS (
  SELECT {_id("date", "date_id")}, CAST(day(date) AS BIGINT) AS day, CAST(month(date) AS BIGINT) AS month,
         CAST(year(date) AS BIGINT) AS year, date
  FROM ({_any_feed("date")})
),
dim_picture AS (
  SELECT {_id("picture", "id_picture")}, picture FROM ({_any_feed("image_url AS picture")}) WHERE trim(picture) <> ''
),
dim_store AS (
  SELECT {_id("store", "id_store")}, store, (SELECT min(image_str) FROM store_img i WHERE i.store = s.store) AS image_str
  FROM ({_any_feed("store")}) s WHERE trim(store) <> ''
),
dim_product AS (
  SELECT product_id, name, marque, id_category, id_picture, id_store
  FROM ({" UNION ALL ".join(f"SELECT DISTINCT product_id, name, marque, category, image_url, store FROM fsilver WHERE feed = '{f}'" for f in _FEEDS)}) p
  LEFT JOIN (SELECT category, min(id_category) AS id_category FROM dim_category GROUP BY category) USING (category)
  LEFT JOIN dim_picture ON picture = image_url
  LEFT JOIN (SELECT store, id_store FROM dim_store) USING (store)
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY id_category NULLS FIRST, id_store NULLS FIRST,
    id_picture NULLS FIRST, name NULLS FIRST, marque NULLS LAST) = 1
)"""
DIMS = FEEDS_SILVER + _DIM_CTES

_BEST = ("stock DESC NULLS LAST, price DESC NULLS LAST, quantity DESC NULLS LAST, unit NULLS LAST, "
         "sales DESC NULLS LAST, price_per_quantity DESC NULLS LAST")
_FACT_CTES = _sales("fsilver", "feed, image_url", "name", "fsold") + f""",
fact_sales AS (
  WITH best AS (SELECT * FROM fsold QUALIFY row_number() OVER (PARTITION BY product_id, date ORDER BY {_BEST}) = 1),
  keyed AS (
    SELECT b.* REPLACE (if(b.sales BETWEEN 9850 AND 10000, 1.0, b.sales) AS sales, p.product_id AS product_id), d.date_id
    FROM best b LEFT JOIN dim_product p USING (product_id) LEFT JOIN dim_date d ON d.date = b.date)
  SELECT {_id("product_id NULLS FIRST, date_id NULLS FIRST", "id")},
         stock, sales, price, quantity, price_per_quantity, unit, product_id, date_id
  FROM (SELECT * FROM keyed QUALIFY row_number() OVER (PARTITION BY product_id, date_id ORDER BY {_BEST}) = 1)
)"""
FACT = DIMS + _FACT_CTES

ORACLE: dict[str, str] = {}

ORACLE["source_scan"] = "SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem"

ORACLE["agg_series_extent"] = f"""WITH {OBS_DAILY}
SELECT image_url, name, min(date) AS min_date, max(date) AS max_date,
       CAST(date_diff('day', min(date), max(date)) AS BIGINT) AS date_diff
FROM obs_daily WHERE image_url IS NOT NULL AND name IS NOT NULL GROUP BY image_url, name"""

_SPINE = OBS_DAILY + "," + _days("obs_daily", ["image_url", "name"], "spine")

ORACLE["date_spine"] = f"WITH {_SPINE} SELECT * FROM spine"
ORACLE["join_range_spine"] = f"""WITH {_SPINE}
SELECT *, CAST(date - min(date) OVER (PARTITION BY image_url, name) AS BIGINT) AS n FROM spine"""

_SPINE_JOIN = _SPINE + """,
joined AS (
  SELECT image_url, name, date, price, stock FROM spine LEFT JOIN obs_daily USING (image_url, name, date)
)"""

ORACLE["join_spine_left"] = f"WITH {_SPINE_JOIN} SELECT * FROM joined"

_UPTO = "WINDOW upto AS (PARTITION BY image_url, name ORDER BY date ROWS UNBOUNDED PRECEDING)"

ORACLE["window_running_count"] = f"""WITH {_SPINE_JOIN}
SELECT *, count(price) OVER upto AS price_group, count(stock) OVER upto AS stock_group FROM joined {_UPTO}"""

ORACLE["window_forward_fill"] = f"""WITH {_SPINE_JOIN}
SELECT image_url, name, date, last_value(price IGNORE NULLS) OVER upto AS price,
       last_value(stock IGNORE NULLS) OVER upto AS stock
FROM joined {_UPTO}"""

ORACLE["fill_series"] = f"""WITH {SILVER}
SELECT CAST(row_number() OVER (ORDER BY image_url, name, date) AS BIGINT) AS id, * FROM silver"""

ORACLE["fill_series_events"] = "WITH " + EVT_DAILY + _fill_sql(
    "evt_daily", ["user_id", "event_type"], ["value"], "evt_silver", None
) + "\nSELECT * FROM evt_silver"

_SOLD = SILVER + _sales("silver", "image_url", "name")

ORACLE["window_lag_diff"] = f"""WITH {SILVER}
SELECT image_url, name, date, stock, lag(stock) OVER s AS prev, stock - lag(stock) OVER s AS diff
FROM silver WINDOW s AS (PARTITION BY image_url ORDER BY date, name)"""
ORACLE["agg_mean_depletion"] = f"""WITH {_SOLD}
SELECT image_url, avg(-raw_stock_diff) AS mean_negative_stock_diff FROM sold WHERE raw_stock_diff <= 0 GROUP BY ALL"""
ORACLE["join_group_mean"] = f"WITH {_SOLD} SELECT image_url, name, date, raw_stock_diff, mean_negative_stock_diff FROM sold"
ORACLE["sales_from_delta"] = f"WITH {_SOLD} SELECT image_url, name, date, sales FROM sold"
_SOLD_COLS = "product_id, date, price, stock, quantity, price_per_quantity, unit, sales"
ORACLE["estimate_sales"] = f"WITH {_SOLD} SELECT image_url, name, {_SOLD_COLS} FROM sold"
ORACLE["estimate_sales_hot_split"] = f"""WITH {SILVER}{_sales("silver", "store", "image_url, name")}
SELECT store, image_url, name, {_SOLD_COLS} FROM sold"""

ORACLE["hash_key"] = f"""WITH {OBS}
SELECT DISTINCT image_url, name, CAST(('0x' || substr(md5(image_url || name), 1, 15)) AS BIGINT) AS product_id
FROM obs"""

ORACLE["global_rank"] = f"""WITH {OBS}
SELECT CAST(row_number() OVER (ORDER BY image_url, date NULLS FIRST, l_orderkey, l_linenumber, price NULLS FIRST) AS BIGINT) AS id,
       image_url, date, l_orderkey, l_linenumber, price
FROM obs"""

ORACLE["dim_category"] = f"WITH {DIMS} SELECT * FROM dim_category"
ORACLE["dim_date"] = f"WITH {DIMS} SELECT * FROM dim_date"
ORACLE["dim_picture"] = f"WITH {DIMS} SELECT * FROM dim_picture"
ORACLE["dim_store"] = f"WITH {DIMS} SELECT * FROM dim_store"
ORACLE["dim_product"] = f"WITH {DIMS} SELECT * FROM dim_product"

ORACLE["fact_sales"] = f"WITH {FACT} SELECT * FROM fact_sales"
ORACLE["agg_distinct"] = f"WITH {OBS} SELECT category, section, store FROM obs GROUP BY ALL"


# -- RAW bindings and bronze feeds --------------------------------------------

RAW = """
raw_lines AS (
  SELECT CAST(DATE '2020-01-01' + CAST(row_number() OVER (
           PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber) - 1 AS INTEGER) AS TIMESTAMP) AS date,
    n.p_name AS name,
    CASE WHEN l.l_orderkey % 17 = 0 THEN NULL
         WHEN l.l_orderkey % 19 = 0 THEN ''
         WHEN l.l_orderkey % 23 = 0 THEN (CASE WHEN l.l_linenumber % 2 = 0 THEN 'nan' ELSE 'NaN' END)
         ELSE 'img/' || l.l_suppkey || '-' || l.l_returnflag END AS image_url,
    'store' || (l.l_suppkey % 4) AS store, p.p_brand AS marque,
    l.l_quantity, l.l_extendedprice, p.p_size, p.p_retailprice,
    l.l_suppkey, l.l_returnflag, l.l_orderkey, l.l_linenumber
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
    LEFT JOIN part n ON n.p_partkey = 2 * l.l_suppkey - CAST(l.l_linestatus = 'O' AS INTEGER)
),
raw_auchan AS (
  SELECT date, name,
    CASE WHEN l_orderkey % 29 = 0 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity_stock,
    CASE WHEN l_orderkey % 13 = 0 THEN 'À partir de ' || replace(printf('%.2f', l_extendedprice), '.', ',') || '€'
         ELSE replace(printf('%.2f', l_extendedprice), '.', ',') || ' €' END AS price,
    printf('%.2f', p_retailprice) || ' € / kg' AS price_per_quantity,
    CAST(p_size AS VARCHAR) || ' x 125g' AS quantity,
    marque, store, image_url, l_suppkey, l_returnflag, l_orderkey, l_linenumber
  FROM raw_lines
),
raw_biocoop AS (
  SELECT date, name,
    CASE WHEN l_linenumber = 1 THEN 'En Stock' WHEN l_linenumber = 2 THEN 'disponible'
         WHEN l_linenumber = 3 THEN 'rupture' WHEN l_linenumber = 4 THEN ''
         WHEN l_linenumber = 5 THEN NULL WHEN l_linenumber = 6 THEN printf('%.1f', l_quantity)
         ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS stock,
    CASE WHEN l_orderkey % 31 = 0 THEN '2150' WHEN l_orderkey % 37 = 0 THEN '1975'
         ELSE printf('%.2f', l_extendedprice) END AS price,
    replace(printf('%.2f', p_retailprice), '.', ',') || ' € / ' ||
      CASE p_size % 3 WHEN 0 THEN 'kg' WHEN 1 THEN 'L' ELSE 'unite' END AS price_per_quantity,
    store, image_url AS img, l_suppkey, l_returnflag, l_orderkey, l_linenumber
  FROM raw_lines
),
raw_carrefour AS (
  SELECT CASE WHEN l_orderkey % 47 = 0 THEN strftime(date, '%d/%m/%Y') WHEN l_orderkey % 53 <> 0 THEN strftime(date, '%Y-%m-%d') END AS date, name,
    CASE WHEN l_orderkey % 29 = 0 THEN 'n/a' ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity_stock,
    replace(printf('%.2f', l_extendedprice), '.', ',') || ' €' AS price,
    CASE WHEN l_orderkey % 3 = 0 THEN '' WHEN l_orderkey % 3 = 1 THEN NULL
         ELSE replace(printf('%.2f', p_retailprice), '.', ',') || ' €' END AS promotion,
    CASE WHEN l_orderkey % 41 = 0 THEN 'le flacon de 250ml'
         WHEN l_orderkey % 43 = 0 THEN '1,067.50 € / KG'
         ELSE CASE WHEN l_orderkey % 5 = 0 THEN replace(printf('%.2f', p_retailprice), '.', ',')
                   ELSE printf('%.2f', p_retailprice) END || ' € / ' ||
           CASE p_size % 6 WHEN 0 THEN 'KG' WHEN 1 THEN 'kg' WHEN 2 THEN 'Kg' WHEN 3 THEN 'ml'
                           WHEN 4 THEN 'L' ELSE 'U' END END AS price_per_quantity,
    store, image_url, l_suppkey, l_returnflag, l_orderkey, l_linenumber
  FROM raw_lines
),
raw_labellevie AS (
  SELECT date, name,
    'Stock: ' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity_stock,
    CASE WHEN l_orderkey % 3 = 0 THEN '' WHEN l_orderkey % 3 = 1 THEN NULL ELSE '20%' END AS promotion,
    (CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '' END) || printf('%.2f', l_extendedprice) || '€' AS price,
    image_url, store, l_suppkey, l_returnflag, l_orderkey, l_linenumber
  FROM raw_lines
),
raw_category AS (SELECT p_name AS product_name, p_brand AS category FROM part),
raw_section AS (SELECT p_name AS product_name, p_type AS section FROM part),
raw_norm AS (
  SELECT p_name AS name,
    CASE WHEN p_partkey % 9 = 0 THEN '0' ELSE CAST(p_size AS VARCHAR) END AS quantity,
    CASE WHEN p_size % 2 = 0 THEN 'g' ELSE 'L' END AS unit
  FROM part
),
cat1 AS (SELECT product_name, min(category) AS category FROM raw_category GROUP BY ALL),
sec1 AS (SELECT product_name, min(section) AS section FROM raw_section GROUP BY ALL),
norm1 AS (
  SELECT name, unnest(list({'quantity': NULLIF(CAST(quantity AS DOUBLE), 0), 'unit': unit}
                           ORDER BY NULLIF(CAST(quantity AS DOUBLE), 0) DESC NULLS LAST, unit NULLS FIRST)[1])
  FROM raw_norm GROUP BY name
)"""

ID_ORDER = "date NULLS FIRST, l_suppkey, l_returnflag, l_orderkey, l_linenumber"

# What the feeds' spellings mean, read off with patterns of their own.


def _found(text: str, pattern: str) -> str:
    """The number that a pattern picks out of a text (decimal comma or point), or NULL."""
    return f"TRY_CAST(replace(regexp_extract({text}, '{pattern}', 1), ',', '.') AS DOUBLE)"


_MONEY = _found("price", "([0-9]+[.,][0-9]+)")
_COUNT = "TRY_CAST(quantity_stock AS DOUBLE)"
# a mis-scraped price stands for another; a price that only holds its digits makes no sense with a point in them
_PATCHED = ("CASE WHEN price = '2150' THEN 2.15 WHEN price = '1975' THEN 1.975 "
            "WHEN price LIKE '%2150%' OR price LIKE '%1975%' THEN NULL ELSE TRY_CAST(price AS DOUBLE) END")
_SHELF_STOCK = "if(stock IN ('En Stock', 'disponible'), -1.0, coalesce(TRY_CAST(stock AS DOUBLE), 0.0))"
_LETTERS = "regexp_extract(price_per_quantity, '[A-Za-z]+$')"
_PER_UNIT = _found("price_per_quantity", "^([0-9]+[.,][0-9]+) ")
_PACK = f"{_MONEY} / NULLIF({_PER_UNIT}, 0)"
_PATCHED_PACK = f"round(({_PATCHED}) / NULLIF({_PER_UNIT}, 0), 3)"
_OFF = "TRY_CAST(regexp_extract(promotion, '([0-9]+)%', 1) AS DOUBLE) / 100"
_REDUCED = f"{_MONEY} * (1 - coalesce({_OFF}, if(promotion = '', 0, NULL)))"
_STOCKED = _found("quantity_stock", "([0-9]+)")
_UNIT_NAMES = "MAP {'kg': 'g', 'Kg': 'g', 'KG': 'g', 'ml': 'L', 'U': 'UNITE'}"


def _scaled(value: str, unit: str) -> str:
    """Kilos by the thousand, millilitres by the thousandth."""
    return f"CASE lower({unit}) WHEN 'kg' THEN {value} * 1000 WHEN 'ml' THEN {value} / 1000 ELSE {value} END"


VALID_URL = "l.image_url IS NOT NULL AND l.image_url != '' AND lower(l.image_url) != 'nan'"
_GOOD_URL = "lower(image_url) NOT IN ('', 'nan')"


def _bronze(feed: str, values: dict[str, str], quantity: str, unit: str, per_quantity: str, where: str, norm: bool = False, brand: bool = False) -> str:
    """A feed's model: ``values`` are read from its texts; its first row of each picture and day."""
    read = ", ".join(f"{v} AS {k}" for k, v in values.items())
    packs = " LEFT JOIN norm1 USING (name)" if norm else ""
    return f"""
bronze_{feed} AS (
  WITH texts AS (SELECT * RENAME (date AS day_text) FROM (SELECT *, row_number() OVER (ORDER BY {ID_ORDER}) AS id FROM raw_{feed})),
  readings AS (SELECT id, name, store, day_text, TRY_CAST(day_text AS DATE) AS date, {"marque, " if brand else ""}{read} FROM texts),
  known AS (
    SELECT * RENAME (product_name AS name) FROM cat1 FULL JOIN sec1 USING (product_name)
  )
  SELECT unnest(arg_min(one, one.id)) FROM (
    SELECT id, name, price, stock, {quantity} AS quantity, {unit} AS unit, {per_quantity} AS price_per_quantity, category, section, date,
      {"marque, " if brand else ""}store, image_url
    FROM readings LEFT JOIN known USING (name){packs} WHERE (day_text IS NULL OR date IS NOT NULL) AND {where}) one
  GROUP BY one.image_url, one.date
)"""


_KNOWN = "category IS NOT NULL AND section IS NOT NULL"
_BRONZES = {
    "auchan": _bronze("auchan", {"price": _MONEY, "stock": _COUNT, "image_url": "image_url"}, "quantity", "unit", "price / quantity",
                      _GOOD_URL, norm=True, brand=True),
    "biocoop": _bronze("biocoop", {"price": _PATCHED, "stock": _SHELF_STOCK, "image_url": "img", "letters": _LETTERS, "pack": _PATCHED_PACK},
                       "if(letters = 'kg', 1000, 1) * pack", "replace(letters, 'kg', 'g')", "price / NULLIF(if(letters = 'kg', 1000, 1) * pack, 0)", _KNOWN),
    "carrefour": _bronze("carrefour", {"price": _MONEY, "stock": _COUNT, "image_url": "image_url", "letters": _LETTERS, "pack": _PACK, "per_unit": _PER_UNIT},
                         _scaled("pack", "letters"), f"coalesce({_UNIT_NAMES}[letters], letters)",
                         f"if(pack IS NULL, NULL, {_scaled('per_unit', 'letters')})", _KNOWN),
    "labellevie": _bronze("labellevie", {"price": _REDUCED, "stock": _STOCKED, "image_url": "image_url"}, "quantity", "unit", "price / quantity",
                          f"{_GOOD_URL} AND {_KNOWN} AND name IN (SELECT name FROM norm1)", norm=True),
}
for _key, _feed in (("norm_left", "auchan"), ("phrase_stock", "biocoop"), ("unit_price", "carrefour"), ("discount", "labellevie")):
    ORACLE[f"bronze_feed_{_key}"] = f"WITH {RAW},{_BRONZES[_feed]} SELECT * FROM bronze_{_feed}"

_STACK_BODY = f"{RAW},{','.join(_BRONZES.values())}," + """
stacked AS (
""" + "\n  UNION ALL BY NAME ".join(f"SELECT '{f}' AS feed, * FROM bronze_{f}" for f in _FEEDS) + """
)"""

ORACLE["union_all"] = f"WITH {_STACK_BODY} SELECT feed, id, name, date, store, image_url FROM stacked"
ORACLE["union_pad_missing"] = f"WITH {_STACK_BODY} SELECT feed, id, marque FROM stacked"
ORACLE["union_distinct"] = f"WITH {_STACK_BODY} SELECT category, section FROM stacked GROUP BY ALL"


def _rejects(feed: str, image: str, bad: dict[str, str]) -> str:
    """Texts that are there and mean nothing, by column."""
    rows = " UNION ALL ".join(f"SELECT id, {image} AS image_url, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS text FROM texts WHERE {test}" for c, test in bad.items())
    return f"SELECT '{feed}' AS feed, * FROM (WITH texts AS (SELECT *, row_number() OVER (ORDER BY {ID_ORDER}) AS id FROM raw_{feed}) {rows})"


_NO_COUNT = {"quantity_stock": f"trim(quantity_stock) <> '' AND {_COUNT} IS NULL"}
_NO_MONEY = {"price": f"regexp_matches(price, '[^ €]') AND {_MONEY} IS NULL"}
_NO_DAY = {"date": "date IS NOT NULL AND TRY_CAST(date AS DATE) IS NULL"}
_NO_UNIT_PRICE = f"price_per_quantity NOT IN ('1,067.50 € / KG', 'le flacon de 250ml') AND trim(price_per_quantity) <> '' AND {_PER_UNIT} IS NULL"
ORACLE["bronze_rejects"] = f"WITH {RAW}\n" + "\nUNION ALL\n".join([
    _rejects("auchan", "image_url", {**_NO_COUNT, **_NO_MONEY, **_NO_DAY}),
    _rejects("biocoop", "img", {"price": f"trim(price) <> '' AND ({_PATCHED}) IS NULL", "price_per_quantity": _NO_UNIT_PRICE, **_NO_DAY}),
    _rejects("carrefour", "image_url", {
        **_NO_COUNT, **_NO_MONEY, "promotion": f"trim(promotion) <> '' AND {_found('promotion', '([0-9]+[.,][0-9]+)')} IS NULL",
        "price_per_quantity": _NO_UNIT_PRICE, **_NO_DAY}),
    _rejects("labellevie", "image_url", {
        "quantity_stock": f"regexp_matches(quantity_stock, '[0-9.]') AND {_STOCKED} IS NULL", **_NO_MONEY,
        "promotion": f"promotion NOT IN ('', '%') AND {_OFF} IS NULL", **_NO_DAY}),
])

# the whole build: four bronze feeds, silver, dimensions, fact
_LAKE = _STACK_BODY + _fill_sql("stacked", _FEED_KEYS, _FILL_COLS, "fsilver", ["image_url", "name"]) + _DIM_CTES + _FACT_CTES
ORACLE["lakehouse_build"] = f"WITH {_LAKE} SELECT * FROM fact_sales"

# -- cleaners ----------------------------------------------------------------

ORACLE["clean_price"] = f"WITH {RAW} SELECT price AS price_text, {_MONEY} AS price FROM raw_auchan"
ORACLE["clean_price_fixups"] = f"WITH {RAW} SELECT price AS price_text, {_PATCHED} AS price FROM raw_biocoop"
ORACLE["clean_discount"] = f"""WITH {RAW}
SELECT price AS price_text, promotion AS promotion_text, {_OFF} AS discount, {_REDUCED} AS price FROM raw_labellevie"""
ORACLE["promo_ratio"] = f"""WITH {RAW}
SELECT price AS price_text, promotion AS promotion_text, 1 - {_found("promotion", "([0-9]+,[0-9]+)")} / NULLIF({_MONEY}, 0) AS promotion
FROM raw_carrefour"""
ORACLE["extract_number"] = f"""WITH {RAW}
SELECT quantity_stock AS stock_text, array_to_string(regexp_extract_all(quantity_stock, '[0-9.]'), '') AS digits FROM raw_labellevie"""
ORACLE["extract_unit"] = f"WITH {RAW} SELECT price_per_quantity AS unit_text, {_LETTERS} AS unit FROM raw_biocoop"
ORACLE["clean_stock"] = f"WITH {RAW} SELECT stock AS stock_text, {_SHELF_STOCK} AS stock FROM raw_biocoop"
ORACLE["extract_unit_price"] = f"""WITH {RAW}
SELECT price_per_quantity AS unit_text, {_LETTERS} AS unit, {_PER_UNIT} AS price_per_unit FROM raw_carrefour"""
ORACLE["derive_quantity"] = f"""WITH {RAW}
SELECT price AS price_text, price_per_quantity AS unit_text, {_PACK} AS quantity FROM raw_carrefour"""
ORACLE["normalize_units"] = f"""WITH {RAW}, read AS (SELECT {_LETTERS} AS letters, {_PER_UNIT} AS per_unit, {_PACK} AS pack FROM raw_carrefour)
SELECT letters AS raw_unit, pack AS raw_quantity, {_scaled("pack", "letters")} AS quantity, coalesce({_UNIT_NAMES}[letters], letters) AS unit,
  if(pack IS NULL, NULL, {_scaled("per_unit", "letters")}) AS price_per_quantity
FROM read"""
ORACLE["clamp_sentinel"] = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_extendedprice BETWEEN 9850 AND 10000 THEN 1.0 ELSE l_extendedprice END AS sales
FROM lineitem"""

_OBS_ZERO = OBS + """,
obs_z AS (
  SELECT * REPLACE (CASE WHEN l_orderkey % 5 = 0 THEN 0.0 ELSE quantity END AS quantity) FROM obs
)"""
ORACLE["zero_to_null"] = f"WITH {_OBS_ZERO} SELECT l_orderkey, l_linenumber, NULLIF(quantity, 0) AS quantity FROM obs_z"
ORACLE["price_per_quantity"] = f"""WITH {_OBS_ZERO}
SELECT l_orderkey, l_linenumber, price, quantity, price / NULLIF(quantity, 0) AS price_per_quantity FROM obs_z"""
ORACLE["date_truncate"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(date_trunc('day', o_orderdate) AS DATE) AS day_trunc
FROM orders"""
ORACLE["date_arith"] = """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 370 DAY AS DATE) AS plus_370,
  CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS BIGINT) AS days_to_2000
FROM orders"""
ORACLE["project_rename"] = f"WITH {RAW} SELECT img AS image_url, name, date AS date_day FROM raw_biocoop"
ORACLE["filter_valid_key"] = f"""WITH {RAW}
SELECT image_url, l_orderkey, l_linenumber FROM raw_lines l WHERE {VALID_URL}"""
ORACLE["filter_not_blank"] = f"""WITH {RAW}
SELECT image_url, name, l_orderkey, l_linenumber FROM raw_lines
WHERE image_url IS NOT NULL AND trim(image_url) <> '' AND name IS NOT NULL AND trim(name) <> ''"""
ORACLE["filter_series_keys"] = f"""WITH {RAW}
SELECT image_url, name, l_orderkey, l_linenumber FROM raw_lines WHERE image_url IS NOT NULL AND name IS NOT NULL"""
ORACLE["dedup_lookup"] = f"WITH {RAW} SELECT * FROM cat1"
ORACLE["dedup_daily"] = f"WITH {OBS_DAILY} SELECT image_url, date, l_orderkey, l_linenumber, stock FROM obs_daily"
ORACLE["dedup_desc_nulls_last"] = f"""WITH {OBS}
SELECT image_url, date, stock, l_orderkey, l_linenumber FROM (
  SELECT *, row_number() OVER (PARTITION BY image_url, date
    ORDER BY stock DESC NULLS LAST, l_orderkey, l_linenumber) AS rn FROM obs) WHERE rn = 1"""
ORACLE["join_left_enrich"] = f"""WITH {RAW}
SELECT r.name, r.l_orderkey, r.l_linenumber, r.l_suppkey, r.l_returnflag, c.category
FROM raw_auchan r LEFT JOIN cat1 c ON c.product_name = r.name"""
ORACLE["join_inner_enrich"] = f"""WITH {RAW}
SELECT r.name, r.l_orderkey, r.l_linenumber, r.l_suppkey, r.l_returnflag, s.section
FROM raw_biocoop r JOIN sec1 s ON s.product_name = r.name"""
ORACLE["join_dim_lookup"] = f"""WITH {DIMS}
SELECT s.product_id, d.date_id, p.id_picture
FROM fsilver s LEFT JOIN dim_picture p ON s.image_url = p.picture LEFT JOIN dim_date d ON s.date = d.date"""


# -- snapshot -----------------------------------------------------------------

_SCD_AS_OF = ("2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00")


def _scd(key: str, cols: list[str], batches: list[str]) -> str:
    """Snapshot tables snap1, snap2... of batch tables, one after another."""
    parts = []
    for n, (batch, as_of) in enumerate(zip(batches, _SCD_AS_OF), 1):
        t = f"TIMESTAMP '{as_of}'"
        fresh = (f"SELECT b.{key}, {', '.join('b.' + c for c in cols)}, md5(concat_ws('|', CAST(b.{key} AS VARCHAR), CAST({t} AS VARCHAR))) "
                 f"AS version_id, {t} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, {t} AS updated_at FROM {batch} b")
        if n == 1:
            parts.append(f"snap1 AS ({fresh})")
            continue
        row = lambda x: "(" + ", ".join(f"{x}.{c}" for c in [key, *cols]) + ")"
        gone = f"NOT EXISTS (SELECT 1 FROM {batch} b WHERE {row('b')} IS NOT DISTINCT FROM {row('s')})"
        parts.append(f"""snap{n} AS (
  SELECT {key}, {', '.join(cols)}, version_id, valid_from,
         CASE WHEN valid_to IS NULL AND {gone} THEN {t} ELSE valid_to END AS valid_to, updated_at FROM snap{n - 1} s
  UNION ALL
  {fresh} WHERE NOT EXISTS (SELECT 1 FROM snap{n - 1} s WHERE s.valid_to IS NULL AND {row('b')} IS NOT DISTINCT FROM {row('s')})
)""")
    return ",\n".join(parts)


_CUSTOMERS = """
c AS (SELECT * REPLACE (NULLIF(c_custkey, 1) AS c_custkey), c_custkey AS k FROM customer),
b1 AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, CAST(NULL AS VARCHAR) AS c_label FROM c),
b2 AS (
  SELECT c_custkey, c_name, c_nationkey, if(k % 5 = 0, c_acctbal + 1, c_acctbal) AS c_acctbal,
    if(k % 11 = 0, NULL, c_mktsegment) AS c_mktsegment, CAST(NULL AS VARCHAR) AS c_label FROM c WHERE k % 7 <> 0
),
b3 AS (
  SELECT c_custkey, c_name, c_nationkey, if(k % 10 = 0, c_acctbal + 1, c_acctbal) AS c_acctbal,
    if(k % 11 = 0, NULL, c_mktsegment) AS c_mktsegment, if(k % 3 = 0, 'loyal', NULL) AS c_label FROM c
),
""" + _scd("c_custkey", ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_label"], ["b1", "b2", "b3"])
ORACLE["scd2_initial"] = f"WITH {_CUSTOMERS} SELECT * EXCLUDE (c_label) FROM snap1"
ORACLE["scd2_changed"] = f"WITH {_CUSTOMERS} SELECT * EXCLUDE (c_label) FROM snap2"
ORACLE["scd2_deleted"] = f"WITH {_CUSTOMERS} SELECT * FROM snap3"
ORACLE["product_snapshot"] = f"""WITH {DIMS},
p1 AS (SELECT *, CAST(NULL AS VARCHAR) AS label FROM dim_product),
p2 AS (SELECT * REPLACE (if(product_id % 5 = 0, name || '!', name) AS name) FROM p1 WHERE product_id % 7 <> 0),
p3 AS (SELECT * REPLACE (if(product_id % 5 = 0, name || '!', name) AS name, if(product_id % 3 = 0, 'bio', NULL) AS label) FROM p1),
{_scd("product_id", ["name", "marque", "id_category", "id_picture", "id_store", "label"], ["p1", "p2", "p3"])}
SELECT * FROM snap3"""

# -- data quality -------------------------------------------------------------

_ORDERS_DQ = """
orders_dq AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN o_orderkey - 1 ELSE o_orderkey END AS order_ref,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 23 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS o_custkey,
    o_totalprice
  FROM orders
)"""

ORACLE["dq_unique"] = f"""WITH {_ORDERS_DQ}
SELECT order_ref, count(*) AS n_records FROM orders_dq WHERE order_ref IS NOT NULL
GROUP BY order_ref HAVING count(*) > 1"""
ORACLE["dq_not_null"] = f"WITH {_ORDERS_DQ} SELECT o_orderkey FROM orders_dq WHERE o_custkey IS NULL"
ORACLE["dq_relationships"] = f"""WITH {_ORDERS_DQ}
SELECT o.o_custkey FROM orders_dq o
WHERE o.o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)"""
ORACLE["dq_between"] = f"WITH {_ORDERS_DQ} SELECT o_orderkey, o_totalprice FROM orders_dq WHERE o_totalprice < 50000"
ORACLE["dq_unparsed"] = f"""WITH {RAW}
SELECT l_orderkey, l_linenumber, quantity_stock FROM raw_auchan
WHERE quantity_stock IS NOT NULL AND {_COUNT} IS NULL"""


def _uniq(t: str, c: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"


def _nn(t: str, c: str) -> str:
    return f"(SELECT count(*) FROM {t} WHERE {c} IS NULL)"


def _rel(t: str, c: str, p: str, f: str) -> str:
    return (f"(SELECT count(*) FROM {t} x WHERE x.{c} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM {p} y WHERE y.{f} = x.{c}))")


_GOLD_TESTS = [
    ("dim_picture.id_picture.unique", _uniq("dim_picture", "id_picture")),
    ("dim_picture.id_picture.not_null", _nn("dim_picture", "id_picture")),
    ("dim_product.product_id.unique", _uniq("dim_product", "product_id")),
    ("dim_product.product_id.not_null", _nn("dim_product", "product_id")),
    ("dim_product.id_picture.relationships", _rel("dim_product", "id_picture", "dim_picture", "id_picture")),
    ("dim_product.id_store.relationships", _rel("dim_product", "id_store", "dim_store", "id_store")),
    ("dim_product.id_category.relationships", _rel("dim_product", "id_category", "dim_category", "id_category")),
    ("dim_category.id_category.unique", _uniq("dim_category", "id_category")),
    ("dim_category.id_category.not_null", _nn("dim_category", "id_category")),
    ("dim_store.id_store.unique", _uniq("dim_store", "id_store")),
    ("dim_store.id_store.not_null", _nn("dim_store", "id_store")),
    ("dim_date.date_id.unique", _uniq("dim_date", "date_id")),
    ("dim_date.date_id.not_null", _nn("dim_date", "date_id")),
    ("fact_sales.id.unique", _uniq("fact_sales", "id")),
    ("fact_sales.id.not_null", _nn("fact_sales", "id")),
    ("fact_sales.product_id.relationships", _rel("fact_sales", "product_id", "dim_product", "product_id")),
    ("fact_sales.date_id.relationships", _rel("fact_sales", "date_id", "dim_date", "date_id")),
]


def _report(tests: list[tuple[str, str]]) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{n}' AS test, CAST({q} AS BIGINT) AS failures, CASE WHEN {q} = 0 THEN 'pass' ELSE 'fail' END AS status"
        for n, q in tests)


ORACLE["dq_report"] = f"WITH {FACT}\n" + _report(_GOLD_TESTS)
ORACLE["dq_report_violations"] = f"WITH {_ORDERS_DQ}\n" + _report([
    ("orders.o_orderkey.unique", _uniq("orders_dq", "o_orderkey")), ("orders.order_ref.unique", _uniq("orders_dq", "order_ref")),
    ("orders.order_ref.not_null", _nn("orders_dq", "order_ref")), ("orders.o_custkey.not_null", _nn("orders_dq", "o_custkey")),
    ("orders.o_custkey.relationships", _rel("orders_dq", "o_custkey", "customer", "c_custkey")),
    ("orders.o_totalprice.at_least", "(SELECT count(*) FROM orders_dq WHERE o_totalprice < 50000)"),
])

ORACLE["sort_zorder"] = f"WITH {SILVER} SELECT * FROM silver"
ORACLE["source_declared"] = """
SELECT o_orderkey, TRY_CAST(o_custkey AS TINYINT) AS o_custkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_comment,
  CASE WHEN TRY_CAST(o_custkey AS TINYINT) IS NULL THEN CAST(o_custkey AS VARCHAR) END AS rescued_custkey, o_orderpriority AS rescued_priority,
  CAST((TRY_CAST(o_custkey AS TINYINT) IS NULL AND o_custkey IS NOT NULL)::INT + (o_orderpriority IS NOT NULL)::INT
       + (o_orderstatus IS NOT NULL)::INT + (o_orderdate IS NOT NULL)::INT AS BIGINT) AS n_rescued
FROM orders"""
ORACLE["sort_total"] = f"WITH {SILVER} SELECT * FROM silver"
ORACLE["layer_roundtrip"] = f"""WITH {OBS_DAILY}
SELECT image_url, name, date, price, stock, l_orderkey, l_linenumber FROM obs_daily"""
ORACLE["stream_landing"] = f"WITH {RAW} SELECT * FROM raw_auchan"
