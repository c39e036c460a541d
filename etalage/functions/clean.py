"""``Column -> Column`` cleaners for scraped retailer text.

All of them are built-in expressions, so they stay inside whole-stage codegen.
Malformed text becomes NULL (``try_cast``) instead of failing the job; the
rows concerned can be listed with ``etalage.operators.quality.unparsed``.
Regular expressions are Java patterns with ``$1`` group references.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (the feeds' own spellings and rules).
EURO = "€"
FROM_PRICE_PREFIX = "Àpartirde"  # "À partir de" once blanks are removed
IN_STOCK_PHRASES = ("in stock", "en stock", "disponible")
IN_STOCK_VALUE = -1
NUMBER_TEXT = r"^[0-9]+(\.[0-9]+)?$"
PRICE_FIXUPS = (("2150", "2.15"), ("1975", "1.975"))
DISCOUNT_JUNK = ("au lieu de", "+")
UNIT_PRICE_JUNK = ("1,067.50 € / KG", "le flacon de 250ml")
UNIT_AFTER_SLASH = r".*/\s*([a-zA-Z]+)"
LEADING_NUMBER = r"^([0-9]+(?:[.,][0-9]+)?)\s.*"
UNIT_RENAMES = (("Kilogramme", "Kg"), ("le flacon de 250ml", "ml"))
KILO_UNITS = ("kg", "Kg", "KG")
MILLI_UNITS = ("ml",)
UNIT_TOKENS = {"kg": "g", "KG": "g", "Kg": "g", "ml": "L", "U": "UNITE"}
SENTINEL_RANGE = (9850, 10000)
PRICE_DECIMAL = "decimal(18,4)"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def replace_all(col: str | Column, pairs: Iterable[tuple[str, str]]) -> Column:
    """Chained literal substring replacement."""
    out = _c(col)
    for old, new in pairs:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def to_number(text: Column, dtype: str = "double") -> Column:
    """Text to number; blanks around it allowed, anything else malformed -> NULL."""
    return F.trim(text).try_cast(dtype)


def price_text(col: str | Column, from_prefix: bool = True) -> Column:
    """E1 text step: drop the euro sign and blanks, decimal comma -> point,
    and the "from" prefix -> "0" (so "À partir de 2,50€" reads 02.50)."""
    pairs = [(EURO, ""), (" ", ""), (",", ".")]
    if from_prefix:
        pairs.append((FROM_PRICE_PREFIX, "0"))
    return replace_all(col, pairs)


def parse_price(col: str | Column, from_prefix: bool = True) -> Column:
    """Scraped price text -> double (parsed as decimal(18,4))."""
    return to_number(price_text(col, from_prefix), PRICE_DECIMAL).cast("double")


def parse_price_fixups(col: str | Column, fixups: Sequence[tuple[str, str]] = PRICE_FIXUPS) -> Column:
    """Price text with known mis-scraped spellings patched, -> double."""
    return to_number(replace_all(col, fixups))


def discount_text(promotion: str | Column) -> Column:
    """E3 text step: '20%' -> '20', '' -> NULL."""
    return F.nullif(F.replace(_c(promotion), F.lit("%"), F.lit("")), F.lit(""))


def discount_fraction(promotion: str | Column) -> Column:
    """E3: '20%' -> 0.2; '' or NULL -> NULL."""
    return to_number(discount_text(promotion), PRICE_DECIMAL).cast("double") / 100


def discount_base_text(price: str | Column) -> Column:
    """E3 text step: the price text without the euro sign, "au lieu de" and "+"."""
    return replace_all(price, [(EURO, ""), *[(j, "") for j in DISCOUNT_JUNK]])


def discounted_price(price: str | Column, promotion: str | Column) -> Column:
    """Price after a percent discount.

    With a parsed discount the price is reduced; with an empty promotion it is
    kept; with a NULL promotion it is NULL (the rule has no arm for it).
    """
    base = to_number(discount_base_text(price), PRICE_DECIMAL).cast("double")
    d = discount_fraction(promotion)
    return F.when(d.isNotNull(), base * (1 - d)).when(_c(promotion) == "", base)


def promo_ratio(promotion: str | Column, price: str | Column) -> Column:
    """Share taken off by a promotional price, ``1 - promo / price``."""
    promo = parse_price(F.nullif(price_text(promotion, False), F.lit("")), False)
    return F.when(promo.isNotNull(), 1 - F.try_divide(promo, parse_price(price, False)))


def keep_digits(col: str | Column) -> Column:
    """E5: keep only digits and points."""
    return F.regexp_replace(_c(col), r"[^0-9.]+", "")


def keep_letters(col: str | Column, drop: Sequence[str] = (EURO, "x")) -> Column:
    """E5: keep only letters and blanks, then drop the given substrings."""
    return replace_all(F.regexp_replace(_c(col), r"[^a-zA-Z\s]+", ""), [(d, "") for d in drop])


def parse_stock(col: str | Column) -> Column:
    """Numeric text -> value; availability phrase -> -1; anything else -> 0."""
    c = _c(col)
    return (
        F.when(c.rlike(NUMBER_TEXT), c.try_cast("double"))
        .when(F.lower(c).isin(*IN_STOCK_PHRASES), F.lit(float(IN_STOCK_VALUE)))
        .otherwise(F.lit(0.0))
    )


def parse_stock_number(col: str | Column) -> Column:
    """E6 (plain feeds): stock text is a number or NULL."""
    return to_number(_c(col), PRICE_DECIMAL).cast("double")


def unit_after_slash(col: str | Column) -> Column:
    """Unit letters after the last '/', with known spellings renamed."""
    return replace_all(F.regexp_replace(_c(col), UNIT_AFTER_SLASH, "$1"), UNIT_RENAMES)


def unit_price_text(col: str | Column, junk: Sequence[str] = UNIT_PRICE_JUNK) -> Column:
    """E7 text step: the number a unit-price text starts with, decimal comma -> point.

    Texts on the junk list give NULL; a text without a leading number stays as it is.
    """
    bare = F.nullif(replace_all(col, [(j, "") for j in junk]), F.lit(""))
    return F.replace(F.regexp_replace(bare, LEADING_NUMBER, "$1"), F.lit(","), F.lit("."))


def leading_number(col: str | Column, junk: Sequence[str] = UNIT_PRICE_JUNK) -> Column:
    """E7 / E8: '12.50 € / KG' or '12,50 € / KG' -> 12.5; junk or no leading number -> NULL."""
    return to_number(unit_price_text(col, junk), PRICE_DECIMAL).cast("double")


def pack_size(price: str | Column, unit_price: Column, digits: int | None = None) -> Column:
    """quantity = price / unit price; NULL when the unit price is NULL or 0."""
    q = F.try_divide(_c(price), F.nullif(unit_price, F.lit(0.0)))
    return F.round(q, digits) if digits is not None else q


def scale_quantity(quantity: str | Column, unit: str | Column) -> Column:
    """Kilo units -> x1000 (to grams), milli units -> /1000 (to litres)."""
    q, u = _c(quantity), _c(unit)
    return F.when(u.isin(*KILO_UNITS), q * 1000).when(u.isin(*MILLI_UNITS), q / 1000).otherwise(q)


def scale_unit_price(
    unit_price: str | Column, unit: str | Column, quantity: str | Column, consistent: bool = False
) -> Column:
    """Price per unit, following the quantity's unit change.

    The reference multiplies a per-kilo price by 1000 (and divides a per-ml
    price by 1000), i.e. the same factor as the quantity. ``consistent=True``
    applies the inverse factor instead, which is what a per-gram price needs.
    """
    p, u = _c(unit_price), _c(unit)
    up, down = (p / 1000, p * 1000) if consistent else (p * 1000, p / 1000)
    return F.when(_c(quantity).isNull(), F.lit(None).cast("double")).when(
        u.isin(*KILO_UNITS), up
    ).when(u.isin(*MILLI_UNITS), down).otherwise(p)


def rename_unit(unit: str | Column, tokens: dict[str, str] | None = None) -> Column:
    """Whole-token unit rename (kg -> g, ml -> L, U -> UNITE ...)."""
    u = _c(unit)
    out = None
    for old, new in (tokens or UNIT_TOKENS).items():
        out = (F.when(u == old, F.lit(new)) if out is None else out.when(u == old, F.lit(new)))
    return out.otherwise(u) if out is not None else u


def clamp_sentinel(col: str | Column, lo: float = SENTINEL_RANGE[0], hi: float = SENTINEL_RANGE[1]) -> Column:
    """Values in [lo, hi] are a scraper sentinel and count as 1."""
    c = _c(col)
    return F.when(c.between(lo, hi), F.lit(1.0)).otherwise(c)


def zero_to_null(col: str | Column) -> Column:
    """0 means unknown."""
    return F.nullif(_c(col), F.lit(0))


def price_per_quantity(price: str | Column, quantity: str | Column) -> Column:
    """Price / quantity, NULL when the quantity is NULL or 0."""
    return F.try_divide(_c(price).cast("double"), F.nullif(_c(quantity).cast("double"), F.lit(0.0)))
