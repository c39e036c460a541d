"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_key(col: str | Column) -> Column:
    """Not NULL, not empty, not the text 'nan' in any case."""
    c = F.col(col) if isinstance(col, str) else col
    return c.isNotNull() & (c != "") & (F.lower(c) != "nan")


def not_blank(*cols: str) -> Column:
    """Every column is non-NULL and not only blanks."""
    cond = F.lit(True)
    for name in cols:
        cond = cond & F.col(name).isNotNull() & (F.trim(F.col(name)) != "")
    return cond


def filter_valid_key(df: DataFrame, col: str) -> DataFrame:
    return df.filter(valid_key(col))


def filter_not_blank(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.filter(not_blank(*cols))
