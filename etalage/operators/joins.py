"""Lookup joins (D1, D2, D5, D7) and the FK anti-join.

No side is broadcast by hand: adaptive execution broadcasts a side whose shuffled
bytes turn out small, and splits the partitions of a hot key otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from etalage.operators.dedup import dedup_first


def enrich(
    df: DataFrame,
    lookup: DataFrame,
    left_on: str,
    right_on: str,
    value_cols: Sequence[str],
    order_by: Sequence[str | Column] | None = None,
    how: str = "left",
) -> DataFrame:
    """Attach ``value_cols`` from ``lookup``, one lookup row per key.

    The lookup is reduced to its first row per key under ``order_by``
    (default: the value columns themselves), so the join never fans out.
    ``how='left'`` keeps unmatched rows with NULLs; ``'inner'`` drops them.
    """
    order = list(order_by) if order_by else list(value_cols)
    one = dedup_first(lookup.select(right_on, *value_cols), [right_on], order)
    if right_on != left_on:
        one = one.withColumnRenamed(right_on, left_on)
    return df.join(one, on=left_on, how=how)


def missing_parents(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child keys with no parent row (left anti join)."""
    keys = parent.select(F.col(field).alias(col))
    return child.filter(F.col(col).isNotNull()).join(keys, on=col, how="left_anti")
