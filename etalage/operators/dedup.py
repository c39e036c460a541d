"""Keep one row per key (G1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def dedup_first(
    df: DataFrame,
    keys: Sequence[str | Column],
    order_by: Sequence[str | Column],
    rank_col: str = "_dedup_rank",
) -> DataFrame:
    """Keep the first row of each key group under ``order_by``.

    Written as ``row_number() = 1`` so Catalyst plans a map-side
    ``WindowGroupLimit`` before the shuffle: each task forwards only its own
    best row per key, so a hot key costs one row per map task, not its whole
    group. ``order_by`` should be total (add tie-breakers); otherwise which of
    the tied rows survives is up to the engine, as in plain SQL.
    """
    if not order_by:
        raise ValueError("dedup_first needs an ordering; use distinct() for set semantics")
    w = Window.partitionBy(*_as_cols(keys)).orderBy(*_as_cols(order_by))
    return (
        df.withColumn(rank_col, F.row_number().over(w))
        .filter(F.col(rank_col) == 1)
        .drop(rank_col)
    )
