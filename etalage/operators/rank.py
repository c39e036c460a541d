"""Consecutive 1..N numbering over a whole table (G2) without a single-partition sort.

``row_number() over (order by k)`` with no PARTITION BY makes Spark move every
row into one task (``Exchange SinglePartition``). That does not survive a large
table. The distributed form here gives the same numbers:

1. a sample of the full key gives range bounds, which are literals from then on
   (``operators.ranges``): the range of a row is a pure function of its key;
2. a counting pass over the key columns sums up the rows per range (one number per
   range, partial per task; no row is moved or written);
3. the rows are shuffled once, by range; a row's number is the offset of its range
   plus its place in it.

A table of up to ``ROWS_PER_RANGE`` rows is one range: a plain sort in one task of
bounded size. ``running_total`` is the same with a weight per row: what all rows
before it weigh.

For a leading integer spread evenly over a known range (hash surrogates),
``uniform_leading=(lo, hi)`` needs no sample: the range is arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.operators.ranges import MOST_RANGES, sampled_bounds, with_range

#: rows that one task sorts without ado
ROWS_PER_RANGE = 200_000


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranges(df: DataFrame, ranges: int | None, rows: int | None = None) -> int:
    if ranges is None:
        most = min(MOST_RANGES, shuffle_partitions(df))
        return most if rows is None else max(1, min(most, -(-rows // ROWS_PER_RANGE)))
    if ranges < 1:
        raise ValueError(f"ranges must be 1 or more, not {ranges}")
    return ranges


def uniform_range(col: str, lo: int, hi: int, ranges: int) -> Column:
    """Arithmetic range of an integer spread evenly over ``[lo, hi)``; NULLs first."""
    width = (hi - lo) / ranges
    b = F.floor((F.col(col).cast("double") - F.lit(float(lo))) / F.lit(width)).cast("long")
    b = F.least(F.greatest(b, F.lit(0)), F.lit(ranges - 1)) + 1
    return F.when(F.col(col).isNull(), F.lit(0)).otherwise(b).cast("int")


def ranged(df: DataFrame, order_by: Sequence[str], ranges: int | None = None) -> tuple[DataFrame, int]:
    """The rows with their ``_range``, and how many ranges there are at most."""
    _ranges(df, ranges)
    rows = df.count() if ranges != 1 else 0
    bounds = sampled_bounds(df, order_by, _ranges(df, ranges, rows), rows)
    return with_range(df, order_by, bounds, "_range"), len(bounds) + 1


def running_total(
    df: DataFrame,
    order_by: Sequence[str],
    out: str,
    weight: str | None = None,
    ranges: int | None = None,
    uniform_leading: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``out``: the weight of all rows before a row (their number, without ``weight``), as bigint.

    The frame is read more than once, so it must give the same rows each time. Rows with equal
    keys are in one range and are numbered in an arbitrary order, as in SQL.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    if uniform_leading is not None:
        n = _ranges(df, ranges)
        tagged = df.withColumn("_range", uniform_range(order_by[0], *uniform_leading, n))
    else:
        tagged, n = ranged(df, order_by, ranges)
    within = Window.partitionBy("_range").orderBy(*order)
    if weight:
        place = F.coalesce(F.sum(weight).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    else:
        place = F.row_number().over(within) - 1
    placed = tagged.select(*df.columns, "_range", place.cast("long").alias("_place"))
    if n == 1:
        return placed.select(F.col("_place").alias(out), *df.columns)
    return placed.join(F.broadcast(range_offsets(tagged, weight)), "_range").select(
        (F.col("_offset") + F.col("_place")).alias(out), *df.columns)


def global_rank(
    df: DataFrame,
    order_by: Sequence[str],
    out: str = "id",
    ranges: int | None = None,
    uniform_leading: tuple[int, int] | None = None,
) -> DataFrame:
    """Add ``out`` = ``row_number() over (order by order_by)`` as bigint.

    Ascending, NULLS FIRST on every column (Spark's default, and the order the
    models use). The result is placed first among the columns. The order
    should be total; ties are numbered in an arbitrary order, as in SQL.

    ``ranges`` is how many key ranges are sorted apart; by default that follows the
    number of rows, up to the shuffle partitions and ``MOST_RANGES``.
    """
    counted = running_total(df, order_by, out, None, ranges, uniform_leading)
    return counted.select((F.col(out) + 1).alias(out), *df.columns)


def range_offsets(df: DataFrame, weight: str | None = None) -> DataFrame:
    """``(_range, _offset)``: the weight (or number) of the rows in all lower ranges, one row per range."""
    counts = df.groupBy("_range").agg((F.sum(weight) if weight else F.count(F.lit(1))).cast("long").alias("n")).toArrow()
    at = counts.column("_range").to_numpy()
    n = counts.column("n").to_numpy()
    order = np.argsort(at)
    return offsets_frame(df.sparkSession, at[order], n[order])


def offsets_frame(spark, ranges: np.ndarray, counts: np.ndarray) -> DataFrame:
    before = np.cumsum(counts) - counts
    return spark.createDataFrame(pa.table({"_range": pa.array(ranges, pa.int32()), "_offset": pa.array(before, pa.int64())}))
