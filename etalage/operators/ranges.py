"""Key ranges with bounds fixed once, as literals.

A sample of the full sort key is sorted, and every k-th key of it becomes a bound. The
bounds are one literal in the plan, and the range of a row is a binary search in it: a
pure function of the row's key. So every pass over the rows, and every retried task,
sees the same ranges without a stored copy of the rows, and a single leading value that
holds a third of the table is still cut at its later key parts. The sample decides how
even the ranges are, never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

#: sampled keys for each range; they are what comes to the driver
PER_RANGE = 20
#: a literal that is searched in 14 steps; beyond this the driver would hold too many sampled keys
MOST_RANGES = 10_000
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "true"}


def _key(order_by: Sequence[str]) -> Column:
    """The sort key as one value that compares like ORDER BY ... ASC NULLS FIRST."""
    # a part without an ELSE counts as nullable, as those of the parsed literal do, so no cast is planned
    return F.struct(*[F.when(F.col(c).isNotNull(), F.col(c)).alias(f"k{i}") for i, c in enumerate(order_by)])


def sampled_bounds(df: DataFrame, order_by: Sequence[str], ranges: int, rows: int) -> list[str]:
    """At most ``ranges - 1`` keys, sorted, as JSON texts."""
    if ranges < 2 or not rows:
        return []
    share = min(1.0, PER_RANGE * ranges / rows)
    keys = df.select(_key(order_by).alias("key"))
    keys = keys if share == 1.0 else keys.sample(fraction=share, seed=11)
    found = [r[0] for r in keys.orderBy("key").select(F.to_json("key", _EXACT)).collect()]
    return list(dict.fromkeys(found[len(found) * k // ranges] for k in range(1, ranges))) if found else []


def range_of(df: DataFrame, order_by: Sequence[str], bounds: Sequence[str]) -> Column:
    """The range of each row: how many bounds are at or below its key."""
    if not bounds:
        return F.lit(0)
    return binary_search(bounds_array(df, order_by, bounds), len(bounds), _key(order_by))


def with_range(df: DataFrame, order_by: Sequence[str], bounds: Sequence[str], out: str) -> DataFrame:
    """The rows with their ``range_of`` as a last column ``out``.

    Every step of the search is a projection of its own, so all of them are compiled with what
    surrounds them, where the search as one expression is interpreted for each row.
    """
    if not bounds:
        return df.withColumn(out, F.lit(0))
    at, key, low = bounds_array(df, order_by, bounds), f"{out}_key", F.lit(0)
    rows = df.select("*", _key(order_by).alias(key))
    for b in reversed(range(len(bounds).bit_length())):
        s = 1 << b
        found = F.when((low + s <= len(bounds)) & (F.get(at, low + (s - 1)) <= F.col(key)), low + s).otherwise(low)
        rows = rows.select(*df.columns, key, F.coalesce(found, F.lit(0)).alias(f"{out}_{b}"))  # never null, as below
        low = F.col(f"{out}_{b}")
    return rows.select(*df.columns, low.alias(out))


def bounds_array(df: DataFrame, order_by: Sequence[str], bounds: Sequence[str]) -> Column:
    """The bounds as one sorted literal; the parts of each are named k0, k1, ..."""
    kind = ArrayType(StructType([StructField(f"k{i}", df.schema[c].dataType, True) for i, c in enumerate(order_by)]), False)
    return F.sort_array(F.from_json(F.lit("[" + ",".join(bounds) + "]"), kind, _EXACT))


def binary_search(at: Column, size: int, key: Column) -> Column:
    """How many of the ``size`` sorted values of an array are at or below the key."""
    steps = [1 << b for b in reversed(range(size.bit_length()))]
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda low, s: F.when((low + s <= size) & (F.get(at, low + s - 1) <= key), low + s).otherwise(low))
    return F.coalesce(found, F.lit(0))  # never null, which spares a filter where it is joined on
