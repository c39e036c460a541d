"""Previous values along the days of a series whose rows are spans of days (G5, D6 without a row per day).

A span stands for all days from its first to its last, with one value. Spark deals the spans
to tasks by series and sorts them there by tie-break; a task puts the days of its series in order
as plain integers and looks up the value before each. So what is shuffled, sorted and moved as
rows are spans; a day is a few numbers in an array until it is unfolded from its span.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from etalage.operators.ranges import MOST_RANGES, sampled_bounds, with_range
from etalage.sources.io import stored

#: days that are put in order at a time, besides those of a longer series; days of a piece of a hot series
DAYS_AT_ONCE = 500_000
DAYS_PER_PIECE = 1_000_000
#: what a span's days add up to: the sum of the abs of its non-positive steps, and how many they are
DOWN, DOWNS = "_down", "_downs"


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole series, about ``DAYS_AT_ONCE`` days of them at a time; ``_rn`` is 1 on a series' first row."""
    held, days = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = np.flatnonzero(batch.column("_rn").to_numpy() == 1)
        if days >= DAYS_AT_ONCE and len(starts):
            cut = int(starts[-1])
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held, days, batch = [], 0, batch.slice(cut)
        held.append(batch)
        days += int(pc.sum(batch.column("_days")).as_py())
    if held:
        yield pa.Table.from_batches(held)


class _Days:
    """The days of whole series in order of series, day and tie-break (the order that the spans are in)."""

    def __init__(self, spans: pa.Table, date: str, value: str):
        first = spans[date].cast(pa.int32()).to_numpy().astype(np.int64)
        length = spans["_days"].to_numpy()
        self.spans, self.ends = len(first), np.cumsum(length)
        self.span = np.repeat(np.arange(self.spans), length)
        self.day = np.arange(len(self.span)) - np.repeat(self.ends - length - first, length)
        self.group = np.cumsum(spans["_rn"].to_numpy() == 1) - 1
        low = first.min()
        self.at = self.group[self.span] * int((first + length).max() - low) + (self.day - low)  # series and day as one number
        self.order = np.argsort(self.at, kind="stable")
        values = spans[value].combine_chunks()
        self.known, self.value = values.is_valid().to_numpy(zero_copy_only=False), values.fill_null(0.0).to_numpy(zero_copy_only=False)
        self.before = np.empty(len(self.span), np.int64)  # the span of the day before, in that order
        self.before[self.order[1:]] = self.span[self.order[:-1]]
        self.before[self.order[:1]] = self.span[self.order[:1]]
        self.opens = np.zeros(len(self.span), bool)  # the first day of a series
        self.opens[self.order] = np.diff(self.group[self.span[self.order]], prepend=-1) != 0

    def steps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each day: the previous value, whether there is one, and whether the step from it is down or none."""
        previous, known = self.value[self.before], self.known[self.before] & ~self.opens
        with np.errstate(invalid="ignore"):
            down = known & self.known[self.span] & (self.value[self.span] - previous <= 0)
        return previous, known, down

    def falls(self, previous: np.ndarray, down: np.ndarray) -> np.ndarray:
        with np.errstate(invalid="ignore"):
            return np.where(down, np.abs(self.value[self.span] - previous), 0.0)


def _array(values: np.ndarray, known: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=~known)


def _previous(date: str, value: str, lists: bool, names: Sequence[str]):
    """Spans with the previous value on each of their days, their falls and their series' mean fall.

    Where there are marks (``_mark``), they are days before which nothing is asked: the value before the
    day's first row, and the mean of the whole series."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            days = _Days(table, date, value)
            previous, known, down = days.steps()
            sums = np.bincount(days.span, days.falls(previous, down), days.spans)
            counts = np.bincount(days.span[down], minlength=days.spans)
            if "_mark" in table.column_names:
                opening = np.flatnonzero(table["_rn"].to_numpy() == 1)
                mean = table["_mean"].take(pa.array(opening)).take(pa.array(days.group)).combine_chunks()
            else:
                total, n = np.bincount(days.group, sums), np.bincount(days.group, counts)
                mean = _array((total / np.maximum(n, 1))[days.group], (n > 0)[days.group])
            made = {"_mean": mean, DOWN: pa.array(sums), DOWNS: pa.array(counts, pa.int64())}
            if lists:
                offsets = pa.array(np.concatenate([[0], days.ends]), pa.int32())
                made["_prev"] = pa.ListArray.from_arrays(offsets, _array(previous, known))
            out = pa.table({c: made[c] if c in made else table[c] for c in names})
            if "_mark" in table.column_names:
                out = out.filter(pc.invert(table["_mark"]))
            yield from out.to_batches()
    return run


def _per_day(date: str, value: str, names: Sequence[str]):
    """Of each piece and day: its first and last value, and the falls between its rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches):
            days = _Days(table, date, value)
            previous, _, down = days.steps()
            at = days.at[days.order]
            new = np.diff(at, prepend=at[:1] - 1) != 0
            place = np.cumsum(new) - 1  # of each row in order: its day
            within = down[days.order] & ~new
            first = days.span[days.order][new]
            last = days.span[days.order][np.append(new[1:], True)]
            made = {
                "_key": table["_key"].take(pa.array(first)), "_day": pa.array(days.day[days.order][new], pa.int32()).cast(pa.date32()),
                "_first": _array(days.value[first], days.known[first]), "_last": _array(days.value[last], days.known[last]),
                DOWN: pa.array(np.bincount(place, np.where(within, days.falls(previous, down)[days.order], 0.0))),
                DOWNS: pa.array(np.bincount(place, within).astype(np.int64)),
            }
            yield from pa.table({c: made[c] for c in names}).to_batches()
    return run


def _dealt(rows: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """Rows of a key together and in order, the first of a key with ``_rn`` 1."""
    # a hash settles most comparisons of keys in one step
    together = rows.withColumn("_hash", F.xxhash64("_key")).repartition(n, "_key").sortWithinPartitions("_hash", "_key", *order)
    return together.withColumn("_rn", F.row_number().over(Window.partitionBy("_hash", "_key").orderBy(*order))).drop("_hash")


def lag_spans(df: DataFrame, series_key: Sequence[str], date: str, value: str, tie_break: Sequence[str], through: str,
              n: int, pieces: int = 1, rows: int = 0, lists: bool = True) -> DataFrame:
    """The spans with ``_prev``, the previous value of the series on each of their days, ``_mean``, the
    series' mean depletion, and ``_down`` and ``_downs``, the sum and number of their own falls.

    The value is taken as a double. A row without a day stands for none and goes. ``pieces`` cuts series into that
    many ranges of (series, tie-break) at sampled keys, for series that are too long for a task: then a
    piece's first and last value on each day are scanned for what comes before it on that day, and go to the
    piece as marks. ``rows`` is the number of days.
    """
    series = F.struct(*[F.col(k) for k in series_key])
    order = [F.col(c) for c in [*tie_break, date]]
    spans = df.withColumn(value, F.col(value).cast("double")).withColumn(
        "_days", F.datediff(through, date).cast("long") + 1).filter("_days > 0")
    bounds = sampled_bounds(_unfolded(df, date, through), [*series_key, *tie_break], pieces, rows) if pieces > 1 else []
    made = [StructField("_mean", DoubleType()), StructField(DOWN, DoubleType()), StructField(DOWNS, LongType()),
            *([StructField("_prev", ArrayType(DoubleType()))] if lists else [])]
    out = StructType([*[f for f in spans.schema if f.name != "_days"], *made])
    if not bounds:
        dealt = _dealt(spans.withColumn("_key", series), n, order).drop("_key")
        return dealt.mapInArrow(_previous(date, value, lists, out.names), out)
    keyed = with_range(spans, [*series_key, *tie_break], bounds, "_c").withColumn("_key", F.struct(F.col("_c").alias("c"), series.alias("s"))).drop("_c")
    n = max(n, 2 * len(bounds))
    kind = StructType([keyed.schema["_key"], StructField("_day", df.schema[date].dataType), StructField("_first", DoubleType()),
                       StructField("_last", DoubleType()), StructField(DOWN, DoubleType()), StructField(DOWNS, LongType())])
    narrow = keyed.select("_key", *dict.fromkeys([date, value, *tie_break]), "_days")
    days = stored(_dealt(narrow, n, order).mapInArrow(_per_day(date, value, kind.names), kind), "steps")
    days = days.withColumn("_of", F.col("_key.s"))
    days = days.withColumn("_before", F.lag("_last", 1).over(Window.partitionBy("_of").orderBy("_day", "_key.c")))
    first = F.col("_first") - F.col("_before")
    total = F.sum(F.col(DOWN) + F.when(first <= 0, F.abs(first)).otherwise(0.0))
    means = days.groupBy("_of").agg(F.try_divide(total, F.sum(F.col(DOWNS) + F.when(first <= 0, 1).otherwise(0))).alias("_mean"))
    marks = days.join(means, "_of").select(
        "_key", F.col("_day").alias(date), F.lit(1).cast("long").alias("_days"), F.col("_before").alias(value), "_mean", F.lit(True).alias("_mark"))
    both = keyed.withColumn("_mark", F.lit(False)).unionByName(marks, allowMissingColumns=True)
    marked = _dealt(both, n, [F.col("_mark").desc(), *order]).drop("_key")
    return marked.mapInArrow(_previous(date, value, lists, out.names), out)


def _unfolded(spans: DataFrame, date: str, through: str) -> DataFrame:
    days = F.explode(F.sequence(F.col(date), F.col(through)))
    return spans.select(*[days.alias(date) if c == date else F.col(c) for c in spans.columns if c != through])
