"""Daily series: extent, date spine, spine join, running counts, forward fill.

A series is identified by ``keys`` and observed on a ``date`` axis. The silver
layer makes every series dense: one row per day from its first observation to
its last, each column carrying its last known value forward. A caller may limit
a series to ``max_days`` days after its first; by default there is no limit.
Observations without a date belong to no day and are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from etalage.functions.keys import hash_key
from etalage.operators.rank import running_total, shuffle_partitions
from etalage.operators.ranges import MOST_RANGES, bounds_array, sampled_bounds, with_range
from etalage.operators.steps import DAYS_PER_PIECE, DOWN, DOWNS, lag_spans
from etalage.sources.io import stored

#: rows of a series that one task takes without ado
ROWS_PER_CHUNK = 4_000_000
#: days that one task of a shuffle by series unfolds, on average; the less for small tables
ROWS_PER_TASK, ROWS_PER_SMALL_TASK = 1_000_000, 100_000
#: days that one task unfolds from spans, none of which it sorts as rows
DAYS_PER_TASK = 4_000_000
#: the last day that an observation covers
THROUGH = "_through"


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series building ignores rows with a NULL key part."""
    return df.dropna(subset=list(keys))


def series_extent(df: DataFrame, keys: Sequence[str], date: str = "date") -> DataFrame:
    """first day, last day and span of every series (partial + final hash agg)."""
    return (
        drop_null_keys(df, keys)
        .groupBy(*keys)
        .agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"))
        .withColumn("date_diff", F.datediff("max_date", "min_date").cast("long"))
    )


def _spine_end(min_date: Column, max_date: Column, max_days: int | None) -> Column:
    if max_days is None:
        return max_date
    return F.least(max_date, F.date_add(min_date, max_days))


def date_spine(
    df: DataFrame,
    keys: Sequence[str],
    date: str = "date",
    max_days: int | None = None,
    with_offset: bool = False,
) -> DataFrame:
    """Every day of every series, as a generator instead of a theta join.

    ``explode(sequence(first, last))`` (``last`` at most ``first + max_days``, if
    that is given) produces exactly the rows of ``extent CROSS JOIN numbers WHERE n <= date_diff``, without a
    nested-loop join. ``with_offset`` also returns ``n``, the day offset.
    """
    ext = series_extent(df, keys, date).filter(F.col("min_date").isNotNull())
    days = F.sequence(F.col("min_date"), _spine_end(F.col("min_date"), F.col("max_date"), max_days))
    if with_offset:
        return ext.select(*keys, F.posexplode(days).alias("n", date)).withColumn(
            "n", F.col("n").cast("long")
        )
    return ext.select(*keys, F.explode(days).alias(date))


def _series(keys: Sequence[str]):
    """The window of a series. Keys mostly begin alike, so a sort by their hash first compares faster."""
    return Window.partitionBy(F.xxhash64(*keys), *keys)


def _spans(df: DataFrame, keys: Sequence[str], values: Sequence[Column], date: str, max_days: int | None) -> DataFrame:
    """Each observation with its ``values`` and the days up to the next one of its series, at least its own."""
    obs = drop_null_keys(df, [*keys, date])
    in_series = _series(keys).orderBy(date)
    found = obs.select(
        *keys, F.col(date), *values,
        F.lead(date, 1).over(in_series).alias("_next"),
        F.first(date).over(in_series.rowsBetween(Window.unboundedPreceding, 0)).alias("_first"),
    )
    end = F.coalesce(F.date_sub("_next", 1), F.col(date))
    if max_days is not None:
        cap = F.date_add("_first", max_days)
        found = found.filter(F.col(date) <= cap)
        end = F.least(end, cap)
    return found.withColumn(THROUGH, F.greatest(end, F.col(date))).drop("_next", "_first")


def spine_left_join(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    date: str = "date",
    max_days: int | None = None,
) -> DataFrame:
    """D3: left join the observations onto the spine by ``keys + [date]``.

    A series' spine is the days of its observations and the days up to the next one each, so
    every observation emits its own day with its values and the days that follow without. That
    shuffles the observations, by series, and no day of the spine; a day observed twice
    gives two rows, as in the join.
    """
    spans = _spans(df, keys, [F.col(c) for c in cols], date, max_days)
    days = F.posexplode(F.sequence(F.col(date), F.col(THROUGH))).alias("_at", "_day")
    return spans.select(*keys, days, *cols).select(
        *keys, F.col("_day").alias(date), *[F.when(F.col("_at") == 0, F.col(c)).alias(c) for c in cols])


def running_nonnull_count(
    df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str], suffix: str = "_group"
) -> DataFrame:
    """Running count of non-NULL values per column, ROWS UNBOUNDED PRECEDING."""
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        *df.columns,
        *[
            F.sum(F.when(F.col(c).isNotNull(), 1).otherwise(0)).over(w).cast("long").alias(c + suffix)
            for c in cols
        ],
    )


def forward_fill(
    df: DataFrame, keys: Sequence[str], date: str, cols: Sequence[str]
) -> DataFrame:
    """Last observation carried forward, no look-back limit.

    One ``last(c, ignorenulls)`` per column over a single window: one sort for
    all columns, instead of a running-count window plus a second window per
    column. Rows before a column's first value stay NULL.
    """
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    filled = {c: F.last(c, ignorenulls=True).over(w).alias(c) for c in cols}
    return df.select(*[filled.get(c, F.col(c)) for c in df.columns])


def unfold(spans: DataFrame, date: str = "date", through: str = THROUGH, arrays: Sequence[str] = ()) -> DataFrame:
    """One row per day from ``date`` to ``through``; the other columns repeat, ``through`` goes.
    ``arrays`` hold an element per day, and give each day its own."""
    days = F.explode(F.sequence(F.col(date), F.col(through)))
    if not arrays:
        return spans.select(*[days.alias(date) if c == date else F.col(c) for c in spans.columns if c != through])
    at = F.datediff("_day", date)
    return spans.select("*", days.alias("_day")).select(
        *[F.col("_day").alias(c) if c == date else F.get(c, at).alias(c) if c in arrays else F.col(c) for c in spans.columns if c != through])


def _sizes(df: DataFrame, series: Column, days: Column) -> tuple[int, int]:
    """Days of all series together, and of the longest one."""
    per = df.groupBy(series.alias("_key")).agg(F.sum(days).alias("n"))
    rows, longest = per.agg(F.sum("n"), F.max("n")).first()
    return rows or 0, longest or 0


def pieces(spans: DataFrame, series_key: Sequence[str], date: str, tie_break: Sequence[str], through: str, bounds: list[str]) -> DataFrame:
    """The spans cut where a chunk ends, each piece with its chunk ``_chunk``.

    A bound (series, day, tie-break) belongs to the chunk above it, so the days of a span that
    are in that chunk begin on the bound's day, or a day later if the span's tie-break is lower.
    """
    order = [*series_key, date, *tie_break]
    if not bounds:
        return spans.withColumn("_chunk", F.lit(0))
    at = bounds_array(spans, order, bounds)
    tie = F.struct(*[F.when(F.col(c).isNotNull(), F.col(c)).alias(f"t{i}") for i, c in enumerate(tie_break)])

    def begin(chunk: Column) -> Column:
        bound = F.get(at, chunk - 1)
        day = bound[f"k{len(series_key)}"]
        if not tie_break:
            return day
        theirs = F.struct(*[bound[f"k{len(series_key) + 1 + i}"].alias(f"t{i}") for i in range(len(tie_break))])
        return F.when(tie >= theirs, day).otherwise(F.date_add(day, 1))

    ranged = with_range(with_range(spans, order, bounds, "_low"), [*series_key, through, *tie_break], bounds, "_high")
    cut = ranged.select(
        "*", F.explode(F.sequence("_low", "_high")).alias("_chunk"))
    first = F.when(F.col("_chunk") == F.col("_low"), F.col(date)).otherwise(begin(F.col("_chunk")))
    last = F.when(F.col("_chunk") == F.col("_high"), F.col(through)).otherwise(F.date_sub(begin(F.col("_chunk") + 1), 1))
    return cut.select(*[first.alias(c) if c == date else last.alias(c) if c == through else F.col(c) for c in spans.columns],
                      "_chunk").filter(F.col(date) <= F.col(through))


def lag_diff(
    df: DataFrame,
    series_key: Sequence[str],
    date: str,
    value: str,
    tie_break: Sequence[str] = (),
    prev: str = "prev",
    diff: str = "diff",
    mean: str | None = None,
    chunks: int | None = None,
    through: str | None = None,
    folded: bool = False,
) -> DataFrame:
    """Previous value in the series and the difference to it.

    ``mean`` also attaches the series' mean depletion (D6): the mean of
    ``abs(diff)`` over its non-positive differences, NULL if it has none.

    With ``through`` a row of ``df`` stands for all days from ``date`` to that column (see
    ``fill_spans``). The result is the one for the unfolded days, but rows are shuffled and sorted
    as spans, and days are unfolded last (``operators.steps``). ``folded`` leaves the spans as they
    are: ``prev`` is then an array over a span's days (see ``unfold``), or left out if it is None, there is no ``diff``,
    and ``_down`` and ``_downs`` hold the sum and the number of the span's falls.

    Series of up to ``ROWS_PER_CHUNK`` rows go to one task each, and the windows alone do
    it. A series may hold a great many rows (one placeholder picture shared by a third of
    all products, on one day even); if one does, this is a blocked prefix scan. The rows, in the
    order of series, day and tie-break, are cut into chunks at sampled keys and shuffled
    once, by (chunk, series). A window in each gives its rows' steps and one summary
    row; the summaries of a series, one per chunk, are scanned for what comes before
    each chunk and for the series' mean, and joined back on the same partitioning. Both
    readers of the shuffled rows see the same columns, so Spark shuffles them once
    (``ReusedExchange``); callers select what they need first. ``chunks`` asks for that
    many at least.

    The key is a struct, so NULL keys and NULL dates are values like any other (a
    NULL date comes first).
    """
    v = F.col(value)
    series = F.struct(*[F.col(k) for k in series_key])
    order = [F.col(date).asc_nulls_first(), *tie_break]
    days = F.datediff(through, date).cast("long") + 1 if through else F.lit(1)
    total, longest = _sizes(df, series, days)
    wide = shuffle_partitions(df)
    hot = chunks is not None or longest > ROWS_PER_CHUNK
    columns = [c for c in df.columns if c != through]
    if through:
        n = max(1, min(wide, -(-total // ROWS_PER_SMALL_TASK)), -(-total // DAYS_PER_TASK))
        cuts = min(MOST_RANGES, max(chunks or 1, -(-total // min(DAYS_PER_PIECE, ROWS_PER_CHUNK)))) if hot else 1
        spans = lag_spans(df, series_key, date, value, tie_break, through, n, cuts, total, lists=prev is not None)
        found = [F.col("_prev").alias(prev)] if prev else []
        found += [F.col("_mean").alias(mean)] if mean else []
        if folded:
            return spans.select(*columns, through, *found, DOWN, DOWNS)
        opened = unfold(spans.select(*columns, through, *found), date, through, [prev])
        return opened.select(*columns, prev, (v - F.col(prev)).alias(diff), *([mean] if mean else []))
    bounds = []
    if hot:
        cuts = min(MOST_RANGES, max(chunks or 1, -(-total // ROWS_PER_CHUNK)))
        bounds = sampled_bounds(df, [*series_key, date, *tie_break], cuts, total)
    if not bounds:
        rows = df.withColumn("_key", series)
        if total > wide * ROWS_PER_TASK:
            # so many that a task holds a bounded number of rows, whatever they weigh
            rows = rows.repartition(-(-total // ROWS_PER_TASK), "_key")
        in_series, all_of_it = Window.partitionBy("_key").orderBy(*order), Window.partitionBy("_key")
        rows = rows.withColumn("_prev", F.lag(value, 1).over(in_series)).withColumn("_step", v - F.col("_prev"))
        down = F.avg(F.when(F.col("_step") <= 0, F.abs("_step"))).over(all_of_it)
        return rows.select(*[F.col(c) for c in columns], F.col("_prev").alias(prev), F.col("_step").alias(diff),
                           *([down.alias(mean)] if mean else []))
    in_key = Window.partitionBy("_key").orderBy(*order)
    whole = in_key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the series' columns travel in the key only, so what is shuffled does not depend on whether they are used later
    payload = [c for c in columns if c not in series_key]
    ranged = with_range(df, [*series_key, date, *tie_break], bounds, "_c")
    keyed = ranged.select(F.struct(F.col("_c").alias("c"), series.alias("s")).alias("_key"), *payload)
    rows = keyed.select(
        "*",
        F.row_number().over(in_key).alias("_rn"),
        F.lag(value, 1).over(in_key).alias("_prev"),
        F.first(value).over(whole).alias("_first"),
        F.last(value).over(whole).alias("_last"),
    )
    step = v - F.col("_prev")
    down = (F.col("_rn") > 1) & (step <= 0)
    # always true; it makes the summaries read the columns that the rows need, so that both share one shuffle
    alike = F.when(F.col("_rn") == 1, F.xxhash64(*payload) >= -(1 << 63)).otherwise(F.lit(True))
    summary = rows.filter(alike).groupBy("_key").agg(
        F.max("_first").alias("_first"),
        F.max("_last").alias("_last"),
        F.sum(F.when(down, F.abs(step))).alias("_s"),
        F.count(F.when(down, F.lit(1))).alias("_c"),
    ).withColumn("_of", F.col("_key.s"))
    carried = summary.withColumn("_before", F.lag("_last", 1).over(Window.partitionBy("_of").orderBy("_key.c")))
    if mean:
        first_step = F.col("_first") - F.col("_before")
        total = F.coalesce(F.col("_s"), F.lit(0.0)) + F.when(first_step <= 0, F.abs(first_step)).otherwise(0.0)
        count = F.col("_c") + F.when(first_step <= 0, 1).otherwise(0)
        same = Window.partitionBy("_of")
        carried = carried.withColumn("_mean", F.try_divide(F.sum(total).over(same), F.sum(count).over(same)))
    carried = carried.select("_key", "_before", *(["_mean"] if mean else []))
    before = F.when(F.col("_rn") == 1, F.col("_before")).otherwise(F.col("_prev"))
    own = [F.col(c) if c in payload else F.col("_key")["s"][c].alias(c) for c in columns]
    return rows.join(carried, "_key").select(
        *own, before.alias(prev), (v - before).alias(diff),
        *([F.col("_mean").alias(mean)] if mean else []))


def fill_spans(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    date: str = "date",
    max_days: int | None = None,
    hash_col: str | None = "product_id",
    hash_of: Sequence[str] | None = None,
) -> DataFrame:
    """H2 before its days are unfolded: one row per observation, with its forward-filled
    values and the days it covers, ``date`` to ``THROUGH`` (the day before the next one).

    ``unfold`` gives the dense rows. Whatever does not look at single days (the surrogate, a
    distinct, a lookup by key, a written copy, a shuffle by series) costs a row per
    observation here.
    """
    w_run = _series(keys).orderBy(date).rowsBetween(Window.unboundedPreceding, 0)
    filled = _spans(df, keys, [F.last(c, ignorenulls=True).over(w_run).alias(c) for c in cols], date, max_days)
    own = [hash_key(*(hash_of or keys)).alias(hash_col)] if hash_col else []
    return filled.select(*own, *keys, date, *cols, THROUGH)


def fill_series(
    df: DataFrame,
    keys: Sequence[str],
    cols: Sequence[str],
    date: str = "date",
    max_days: int | None = None,
    hash_col: str | None = "product_id",
    id_col: str | None = None,
    hash_of: Sequence[str] | None = None,
) -> DataFrame:
    """H2: dense daily series with forward-filled columns.

    Same rows and values as spine + left join + running-count groups +
    ``first_value`` per group, but planned as one shuffle on ``keys``:

    * one window over the observations gives, per observation, its
      forward-filled values, the next observation day (``lead``) and the
      series' first day;
    * each observation then emits the days it covers,
      ``sequence(day, next_day - 1)``, cut at ``first_day + max_days`` if given.

    No join, no aggregate, no spine materialised before the fill. With ``id_col`` the
    observations, not the days, are numbered, each weighing the days that it covers.
    Input must
    hold at most one row per ``keys + [date]`` (the bronze daily dedup
    guarantees it); a duplicate day emits one row per duplicate, as the join
    form does. ``hash_col`` is the md5 surrogate of ``hash_of`` (default: the
    keys); ``id_col`` numbers the rows by keys and date over the whole table.
    """
    filled = fill_spans(df, keys, cols, date, max_days, hash_col, hash_of)
    if not id_col:
        return unfold(filled, date)
    # written once: numbering reads its rows more than once, and would shuffle the observations for each
    filled = stored(filled.withColumn("_days", F.datediff(THROUGH, date) + 1), "spans")
    filled = running_total(filled, [*keys, date], "_before", "_days")
    own = [hash_col] if hash_col else []
    days = F.posexplode(F.sequence(F.col(date), F.col(THROUGH))).alias("_at", "_day")
    return filled.select("_before", *own, *keys, days, *cols).select(
        (F.col("_before") + F.col("_at") + 1).alias(id_col), *own, *keys, F.col("_day").alias(date), *cols)
