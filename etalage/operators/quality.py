"""Data tests (Q1-Q6): each returns the violating rows; zero rows = pass.

``test_report`` turns a list of tests into one row per test with its count
of failing rows, which is what a test run reports. Row-wise tests can be counted
while a table is written (``stored_and_counted``), so they need no read of their own.
Tests on dense ids (``dense=True``: consecutive surrogates) are first settled by
bitmaps, one bit per id in words of 64: what is shuffled is a word and its count per 64 ids,
not the rows. Only where bitmaps find a violation are the violating rows counted.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from etalage.operators.joins import missing_parents
from etalage.sources.io import stored


def unique(df: DataFrame, col: str) -> DataFrame:
    """Q1: values seen more than once (NULL is not a value), with their count."""
    return (
        df.filter(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def not_null(df: DataFrame, col: str) -> DataFrame:
    """Q2: rows where the column is NULL."""
    return df.filter(F.col(col).isNull())


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Q3: non-NULL child keys with no matching parent key."""
    return missing_parents(child.select(col), col, parent, field)


def below(df: DataFrame, col: str, min_value) -> DataFrame:
    """Q4: rows under a lower bound (the range test)."""
    return df.filter(F.col(col) < F.lit(min_value))


def unparsed(df: DataFrame, raw: str | Column, parsed: str | Column) -> DataFrame:
    """Q5: rows whose text was present but could not be parsed."""
    r = F.col(raw) if isinstance(raw, str) else raw
    p = F.col(parsed) if isinstance(parsed, str) else parsed
    return df.filter(r.isNotNull() & p.isNull())


@dataclass(frozen=True)
class DataTest:
    """One test of a table's column: kind unique, not_null, at_least or relationships."""

    table: str
    column: str
    kind: str
    to: tuple[str, str] | None = None  # relationships: (table, column)
    low: float | None = None  # at_least
    dense: bool = False  # unique, relationships: the ids are consecutive numbers

    @property
    def name(self) -> str:
        return f"{self.table}.{self.column}.{self.kind}"


ROW_WISE = ("not_null", "at_least")


def _row_wise(tests: Sequence[DataTest], table: str) -> dict[str, Column]:
    """The violation of each row-wise test of a table."""
    return {t.name: F.col(t.column).isNull() if t.kind == "not_null" else F.col(t.column) < F.lit(t.low)
            for t in tests if t.table == table and t.kind in ROW_WISE}


def stored_and_counted(df: DataFrame, table: str, tests: Sequence[DataTest]) -> tuple[DataFrame, dict[str, int]]:
    """Write a table to the shared folder; the failures of its row-wise tests are counted on the way."""
    wise = _row_wise(tests, table)
    if not wise:
        return stored(df, table), {}
    seen = Observation()
    out = stored(df.observe(seen, *[F.count(F.when(c, 1)).alias(f"t{k}") for k, c in enumerate(wise.values())]), table)
    return out, {name: seen.get[f"t{k}"] for k, name in enumerate(wise)}


def _bitmaps(df: DataFrame, col: str) -> DataFrame:
    """bucket, bits, n: the ids of a column as one bit each, and how many rows have them. Spark sorts the
    rows for bitmaps of this length (see ``_words``)."""
    known = df.filter(F.col(col).isNotNull())
    return known.groupBy(F.bitmap_bucket_number(col).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(col)).alias("bits"), F.count(F.lit(1)).alias("n"))


def _words(df: DataFrame, col: str) -> DataFrame:
    """The same in words of 64 ids. A word is a number, so rows are summed up in a hash table and not sorted."""
    known = df.filter(F.col(col).isNotNull()).select(F.col(col).cast("long").alias("id"))
    bit = F.expr("shiftleft(1L, cast(id & 63 as int))")
    return known.groupBy(F.shiftright("id", 6).alias("bucket")).agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))


def dense_unique(df: DataFrame, col: str) -> bool:
    """Whether no id is seen twice: as many different ids as rows with one."""
    rows, ids = _words(df, col).agg(F.sum("n"), F.sum(F.bit_count("bits"))).first()
    return (rows or 0) == (ids or 0)


def dense_relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> bool:
    """Whether every id of the child is one of the parent's: their union has no more ids than the parent."""
    own = _words(parent, field).select("bucket", "bits", F.bit_count("bits").cast("long").alias("own"))
    both = own.unionByName(_words(child, col).select("bucket", "bits", F.lit(0).cast("long").alias("own")))
    ids, parents = both.groupBy("bucket").agg(F.bit_or("bits").alias("bits"), F.sum("own").alias("own")).agg(
        F.sum(F.bit_count("bits")), F.sum("own")).first()
    return (ids or 0) == (parents or 0)


def test_report(tables: dict[str, DataFrame], tests: Sequence[DataTest], counted: dict[str, int] | None = None) -> DataFrame:
    """Q6: one row per test: ``test``, ``failures`` (bigint), ``status``.

    Failures that are ``counted`` already are taken as they are. All other row-wise tests
    of a table are one pass over it (a count per test, partial per task). A unique test
    groups its column and a relationship is an anti join, except for dense ids whose
    bitmaps show no violation. The tables should be written ones.
    """
    parts, known = [], {t: counted[t.name] for t in tests if t.name in (counted or {})}
    for t in tests:
        if t.dense and t.kind == "unique" and dense_unique(tables[t.table], t.column):
            known[t] = 0
        elif t.dense and t.kind == "relationships" and dense_relationships(tables[t.table], t.column, tables[t.to[0]], t.to[1]):
            known[t] = 0
    left = [t for t in tests if t not in known]
    for table in dict.fromkeys(t.table for t in left):
        wise = _row_wise(left, table)
        if wise:
            counts = tables[table].agg(*[F.count(F.when(c, 1)).alias(f"t{k}") for k, c in enumerate(wise.values())])
            rows = F.array(*[F.struct(F.lit(n).alias("test"), F.col(f"t{k}").alias("failures")) for k, n in enumerate(wise)])
            parts.append(counts.select(F.inline(rows)))
        for t in left:
            if t.table == table and t.kind in ("unique", "relationships"):
                if t.kind == "unique":
                    failures = unique(tables[table], t.column).agg(F.count(F.lit(1)).alias("failures"))
                else:
                    # rows of a key have the same answer, so keys are joined with their number, not the rows
                    keys = tables[table].groupBy(t.column).agg(F.count(F.lit(1)).alias("_rows"))
                    bad = missing_parents(keys, t.column, tables[t.to[0]], t.to[1])
                    failures = bad.agg(F.coalesce(F.sum("_rows"), F.lit(0).cast("long")).alias("failures"))
                parts.append(failures.select(F.lit(t.name).alias("test"), "failures"))
    if known:
        spark = next(iter(tables.values())).sparkSession
        parts.append(spark.createDataFrame([(t.name, n) for t, n in known.items()], "test string, failures long"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failures") == 0, "pass").otherwise("fail"))
