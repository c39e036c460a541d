"""Slowly changing dimension, type 2.

A snapshot holds every version of every row: the data columns plus
``version_id``, ``valid_from``, ``valid_to`` (NULL while current) and
``updated_at``. Applying a new batch compares the current versions with the
batch by key over the check columns (null-safe), then:

* unchanged key      -> current version kept;
* changed key        -> current version closed at ``as_of``, new version opened;
* new key            -> new version opened (also a key that came back after a delete);
* key gone           -> current version closed (``invalidate_hard_deletes``).

One full outer join on the key and a generator that emits 0-2 versions per
joined row: a single shuffle, no per-branch rescans. ``as_of`` is always an
argument, never the clock, so a run can be replayed and checked.

A NULL key is a key like any other. A column that is new in a batch is added to
the snapshot (NULL in versions closed before), a column that a batch lacks counts
as NULL in it; both are compared.

``SnapshotTable`` stores a snapshot: open versions in one table, split into parts by a
hash of the key, and closed ones in another, split by run. A run compares all keys but
rewrites only the parts whose keys changed, and adds one folder of closed versions.
Closed history is never read or written again by a run, and a read is two scans,
whatever the number of runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.sources.io import file_system, layer_path, published_versions, stored, subfolders

#: parts of a stored snapshot's open versions
PARTS = 64
VERSION_COLS = ["version_id", "valid_from", "valid_to", "updated_at"]


def _ts(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def _version_id(key: str, valid_from: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), valid_from.cast("string")))


def scd2_initial(incoming: DataFrame, key: str, as_of: str) -> DataFrame:
    """First run, every row opens a version at ``as_of``."""
    t = _ts(as_of)
    return incoming.select(
        *incoming.columns,
        _version_id(key, t).alias("version_id"),
        t.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        t.alias("updated_at"),
    )


def scd2_step(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    as_of: str,
    check_cols: Sequence[str] | None = None,
    invalidate_hard_deletes: bool = True,
    changes_only: bool = False,
) -> DataFrame:
    """The open versions after ``incoming``, and those it closes (``valid_to = as_of``).

    ``changes_only`` leaves out the versions that stay as they are."""
    before = [c for c in current.columns if c not in VERSION_COLS]
    data = [key, *[c for c in dict.fromkeys([*before, *incoming.columns]) if c != key]]
    check = list(check_cols) if check_cols else data[1:]
    t = _ts(as_of)
    types = {**dict(incoming.dtypes), **dict(current.dtypes)}

    def side(df: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
        values = [F.col(c) if c in df.columns else F.lit(None).cast(types[c]).alias(c) for c in cols]
        # NULLs inside a struct are equal in a join
        return df.select(F.struct(F.col(key)).alias("_key"), F.struct(*values).alias(name))

    old = side(current, "_old", [*data, *VERSION_COLS])
    j = old.join(side(incoming, "_new", data), on="_key", how="full_outer")

    same = F.lit(True)
    for c in check:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))

    def version(src: str, **versions: Column) -> Column:
        fields = [F.col(f"{src}.{c}").alias(c) for c in data]
        return F.struct(*fields, *[versions.get(c, F.col(f"_old.{c}")).alias(c) for c in VERSION_COLS])

    kept, closed = version("_old"), version("_old", valid_to=t)
    opened = version("_new", version_id=_version_id("_key." + key, t), valid_from=t,
                     valid_to=F.lit(None).cast("timestamp_ntz"), updated_at=t)
    stays = F.filter(F.array(kept), lambda v: F.lit(not changes_only))
    versions = (
        F.when(F.col("_old").isNull(), F.array(opened))
        .when(F.col("_new").isNull(), F.array(closed) if invalidate_hard_deletes else stays)
        .when(same, stays)
        .otherwise(F.array(closed, opened))
    )
    return j.select(F.explode(versions).alias("_v")).select(*[F.col(f"_v.{c}").alias(c) for c in [*data, *VERSION_COLS]])


def scd2_apply(snapshot: DataFrame, incoming: DataFrame, key: str, as_of: str, **options) -> DataFrame:
    """N1 + N2: the snapshot after taking in ``incoming`` at ``as_of``."""
    after = scd2_step(snapshot.filter(F.col("valid_to").isNull()), incoming, key, as_of, **options)
    history = snapshot.filter(F.col("valid_to").isNotNull())
    return after.unionByName(history, allowMissingColumns=True)


class SnapshotTable:
    """A stored snapshot: ``snapshots/<name>_open`` by part, ``<name>_closed`` by run.

    A run first publishes its changes (``<name>_changes``, small), then applies them: the
    closed ones are written to the run's folder, and the touched parts of the open table are
    replaced by dynamic partition overwrite. Applying twice gives the same, so a run that was
    stopped is finished from its changes before the next one starts.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, key: str, fmt: str | None = None, parts: int = PARTS):
        self.spark, self.root, self.name, self.key, self.parts = spark, root, name, key, parts
        self.fmt = fmt or "parquet"

    def _path(self, part: str) -> str:
        return layer_path(self.root, "snapshots", f"{self.name}_{part}")

    def _read(self, part: str) -> DataFrame:
        if part == "open" and not any(n.startswith("_part=") for n in subfolders(self.spark, self._path(part))):
            # every key is gone; what was closed last has the columns
            return self._read("closed").drop("_run").withColumn("_part", F.lit(0)).limit(0)
        return self.spark.read.format(self.fmt).option("mergeSchema", "true").load(self._path(part))

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(F.struct(self.key)), F.lit(self.parts)).cast("int").alias("_part")

    def _replace(self, df: DataFrame, part: str, column: str) -> None:
        """Only the folders of the values that ``column`` has are replaced."""
        df.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).save(self._path(part))

    def _applied(self, run: int):
        return file_system(self.spark, f"{self._path('changes')}/v{run:06d}/_APPLIED")

    def runs(self) -> int:
        """How many runs are done."""
        numbers = [int(n[1:]) for n in subfolders(self.spark, self._path("changes")) if n[1:].isdigit()]

        def done(run: int) -> bool:
            mark, fs = self._applied(run)
            return fs.exists(mark)

        return max((n for n in numbers if done(n)), default=0)

    def apply(self, incoming: DataFrame, as_of: str, **options) -> None:
        """Take in a batch."""
        n = self.runs()
        if f"v{n + 1:06d}" in published_versions(self.spark, self._path("changes")):
            self._apply(n + 1)  # a run that was stopped after it had published its changes
            n += 1
        if n:
            changes = scd2_step(self._read("open").drop("_part"), incoming, self.key, as_of, changes_only=True, **options)
            changes.select("*", self._part()).write.format(self.fmt).mode("overwrite").save(f"{self._path('changes')}/v{n + 1:06d}")
            self._apply(n + 1)
        else:
            first = scd2_initial(incoming, self.key, as_of).select("*", self._part())
            first.write.format(self.fmt).mode("overwrite").partitionBy("_part").save(self._path("open"))
            self._mark(1)

    def _mark(self, run: int) -> None:
        mark, fs = self._applied(run)
        fs.create(mark, True).close()

    def _apply(self, run: int) -> None:
        """Put a run's published changes into both tables."""
        changes = self.spark.read.format(self.fmt).load(f"{self._path('changes')}/v{run:06d}")
        opened = changes.filter(F.col("valid_to").isNull())
        self._replace(changes.filter(F.col("valid_to").isNotNull()).drop("_part").withColumn("_run", F.lit(run)), "closed", "_run")
        touched = [r[0] for r in changes.select("_part").distinct().collect()]  # ``parts`` numbers at most
        if touched:
            held = self._read("open").filter(F.col("_part").isin(touched))
            kept = held.join(changes.select("version_id"), "version_id", "left_anti").select(*held.columns)
            after = stored(kept.unionByName(opened, allowMissingColumns=True), "snapshot")
            self._replace(after, "open", "_part")
            left = {r[0] for r in after.select("_part").distinct().collect()}
            for part in set(touched) - left:  # all of its keys are gone
                folder, fs = file_system(self.spark, f"{self._path('open')}/_part={part}")
                fs.delete(folder, True)
        self._mark(run)

    def read(self) -> DataFrame:
        """All versions of all keys."""
        out = self._read("open").drop("_part")
        if any(n.startswith("_run=") for n in subfolders(self.spark, self._path("closed"))):
            out = out.unionByName(self._read("closed").drop("_run"), allowMissingColumns=True)
        return out


def scd2_replay(batches: Sequence[tuple[str, DataFrame]], key: str, **kwargs) -> DataFrame:
    """Apply batches in order: the first opens the snapshot, the rest update it."""
    (first_as_of, first), *rest = batches
    snap = scd2_initial(first, key, first_as_of)
    for as_of, batch in rest:
        snap = scd2_apply(snap, batch, key, as_of, **kwargs)
    return snap
