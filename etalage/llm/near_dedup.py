"""MinHash near-dedup with tensored banding.

A document's set is its distinct word shingles. Two small collections of half
keys are made, ``halves`` in each, of ``rows`` minhashes each; a table key is a
pair of one half key from either collection, so ``halves ** 2`` tables need only
``2 * halves * rows`` minhashes. Documents that share a table key are candidates;
the full sets confirm each link, exactly. Components of the links are the groups.

With 10 half keys of 2 minhashes, a pair at similarity 0.8 shares a table key
with probability 1 - 2 * 0.36 ** 10 > 0.9999; more similar pairs more surely.

Candidates without all pairs. Equal sets are one node. Table buckets of up to
``SMALL`` documents are compared in pairs; in a larger one the first document is
compared with the rest and leaves it, since all its pairs there are known. Links
merge components; a bucket whose documents are all in one component is done.

What is left in large buckets is sorted out by its shingles, rarest first. Two sets
that are similar enough share a shingle among the rarest of either (prefix filter;
the smaller of the two needs fewer of them), so a document without a rare shingle in
common with another component is done, and documents of one template that are not
linked never meet. Documents that share a rare shingle are compared as in the
buckets: in pairs where few have it, else the first with the rest.

Whoever still shares a rare shingle of more than ``SMALL`` documents with another
component is taken together with others by the left half of the table key: pivots,
documents outside a group's largest component, are compared with the whole group
and leave it, more of them each round, until no group holds two components. So n
near copies cost about n comparisons and not n * n, yet every two documents that
share a bucket are compared, already connected or shown to differ by their rare
shingles, and none of this is capped.

Scale: half keys of the first collection that nobody shares are dropped before
the pairs of half keys are formed. Texts are shuffled once, to take those of
candidates aside; the comparisons shuffle only these, the rare shingles only those of
unresolved large buckets. Hot keys meet in joins that adaptive execution splits;
counts and group minima are partial first.

Defined cases: a null or empty text has an empty set and is a component of its
own; fewer words than a shingle: the whole sequence is the one shingle; rows with
equal ids are judged each by its own text, and the id connects what any of these texts
is linked with; a null id is never the smallest id,
and a document without id is found by an equal set only (else its component is
null and it is not kept); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .graph import components
from .storage import store
from .words import Words, chunks, mix, shingles

SHINGLE = 4
PERCENT = 80
HALVES = 10
ROWS = 2
SEED = 11
SMALL = 8
PIVOTS, MOST_PIVOTS = 1024, 4096
PART = 2000

_UPPER_TO_LOWER = np.arange(256, dtype=np.uint8)
_UPPER_TO_LOWER[0x41:0x5B] += 32


def lowered(texts: pa.Array) -> pa.Array:
    """A-Z to a-z, all other bytes unchanged."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    if not len(texts):
        return texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    if data is None:
        return texts.cast(pa.large_string())
    raw = pa.py_buffer(_UPPER_TO_LOWER[np.frombuffer(data, np.uint8)].tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, raw], 0, texts.offset)


def set_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    return shingles(Words(lowered(texts)), size)


def half_keys(values: np.ndarray, bounds: np.ndarray, count: int, rows: int, seed: int) -> np.ndarray:
    """(texts, count) keys, each a mix of ``rows`` minhashes of a text's set."""
    rng = np.random.default_rng(seed)
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, count), np.uint64)
    for k in range(count):
        key = np.full(len(full), k + 1, np.uint64)
        for _ in range(rows):
            a, b = (np.uint64(x) for x in rng.integers(0, 1 << 63, 2, dtype=np.uint64))
            h = values * (a * np.uint64(2) + np.uint64(1)) + b
            h ^= h >> np.uint64(32)
            h *= np.uint64(0x9E3779B97F4A7C15)
            key = mix(key ^ np.minimum.reduceat(h, bounds[full]) + np.uint64(k)) if len(full) else key
        out[full, k] = key
    return out


def signatures(docs: DataFrame, shingle: int, halves: int, rows: int, seed: int) -> DataFrame:
    """doc_id, n_shingles, set1 and set2 (digest of the set), left and right half keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                values, bounds = set_of(part.column(1), shingle)
                sizes = np.diff(bounds)
                digest = []
                for salt in (1, 2):
                    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(salt)), dtype=np.uint64)))
                    digest.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                keys = half_keys(values, bounds, 2 * halves, rows, seed).view(np.int64)
                lists = [pa.array(list(keys[:, s : s + halves]), pa.list_(pa.int64())) for s in (0, halves)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), *map(pa.array, digest), *lists],
                    ["doc_id", "n_shingles", "set1", "set2", "left", "right"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, set1 long, set2 long, left array<long>, right array<long>")


def table_keys(nodes: DataFrame) -> DataFrame:
    """(key, half, node) of the tables where a node meets another one; half is the key's left half."""
    left = nodes.select("node", F.posexplode("left").alias("i", "half")).select(
        "node", F.xxhash64("i", "half").alias("half"))
    live = left.groupBy("half").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("half")
    kept = left.join(live, "half").groupBy("node").agg(F.collect_list("half").alias("halves"))
    opened = kept.join(nodes.select("node", "right"), "node").select(
        "node", F.explode("halves").alias("half"), "right").select(
        "node", "half", F.posexplode("right").alias("j", "other")).select(
        "node", "half", F.xxhash64("half", "j", "other").alias("key"))
    opened = store(opened, "table-keys")
    shared = opened.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y")).where("x < y").select("key")
    return opened.join(shared, "key").select("key", "half", "node")


def linked(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of the full sets."""
    one = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    both = one.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text_b"):
                if not part.num_rows:
                    continue
                # a pivot comes many times in a row: its set is made once
                pivots = part.column(2).dictionary_encode()
                va, ba = set_of(pivots.dictionary, shingle)
                vb, bb = set_of(part.column(3), shingle)
                keep = []
                for k, p in enumerate(pivots.indices.to_pylist()):
                    x, y = va[ba[p] : ba[p + 1]], vb[bb[k] : bb[k + 1]]
                    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                        keep.append(False)
                        continue
                    at = np.searchsorted(x, y)
                    met = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
                    keep.append(met > 0 and 100 * met >= percent * (len(x) + len(y) - met))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def group_near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT,
    halves: int = HALVES, rows: int = ROWS, seed: int = SEED, pivots: int = PIVOTS,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = store(signatures(base, shingle, halves, rows, seed), "signatures")
    digest = ["n_shingles", "set1", "set2"]
    nodes = store(
        sets.where("n_shingles > 0 and doc_id is not null").groupBy(*digest)
        .agg(F.min(F.struct("doc_id", "left", "right")).alias("least"))
        .select(*digest, F.col("least.doc_id").alias("node"), F.col("least.left").alias("left"), F.col("least.right").alias("right")), "nodes")

    buckets = store(table_keys(nodes), "buckets")
    candidates = store(buckets.select("node").distinct(), "candidates")
    # the texts of candidates, once each; rows that share an id may have several
    texts = store(
        base.join(candidates, F.col("doc_id") == F.col("node"), "left_semi")
        .groupBy(F.col("doc_id").alias("node"), F.xxhash64("text")).agg(F.first("text").alias("text")).select("node", "text"), "texts")

    labels = candidates.select("node", F.col("node").alias("component"))
    links = None

    def joined(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        """All links so far, and the components they make of the candidates."""
        every = store(found if links is None else links.union(found), "links")
        return every, store(candidates.join(components(every), "node", "left").select(
            "node", F.coalesce("component", "node").alias("component")), "labels")

    # 1. small buckets: all their pairs; large ones: the first document with the rest
    sized = store(buckets.join(buckets.groupBy("key").agg(F.min("node").alias("a"), F.count(F.lit(1)).alias("n")), "key"), "sized")
    few = sized.where(f"n <= {SMALL}")
    large = sized.where(f"n > {SMALL} and node <> a")
    pairs = few.select("key", F.col("node").alias("x")).join(few.select("key", "node"), "key").where("x < node").select(
        F.col("x").alias("a"), F.col("node").alias("b")).union(large.select("a", F.col("node").alias("b"))).distinct()
    links, labels = joined(linked(pairs, texts, shingle, percent))

    # 2. what is left of large buckets, by rare shingles: as in the buckets
    groups = store(unresolved(large.select("key", "half", "node"), labels, ["key"]).select("half", "node").distinct(), "groups")
    if groups.isEmpty():
        rare = None
    else:
        left = texts.join(groups.select("node").distinct(), "node", "left_semi")
        shared = store(unresolved(rare_shingles(left, shingle, percent), labels, ["token"]), "shared")
        links, labels = joined(linked(rare_pairs(shared, percent), texts, shingle, percent))
        rare = store(shared.where(f"n > {SMALL}").select("token", "node"), "rare")

    # 3. who still shares one with another component, by left half keys: pivots, more of them each round
    count = pivots
    while rare is not None:
        alive = unresolved(rare, labels, ["token"]).select("node").distinct()
        open_ = store(unresolved(groups.join(alive, "node", "left_semi"), labels, ["half"]), "open")
        if open_.isEmpty():
            break
        chosen = store(_smallest(open_.where("component <> main"), count), "pivots")
        links, labels = joined(linked_to_pivots(open_, chosen, texts, shingle, percent))
        groups = store(open_.select("half", "node").join(chosen.select("half", "node"), ["half", "node"], "left_anti"), "groups")
        count = min(4 * count, MOST_PIVOTS)

    named = nodes.select(*digest, "node").join(labels, "node", "left").select(
        *digest, F.coalesce("component", "node").alias("component"))
    # a set held by very many documents is split by adaptive execution; empty sets stay out of the join
    full = sets.where("n_shingles > 0").select("doc_id", *digest).join(named, digest, "left").select("doc_id", "n_shingles", "component")
    empty = sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    return full.union(empty).select(
        "doc_id", "n_shingles", F.col("component").alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("component"), F.lit(False)).alias("kept"))


def unresolved(rows: DataFrame, labels: DataFrame, by: list[str]) -> DataFrame:
    """Rows of groups with two components or more, with component, main (the group's
    largest) and n (its size)."""
    here = rows.join(labels, "node")
    sizes = here.groupBy(*by, "component").agg(F.count(F.lit(1)).alias("n"))
    main = sizes.groupBy(*by).agg(
        F.max(F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("m"), F.sum("n").alias("n")).where("m > 1")
    return here.join(main.select(*by, F.col("main.component").alias("main"), "n"), by)


def rare_shingles(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(token, node, size, short): the rarest shingles of every text, those that others have too.

    Sets x and y, x not the larger, with 100 * intersection >= percent * union share a token
    that is ``short`` in x: with o = ceil(percent * size / 100) and shingles in one total order,
    it is among the first size - o + 1 of y and, since the union is size(x) at least, among the
    first size - ceil(2 * percent * size / (100 + percent)) + 1 of x.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                values, bounds = set_of(part.column(2), shingle)
                sizes = np.diff(bounds)
                of = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(of), part.column(1).take(of), pa.array(np.repeat(sizes, sizes)), pa.array(values.view(np.int64))],
                    ["node", "version", "size", "token"])

    # a node has several texts where rows share an id
    rows = store(texts.select("node", F.xxhash64("text").alias("version"), "text").mapInArrow(
        run, "node long, version long, size long, token long"), "shingles")
    held = rows.groupBy("token").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    own = Window.partitionBy("node", "version")
    place = F.col("size") - F.count(F.lit(1)).over(own) + F.row_number().over(own.orderBy("held", "token"))
    long_, short = (F.col("size") - F.floor((f * F.col("size") + d - 1) / d) + 1 for f, d in ((percent, 100), (2 * percent, 100 + percent)))
    first = rows.join(held, "token").withColumn("place", place).where(F.col("place") <= long_).select(
        "token", "node", "size", (F.col("place") <= short).alias("short"))
    first = store(first, "rare-shingles")
    met = first.groupBy("token").agg(F.min("node").alias("x"), F.max("node").alias("y"), F.max("short").alias("any")).where("x < y and any")
    return first.join(met.select("token"), "token")


def rare_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share a rare shingle: all of them where at
    most ``SMALL`` have it, else the first document with the rest."""
    rest = shared.select("token", "node", "size", "short", "component", "n")
    first = rest.groupBy("token").agg(F.min(F.struct("node", "size", "short", "component")).alias("one")).select("token", "one.*")
    one = rest.where(f"n <= {SMALL}").drop("n").union(first.join(rest.where(f"n > {SMALL}").select("token").distinct(), "token", "left_semi"))
    one = one.select("token", F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("short").alias("short_a"), F.col("component").alias("component_a"))
    return one.join(rest, "token").where("a < node and component_a <> component").where(
        f"100 * least(size_a, size) >= {percent} * greatest(size_a, size)").where(
        "short_a and size_a <= size or short and size <= size_a").select("a", F.col("node").alias("b")).distinct()


def _smallest(rows: DataFrame, count: int) -> DataFrame:
    """(half, node, component, n): the ``count`` smallest nodes of each group, per salt first."""
    rows = rows.select("half", "node", "component", "n", F.pmod(F.xxhash64("node"), F.lit(64)).alias("salt"))
    for by in (["half", "salt"], ["half"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy("node"))
        rows = rows.withColumn("place", place).where(F.col("place") <= count).drop("place")
    return rows.drop("salt")


def linked_to_pivots(rows: DataFrame, chosen: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of groups' nodes with their pivots, as few as connect the same nodes.

    A group is dealt to parts of about ``PART`` nodes, and its pivots go to each part.
    There the pivots' shingles are one sorted list, in which a node's shingles are
    looked up once, for all pivots together; no row is made for a pair.
    """
    parts = F.greatest(F.lit(1), F.ceil(F.col("n") / PART)).cast("long")
    nodes = rows.select("half", "node", "component", F.pmod(F.xxhash64("node"), parts).alias("part")).join(texts, "node")
    held = chosen.join(texts.withColumnRenamed("text", "pivot_text"), "node").select(
        "half", "node", "component", "pivot_text", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"))

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        out: list[tuple[int, int]] = []
        if members.num_rows and pivots.num_rows:
            values, bounds = set_of(pivots.column("pivot_text").combine_chunks(), shingle)
            size, owner = np.diff(bounds), np.repeat(np.arange(pivots.num_rows), np.diff(bounds))
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            ids, labels = pivots.column("node").to_pylist(), pivots.column("component").to_pylist()
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while parent.setdefault(x, x) != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            for batch in members.select(["node", "component", "text"]).combine_chunks().to_batches():
                for piece in chunks(batch, "text"):
                    mine, cuts = set_of(piece.column(2), shingle)
                    low, high = np.searchsorted(values, mine), np.searchsorted(values, mine, side="right")
                    for k, (node, label) in enumerate(zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True)):
                        s, e = cuts[k], cuts[k + 1]
                        n = high[s:e] - low[s:e]
                        at = np.repeat(low[s:e] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
                        met = np.bincount(owner[at], minlength=len(ids))
                        for p in np.flatnonzero((met > 0) & (100 * met >= percent * (size + (e - s) - met))).tolist():
                            a, b = root(labels[p]), root(label)
                            if a != b:
                                parent[a] = b
                                out.append((ids[p], node))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})

    by = ["half", "part"]
    return nodes.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(run, "a long, b long")
