"""Hard negatives by exact integer scores: a residue-number-system GEMM.

Vectors become integers, floor(scale * x). The inner products of anchors with all
rows are worked out modulo several small primes, one float32 matrix product per
prime: residues lie in [-p/2, p/2] and ``CHUNK`` dimensions are added up at a time,
so every partial sum stays below 2^24 and float32 holds it exactly. The signed
scores are then put together by Chinese remaindering (balanced mixed-radix digits).
The number of primes follows from the largest squared norm of the table, which
bounds every score.

An anchor's positives are its best other rows of the same label. For each of them
the negatives are the best rows of other labels with a score in a window, given in
percent of the positive's score.

Scale: anchors are a stated query set against all rows, in blocks. Rows are dealt to
slabs and anchors to groups, both of bounded bytes; a slab meets a group in one
cogroup, which returns a few rows per anchor (the best of the slab), and windows over
these pick the best of all. The first pass multiplies equal labels only, the second
one everything. Nothing is gathered beyond a slab and a group; a hot label is in all
slabs alike, and a repeated row is told apart by a number of its own.

Defined cases: rows with a null label, a null vector or a null or non-finite component
take no part; an empty vector scores 0 with all; of vectors of different lengths the
shorter is filled up with zeros; a null id is never smaller than another and comes back
as null; repeated rows are rows of their own (each other's positives, and anchors each);
an empty table, or one without anchors, gives no rows; other columns are ignored. Scores
that could exceed 2^62 are an error, since no long holds them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import store

#: dimensions added up in float32 before the next reduction
CHUNK = 64
#: bytes of a slab of rows, and of a group of anchors, as 64-bit integers
BLOCK_BYTES = 32 << 20
_TILE_ROWS, _TILE_ANCHORS = 4096, 512
_MOST = 1 << 62


def primes_for(bound: float, chunk: int = CHUNK) -> list[int]:
    """Odd primes, largest first, whose product exceeds twice ``bound``."""
    half = int(np.sqrt((1 << 24) / chunk)) - 1
    out, product = [], 1
    for p in range(2 * half + 1, 2, -2):
        if all(p % k for k in range(3, int(p**0.5) + 1, 2)):
            out.append(p)
            product *= p
            if product > 2 * bound * (1 + 1e-9) + 2:
                return out
    raise ValueError("the scores are too large")


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The matrix modulo each prime, balanced around 0, as float32."""
    return [((x + p // 2) % p - p // 2).astype(np.float32) for p in primes]


def product(a: list[np.ndarray], b: list[np.ndarray], primes: list[int], chunk: int = CHUNK) -> np.ndarray:
    """Exact inner products (rows of a x rows of b) from their residues."""
    digits: list[np.ndarray] = []
    total = np.zeros((len(a[0]), len(b[0])), np.int64)
    weight = 1
    for k, p in enumerate(primes):
        t = np.zeros(total.shape, np.int32)
        for at in range(0, a[k].shape[1], chunk):
            t += (a[k][:, at : at + chunk] @ b[k][:, at : at + chunk].T).astype(np.int32) % p
        for j, digit in enumerate(digits):
            t = (t - digit) % p * pow(primes[j], -1, p)
        t = (t + p // 2) % p - p // 2
        digits.append(t)
        total += t * np.int64(weight - (1 << 64) if weight >= 1 << 63 else weight)  # wraps; the sum is in range
        weight = weight * p % (1 << 64)
    return total


class _Side:
    """The rows of a block by falling preference in ties: ids upwards, nulls last."""

    def __init__(self, t: pa.Table, dim: int):
        order = np.lexsort((t["row"].to_numpy(), t["id"].fill_null(0).to_numpy(), t["id"].is_null().to_numpy()))
        t = t.take(pa.array(order))
        self.row, self.ids, self.labels = t["row"].to_numpy(), t["id"].combine_chunks(), t["label"].to_numpy(zero_copy_only=False)
        self.table = t
        self.values = np.zeros((len(t), dim), np.int64)
        raw = t["q"].to_pylist()
        for width in np.unique(t["width"].to_numpy()).tolist():
            at = np.flatnonzero(t["width"].to_numpy() == width)
            size = np.array([len(raw[i]) for i in at]) // width
            for n in np.unique(size).tolist():
                some = at[size == n]
                self.values[some, :n] = np.frombuffer(b"".join(raw[i] for i in some), f"<i{width}").reshape(len(some), n)


def _first(n: int, anchor: np.ndarray, score: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of candidates, those among the first n of their anchor, in order."""
    order = np.lexsort((place, -score, anchor))
    a = anchor[order]
    begin = np.searchsorted(a, a)
    return order[np.arange(len(a)) - begin < n]


def _tiles(rows: _Side, anchors: _Side, primes: list[int], at: np.ndarray, of: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row numbers, anchor numbers, scores) of tiles of the rows ``at`` and anchors ``of``."""
    for s in range(0, len(of), _TILE_ANCHORS):
        some = of[s : s + _TILE_ANCHORS]
        right = residues(anchors.values[some], primes)
        for r in range(0, len(at), _TILE_ROWS):
            part = at[r : r + _TILE_ROWS]
            yield part, some, product(residues(rows.values[part], primes), right, primes)


def _best_same(rows: _Side, anchors: _Side, primes: list[int], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of the first n other rows of each anchor's label."""
    found: list[tuple] = []
    for label in np.unique(anchors.labels):
        at, of = np.flatnonzero(rows.labels == label), np.flatnonzero(anchors.labels == label)
        for part, some, score in _tiles(rows, anchors, primes, at, of):
            score = np.where(rows.row[part][:, None] == anchors.row[some][None, :], -_MOST, score)
            least = np.partition(score, max(len(part) - n, 0), axis=0)[max(len(part) - n, 0)]
            r, a = np.nonzero((score >= least) & (score > -_MOST))
            keep = _first(n, some[a], score[r, a], part[r])
            found.append((some[a][keep], part[r][keep], score[r, a][keep]))
    return _joined(found, n)


def _joined(found: list[tuple], n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, r, s = (np.concatenate(x) for x in zip(*found, strict=True))
    keep = _first(n, a, s, r)
    return a[keep], r[keep], s[keep]


def _best_other(rows: _Side, anchors: _Side, primes: list[int], n: int, low: np.ndarray, high: np.ndarray) -> list[tuple]:
    """For each window j (columns of low and high): (anchor, row, score) of the first n rows of other labels in it."""
    found: list[list[tuple]] = [[] for _ in range(low.shape[1])]
    codes = np.unique(np.concatenate((rows.labels, anchors.labels)), return_inverse=True)[1]
    of_row, of_anchor = codes[: len(rows.labels)], codes[len(rows.labels) :]
    least, most = low.min(axis=1), high.max(axis=1)
    for part, some, score in _tiles(rows, anchors, primes, np.arange(len(rows.row)), np.arange(len(anchors.row))):
        inside = (score >= least[some]) & (score <= most[some]) & (of_row[part][:, None] != of_anchor[some][None, :])
        r, a = np.nonzero(inside)
        s, a, r = score[r, a], some[a], part[r]
        order = np.lexsort((r, -s, a))
        s, a, r = s[order], a[order], r[order]
        for j, got in enumerate(found):
            fits = np.flatnonzero((s >= low[a, j]) & (s <= high[a, j]))
            b = a[fits]
            fits = fits[np.arange(len(b)) - np.searchsorted(b, b) < n]
            got.append((a[fits], r[fits], s[fits]))
    return [_joined(got, n) for got in found]


def packed(vectors: DataFrame, is_anchor: Column, vec_id: str, vector: str, label: str, scale: float) -> DataFrame:
    """row, id, label, anchor, dim, norm2, width, q: the rows that take part, as integers; stored."""
    v = F.col(vector)
    base = vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), v.cast("array<double>").alias("v"),
    ).where(F.col("label").isNotNull() & F.forall("v", lambda x: F.abs(x) < F.lit(float("inf"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(4)
            off = lists.offsets.to_numpy().astype(np.int64)
            flat = np.floor(lists.values.to_numpy(zero_copy_only=False)[off[0] : off[-1]] * scale)
            off -= off[0]
            norm2 = np.array([float(np.dot(flat[s:e], flat[s:e])) for s, e in zip(off[:-1], off[1:], strict=True)], np.float64)
            most = np.abs(flat).max(initial=0)
            width = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
            raw = flat.astype(f"<i{width}").tobytes() if most < _MOST else bytes(8 * len(flat))
            q = [raw[s * width : e * width] for s, e in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:4], pa.array(np.diff(off)), pa.array(norm2), pa.array(np.full(len(q), width, np.int32)), pa.array(q, pa.binary())],
                ["row", "id", "label", "anchor", "dim", "norm2", "width", "q"])

    return store(base.mapInArrow(run, "row long, id long, label string, anchor boolean, dim long, norm2 double, width int, q binary"), "vectors")


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
                        positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0,
                        block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank, and
    anchor_row (the number of the anchor's row): for each anchor and positive the first ``negatives`` rows
    of other labels that score from ``low`` to ``high`` percent of the positive. Higher scores come first,
    then smaller ids."""
    rows = packed(vectors, is_anchor, vec_id, vector, label, scale)
    n, n_anchors, dim, norm2 = rows.agg(
        F.count(F.lit(1)), F.count_if("anchor"), F.coalesce(F.max("dim"), F.lit(0)), F.coalesce(F.max("norm2"), F.lit(0.0))).first()
    if norm2 >= _MOST:
        raise ValueError(f"scores up to {norm2:.3g} do not fit in a long; use a smaller scale")
    primes = primes_for(norm2)
    dim = max(dim, 1)
    fit = max(1, block_bytes // (8 * dim))
    groups = max(1, -(-n_anchors // fit))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    slabs = max(-(-n // fit), -(-2 * parts // groups), 1)
    keys = ["slab", "part"]
    some = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("part")
    dealt = rows.select(F.pmod(F.xxhash64("row"), F.lit(slabs)).alias("slab"), some, "row", "id", "label", "width", "q")

    def met(anchors: DataFrame, job: Callable, schema: str) -> DataFrame:
        each = anchors.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slabs - 1).cast("long"))).alias("slab"),
                              F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("part"), *anchors.columns)
        return dealt.groupBy(*keys).cogroup(each.groupBy(*keys)).applyInArrow(job, schema)

    anchors = rows.where("anchor").select("row", "id", "label", "width", "q")
    best = met(anchors, _positives_job(dim, primes, positives), "row long, pid long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.col("pid").asc_nulls_last())
    first = best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    # ``positives`` rows at most per anchor
    windows = first.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("n", "pid", "score"))).alias("found"))
    known = store(anchors.join(windows, "row"), "positives")
    schema = "row long, anchor_id long, positive_rank int, positive_id long, positive_score long, negative_id long, negative_score long"
    taken = met(known, _negatives_job(dim, primes, positives, negatives, low, high), schema)
    by_rank = Window.partitionBy("row", "positive_rank").orderBy(F.desc("negative_score"), F.col("negative_id").asc_nulls_last())
    return taken.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank", F.col("row").alias("anchor_row"))


def _positives_job(dim: int, primes: list[int], n: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, anchors = _Side(left, dim), _Side(right, dim)
        a, r, s = _best_same(rows, anchors, primes, n)
        return pa.table({"row": pa.array(anchors.row[a], pa.int64()), "pid": rows.ids.take(pa.array(r)), "score": pa.array(s, pa.int64())})

    return run


def _negatives_job(dim: int, primes: list[int], positives: int, n: int, low: int, high: int) -> Callable:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, anchors = _Side(left, dim), _Side(right, dim)
        found = anchors.table["found"].to_pylist()
        lows = np.full((len(found), positives), _MOST, np.int64)  # no such positive: an empty window
        highs = np.full((len(found), positives), -_MOST, np.int64)
        for k, each in enumerate(found):
            for j, p in enumerate(each):
                lows[k, j], highs[k, j] = -(-low * p["score"] // 100), high * p["score"] // 100
        out = []
        for j, (a, r, s) in enumerate(_best_other(rows, anchors, primes, n, lows, highs)):
            of = [found[k][j] for k in a.tolist()]
            out.append(pa.table({
                "row": pa.array(anchors.row[a], pa.int64()), "anchor_id": anchors.ids.take(pa.array(a)),
                "positive_rank": pa.array([x["n"] for x in of], pa.int32()), "positive_id": pa.array([x["pid"] for x in of], pa.int64()),
                "positive_score": pa.array([x["score"] for x in of], pa.int64()),
                "negative_id": rows.ids.take(pa.array(r)), "negative_score": pa.array(s, pa.int64())}))
        return pa.concat_tables(out)

    return run
