"""Substring dedup: Rabin-Karp hashes of every fixed-length word window.

A window is repeated if its word sequence also starts in a document with a
smaller id. The repeated windows of a document merge into maximal intervals,
which are removed.

Scale. Pass 1 hashes all windows in numpy and packs them: for each batch of about
a million windows, the distinct ones (with the smallest document of the batch)
go to hash buckets as byte strings of 8 bytes a window; a window that the batch
itself shows to be repeated is already decided and only goes to its document. So
a passage that a third of the documents share costs a bucket one entry per batch.
Buckets are many enough that each holds about ``bucket_windows`` windows. Pass 2
sends the repeated hashes, packed again, to the blocks of documents they are in
(as many blocks as buckets), hashes the texts again and removes. Text is shuffled
once. Two windows are equal if 64 bits of one polynomial and the
bucket chosen by a second one agree.

Defined cases: a null or empty text has no words; a text with fewer words than a
window has no windows; a null id counts as smaller than every id, and nulls as
equal; rows with equal ids do not make each other repeated; repeated rows are
judged each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Words, chunks, mix, run_hashes, runs_within

WINDOW = 13
BUCKET_WINDOWS = 4_000_000
BATCH_WINDOWS = 1_000_000
_NO_ID = np.iinfo(np.int64).min


def _planes(x: np.ndarray) -> bytes:
    """Bytes of an integer array, byte position by byte position (long runs of zeros)."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def _unplanes(raw: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def pack_runs(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending ids as distinct values (differences) and how often each comes."""
    new = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
    values = ids[new].astype(np.int64)
    with np.errstate(over="ignore"):
        steps = np.concatenate((values[:1], values[1:] - values[:-1]))
    return _planes(steps), _planes(np.diff(np.append(new, len(ids))).astype(np.uint32))


def unpack_runs(values: bytes, counts: bytes) -> np.ndarray:
    with np.errstate(over="ignore"):
        ids = np.cumsum(_unplanes(values, np.int64))
    return np.repeat(ids, _unplanes(counts, np.uint32))


def first_of_each(h: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For windows in ascending order of id: which are the first of their hash, and
    which come in a document with a larger id than the first (each document once)."""
    order = np.argsort(h, kind="stable")
    hs, ds = h[order], ids[order]
    head = np.concatenate(([True], hs[1:] != hs[:-1]))
    least = ds[np.flatnonzero(head)][np.cumsum(head) - 1]
    later = ~head & (ds > least)
    later[1:] &= ~((ds[1:] == ds[:-1]) & ~head[1:] & later[:-1])
    return np.sort(order[head]), np.sort(order[later])


_PACKED = "route long, hashes binary, ids binary, counts binary"
_NAMES = ["route", "hashes", "ids", "counts"]
_BLOCKS = "block long, hashes binary, ids binary, counts binary"
_BLOCK_NAMES = ["block", "hashes", "ids", "counts"]
_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
_RESULT = [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.binary()),
           ("kept_text", pa.string()), ("kept_sha256", pa.string())]
_RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, spans binary, kept_text string, kept_sha256 string"


def _pack(route: np.ndarray, h: np.ndarray, ids: np.ndarray) -> list[tuple]:
    """Rows of packed windows for each route; windows come in ascending order of id."""
    if not len(h):
        return []
    order = np.argsort(route, kind="stable")
    route, h, ids = route[order], h[order], ids[order]
    cuts = np.flatnonzero(np.concatenate(([True], route[1:] != route[:-1], [True])))
    return [(int(route[s]), h[s:e].tobytes(), *pack_runs(ids[s:e])) for s, e in zip(cuts[:-1], cuts[1:], strict=True)]


def window_batches(window: int, buckets: int, batch_windows: int = BATCH_WINDOWS):
    """mapInArrow function over (doc_id, text): packed windows by bucket, and the
    windows that are decided already, by document, on routes beyond the buckets."""

    def emit(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, b, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        order = np.argsort(ids, kind="stable")
        h, b, ids = h[order], b[order], ids[order]
        head, later = first_of_each(h, ids)
        by_doc = buckets + (mix(ids[later].view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        rows = _pack(b[head], h[head], ids[head]) + _pack(by_doc, h[later], ids[later])
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in chunks(batch, "text"):
                w = Words(part.column(1))
                at = runs_within(w.bounds, window)
                if not len(at):
                    continue
                words = w.hashes()
                ids = pc.fill_null(part.column(0), int(_NO_ID)).to_numpy(zero_copy_only=False)
                per_text = np.maximum(w.counts - window + 1, 0)
                bucket = (run_hashes(words, window, 1)[at] >> np.uint64(16)) % np.uint64(buckets)
                held.append((run_hashes(words, window)[at], bucket.astype(np.int64), np.repeat(ids, per_text)))
                size += len(at)
                if size >= batch_windows:
                    yield emit(held)
                    held, size = [], 0
        if held:
            yield emit(held)

    return run


def block_of(ids: np.ndarray, blocks: int) -> np.ndarray:
    """The block of documents that each id is in, as Spark's crc32 of the id's digits gives it."""
    values, at = np.unique(ids, return_inverse=True)
    return np.array([zlib.crc32(str(i).encode()) % blocks for i in values.tolist()], np.int64)[at]


def repeated_in_bucket(buckets: int, blocks: int):
    """applyInArrow function of one route: its repeated windows, packed by block of documents."""

    def run(table: pa.Table) -> pa.Table:
        route = table.column("route")[0].as_py()
        h, ids = unpack(table)
        if route < buckets:
            _, later = first_of_each(h, ids)
            h, ids = h[later], ids[later]
        rows = _pack(block_of(ids, blocks), h, ids)
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], _BLOCK_NAMES)

    return run


def unpack(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and ids of packed rows, in ascending order of id."""
    hashes, values, counts = (table.column(c).to_pylist() for c in _NAMES[1:])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    h = np.concatenate([np.frombuffer(x, np.uint64) for x in hashes])
    ids = np.concatenate([unpack_runs(v, c) for v, c in zip(values, counts, strict=True)])
    order = np.argsort(ids, kind="stable")
    return h[order], ids[order]


def removal_intervals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                      bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, spans (maximal removal
    intervals: start and end word as little-endian int32 pairs), kept_text, kept_sha256."""
    spark = docs.sparkSession
    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # a word and what parts it from the next take five bytes or so; the buckets only need the order of size
    total = (base.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 5
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_windows))
    repeated = (
        base.mapInArrow(window_batches(window, buckets), _PACKED)
        .groupBy("route").applyInArrow(repeated_in_bucket(buckets, buckets), _BLOCKS)
    )
    # a text without an id has no repeated windows; its own digest deals it to a block
    block = F.crc32(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.sha1("text"), F.lit("")), "UTF-8")) % buckets
    dealt = base.withColumn("block", block.cast("long"))

    def judge(texts: pa.Table, marks: pa.Table) -> pa.Table:
        h, ids = unpack(marks)
        out = []
        for batch in texts.select(["doc_id", "text"]).combine_chunks().to_batches():
            for part in chunks(batch, "text"):
                out += _removed(part, h, ids, window)
        columns = zip(*out, strict=True) if out else [[]] * len(_RESULT)
        return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, _RESULT, strict=True)], [n for n, _ in _RESULT])

    return dealt.groupBy("block").cogroup(repeated.groupBy("block")).applyInArrow(judge, _RESULT_SCHEMA)


def _removed(part: pa.RecordBatch, h: np.ndarray, ids: np.ndarray, window: int) -> list[tuple]:
    """Rows of the result for a chunk of texts; h and ids: the block's repeated windows, by id."""
    w = Words(part.column(1))
    values = run_hashes(w.hashes(), window)
    rows = []
    for i, doc in enumerate(part.column(0).to_pylist()):
        s, e = int(w.bounds[i]), int(w.bounds[i + 1])
        a, b = (np.searchsorted(ids, doc, side) for side in ("left", "right")) if doc is not None else (0, 0)
        raw = w.data[w.offsets[i] : w.offsets[i + 1]].tobytes().split()
        spans = np.zeros((0, 2), "<i4")
        if b > a and e - s >= window:
            hit = np.flatnonzero(np.isin(values[s : e - window + 1], h[a:b]))
            cover = np.zeros(e - s + 1, np.int64)
            np.add.at(cover, hit, 1)
            np.add.at(cover, hit + window, -1)
            gone = np.cumsum(cover[:-1]) > 0
            edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
            spans = edge.reshape(-1, 2).astype("<i4")
            raw = [raw[k] for k in np.flatnonzero(~gone).tolist()]
        joined = b" ".join(raw)
        rows.append((doc, e - s, e - s - len(raw), spans.tobytes(), joined.decode(), hashlib.sha256(joined).hexdigest()))
    return rows
