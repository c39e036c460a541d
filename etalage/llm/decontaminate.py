"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Each benchmark item gives windows of ``WINDOW`` words (an item with fewer words
is one window). The windows are the patterns. For every pattern length there is
a shift table over blocks of two words: a block that ends no pattern prefix lets
the search skip ``length - 1`` words at once. Where the shift is 0, the patterns
that end in the block form a bucket, and each is compared with the text.

Scale: the patterns come from the benchmark, never from the corpus. They are made,
grouped and cut into blocks of about ``block_words`` words in Spark; one block at a
time is loaded and broadcast. With one block there is no shuffle. With several, each
is searched in a pass of its own, which writes the occurrences found (documents without
any write nothing), and these are joined to the documents by row number at the end.

Defined cases: a null or empty text has no words and is not contaminated; a null
or empty item has no windows; an item with a null id hits words but is not
listed; items that share an id count once; repeated rows are judged each; other
columns of either table are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructField

from etalage.operators.rank import running_total

from .storage import fresh_name, store
from .words import annotate

WINDOW = 10
BLOCK_WORDS = 2_000_000

#: byte -> itself, A-Z lower-cased, ASCII that is no letter or digit -> space
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def fold_words(text: str | bytes | None) -> list[bytes]:
    if not text:
        return []
    raw = text.encode() if isinstance(text, str) else text
    return raw.translate(_FOLD).split()


class WuManber:
    """Search tables for a set of word sequences, one table per length."""

    def __init__(self, patterns: Iterable[tuple[bytes, ...]]):
        by_length: dict[int, list[tuple[bytes, ...]]] = {}
        for p in patterns:
            by_length.setdefault(len(p), []).append(p)
        self.tables = []
        for length, group in sorted(by_length.items()):
            block = min(2, length)
            shift: dict[tuple[bytes, ...], int] = {}
            bucket: dict[tuple[bytes, ...], set[tuple[bytes, ...]]] = {}
            for p in group:
                for end in range(block, length + 1):
                    key = p[end - block : end]
                    shift[key] = min(shift.get(key, length), length - end)
                bucket.setdefault(p[length - block :], set()).add(p)
            self.tables.append((length, block, length - block + 1, shift, bucket))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, tuple[bytes, ...]]]:
        """(first word, pattern) of every occurrence, overlapping ones too."""
        n = len(words)
        for length, block, skip, shift, bucket in self.tables:
            end, get = length, shift.get
            while end <= n:
                key = tuple(words[end - block : end])
                step = get(key, skip)
                if step:
                    end += step
                    continue
                here = tuple(words[end - length : end])
                if here in bucket[key]:
                    yield end - length, here
                end += 1


def item_windows(text: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    words = fold_words(text)
    if not words:
        return []
    return [tuple(words[i : i + window]) for i in range(max(1, len(words) - window + 1))]


def pattern_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_words: int) -> tuple[DataFrame, int]:
    """pattern (words joined by spaces), items, block: each window once; and the number of blocks."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found = [b" ".join(p) for p in item_windows(t, window)]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(found), pa.string()), pa.array(found, pa.binary())], ["item", "pattern"])

    rows = benchmark.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"))
    patterns = store(rows.mapInArrow(windows, "item string, pattern binary").groupBy("pattern").agg(
        F.sort_array(F.collect_set("item")).alias("items")), "patterns")
    size = F.size(F.split(F.col("pattern").cast("string"), " "))
    dealt = running_total(patterns.withColumn("size", size), ["pattern"], "before", "size")
    cut = store(dealt.withColumn("block", F.floor(F.col("before") / block_words)).select("pattern", "items", "block"), "blocks")
    return cut, 1 + (cut.agg(F.max("block")).first()[0] or 0)


def load_block(patterns: DataFrame, block: int) -> tuple[WuManber, dict[tuple[bytes, ...], list[str]]]:
    rows = patterns.where(F.col("block") == block).select("pattern", "items").collect()
    items = {tuple(bytes(r.pattern).split(b" ")): list(r["items"]) for r in rows}
    return WuManber(items), items


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    keep: list[str] | None = None,
) -> tuple[DataFrame, str]:
    """Append a struct to each document: n_words, n_hit, hits (start, end pairs as
    little-endian int32), items (ids of items with occurring windows, sorted),
    contaminated.

    Returns the frame and the struct's name; ``keep`` names the columns kept.
    """
    sc = docs.sparkSession.sparkContext
    keep = list(docs.columns if keep is None else keep)
    frame = docs.select(*dict.fromkeys([*keep, text]))
    patterns, n_blocks = pattern_blocks(benchmark, item_id, item_text, window, block_words)
    if n_blocks == 1:
        return annotate(frame, text, "contamination", _FULL, _judge(sc.broadcast(load_block(patterns, 0)), text, None), keep=keep)
    row, before = fresh_name(frame.columns, "row"), fresh_name(frame.columns, "before")
    numbered = store(frame.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = None
    for k in range(n_blocks):
        shared = sc.broadcast(load_block(patterns, k))
        hit, name = annotate(numbered.select(row, text), text, "hit", _PART, _judge(shared, text, None), keep=[row])
        some = store(hit.where(F.length(f"{name}.hits") > 0).select(F.col(row).alias("row"), F.col(name).alias("hit")), "hits")
        shared.destroy()
        found = some if found is None else found.union(some)
    # a document has one row per block that occurs in it
    earlier = found.groupBy("row").agg(F.collect_list("hit").alias("hits")).select(F.col("row").alias(row), F.col("hits").alias(before))
    return annotate(numbered.join(earlier, row, "left"), text, "contamination", _FULL, _judge(None, text, before), keep=keep)


_PART = [StructField("hits", BinaryType()), StructField("items", ArrayType(StringType()))]
_FULL = [
    StructField("n_words", LongType()), StructField("n_hit", LongType()), *_PART,
    StructField("contaminated", BooleanType()),
]


def _judge(shared, text: str, before: str | None):
    """What :func:`annotate` appends: the block's occurrences, with those that the column ``before`` has."""

    def judge(part: pa.RecordBatch) -> dict[str, object]:
        matcher, items_of = shared.value if shared else (WuManber([]), {})
        known = part.column(part.schema.get_field_index(before)).to_pylist() if before else None
        out: dict[str, list] = {f.name: [] for f in _FULL}
        for i, value in enumerate(part.column(part.schema.get_field_index(text)).to_pylist()):
            words = fold_words(value)
            spans, items = [], set()
            for first, pattern in matcher.search(words):
                spans.append((first, first + len(pattern)))
                items.update(items_of[pattern])
            for hit in (known[i] if known else None) or ():
                spans += map(tuple, np.frombuffer(hit["hits"], "<i4").reshape(-1, 2).tolist())
                items.update(hit["items"])
            merged = merge_spans(spans)
            n_hit = sum(e - s for s, e in merged)
            for c, v in (("hits", np.array(merged, "<i4").tobytes()), ("items", sorted(items)), ("n_words", len(words)),
                         ("n_hit", n_hit), ("contaminated", n_hit > 0)):
                out[c].append(v)
        return {
            k: pa.array(v, pa.binary() if k == "hits" else pa.list_(pa.string()) if k == "items"
                        else pa.bool_() if k == "contaminated" else pa.int64())
            for k, v in out.items()
        }

    return judge


def merge_spans(spans: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Overlapping or touching half-open spans as maximal ones."""
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    return merged


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
