"""Token ids in binary files: frequency ranks, byte-aligned, control bytes apart.

Ids are replaced by their frequency rank in the corpus (the most frequent is 0),
so common ids take one byte. Each value takes 1 to 4 bytes; its length minus one
stands in two bits of the document's control bytes, which come before the data
bytes. Decoding looks the control bytes up in tables, for all values at once.

A file is a row of records in ascending doc_id order, files in ascending order
of their part number. A record: doc_id int64, has_id uint8, n uint32, data length
uint32 (all little-endian), ceil(n / 4) control bytes, the data bytes, and the byte
0x0A, which the reader checks. Spark's text writer puts the records down, so its
commit protocol holds if an executor is lost. ``ranks`` beside them is a parquet
table (rank, id, n).

Scale: texts are encoded once, where they are read; the ids are stored packed in
the shared folder, counted with one partial row per id and task, and range
partitioned by doc_id (and a hash, so that equal ids can be split). The rank table
is as large as the vocabulary. A file has the size of a shuffle partition.

Defined cases: a null or empty text has only the end id; null ids sort first and
come back as null; repeated rows are separate records; an empty table gives no
records; other columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import fresh_path, store
from .words import Words, chunks

END_ID = 1
CACHED_WORDS = 400_000
#: text bytes that are worked on at once
CHUNK = 2 << 20
_HEAD = struct.Struct("<qBII")
_END = 0x0A

# ---------------------------------------------------------------- the coding

_LENGTHS = ((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3) + 1  # of a control byte's four values
_TOTAL = _LENGTHS.sum(axis=1)
_FIRST = np.cumsum(_LENGTHS, axis=1) - _LENGTHS
_PICK = _FIRST[:, :, None] + np.arange(4)  # data byte of each byte of each value
_KEEP = (np.arange(4) < _LENGTHS[:, :, None]).astype(np.uint8) * 0xFF


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of uint32 values."""
    v = np.ascontiguousarray(values, "<u4")
    size = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= size[:, None]]
    quads = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    quads[: len(v)] = size
    return (quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes(), data.tobytes()


def decode(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values, by table lookup."""
    total = _TOTAL[control]
    base = np.cumsum(total) - total
    padded = np.concatenate((data, np.zeros(20, np.uint8)))
    raw = padded[base[:, None, None] + _PICK[control]] & _KEEP[control]
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)[:n]


# ---------------------------------------------------------------- text to ids

#: ASCII marks that never join a letter or digit before them in one token
_MARKS = np.zeros(256, bool)
_MARKS[list(b"!\"#$%&()*+,-./:;=?@[]^_`{}~")] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True

_TOGETHER = 2000


class _Known:
    """Words encoded already: sorted hashes, and for each the place of its ids. No object per word."""

    def __init__(self, wide: type):
        self.keys, self.begin, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, wide)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are known, and where."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, at

    def add(self, keys: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        begin = len(self.ids) + np.cumsum(size) - size
        order = np.argsort(np.concatenate((self.keys, keys)), kind="stable")
        self.keys, self.begin, self.size = (np.concatenate(x)[order] for x in ((self.keys, keys), (self.begin, begin), (self.size, size)))
        self.ids = np.concatenate((self.ids, ids))

    def taken(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of the words at these places, one after another."""
        size = self.size[at]
        return size, self.ids[_spread(self.begin[at], size)]


def _spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0] + 1, ... size[0] of them, then those of begin[1]..."""
    total = np.cumsum(size)
    return np.repeat(begin - (total - size), size) + np.arange(total[-1] if len(total) else 0)


class _Encoder:
    """A worker's tokenizer and the words it has encoded, in two generations of bounded size:
    a word that is met again moves to the younger one, the older one is dropped when that is full."""

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(file)
        self.wide = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.young, self.old = _Known(self.wide), _Known(self.wide)
        ends = [i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]
        self.closes = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.closes[ends] = True

    def _each(self, words: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, self.wide) for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word. Words of letters only are one token sequence each, which its last id
        closes, so many of them go to the tokenizer as one text; if the closing ids are not
        as many as the words, they are encoded one by one."""
        out: list[np.ndarray | None] = [None] * len(words)
        plain = [k for k, x in enumerate(words) if x.isalpha()] if self.closes.any() else []
        groups = [plain[a : a + _TOGETHER] for a in range(0, len(plain), _TOGETHER)]
        got = self._each([" ".join([words[k] for k in g]) for g in groups])
        for g, ids in zip(groups, got, strict=True):
            last = np.flatnonzero(self.closes[ids])
            if len(last) == len(g) and last[-1] == len(ids) - 1:
                for k, s, e in zip(g, [0, *(last[:-1] + 1).tolist()], (last + 1).tolist(), strict=True):
                    out[k] = ids[s:e]
        rest = [k for k, x in enumerate(out) if x is None]
        for k, ids in zip(rest, self._each([words[k] for k in rest]), strict=True):
            out[k] = ids
        return out

    def words(self, keys: np.ndarray, spelled: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each key (sorted hashes) begin in ``young.ids``, and how many there are."""
        known, _ = self.young.find(keys)
        if len(self.young.keys) + np.count_nonzero(~known) > CACHED_WORDS // 2:
            self.old, self.young = self.young, _Known(self.wide)
            known = np.zeros(len(keys), bool)
        missing = np.flatnonzero(~known)
        again, at = self.old.find(keys[missing])
        if again.any():
            self.young.add(keys[missing[again]], *self.old.taken(at[again]))
        new = missing[~again]
        for a in range(0, len(new), 10 * _TOGETHER):
            some = new[a : a + 10 * _TOGETHER]
            ids = self.encode(spelled(some))
            self.young.add(keys[some], np.array([len(x) for x in ids], np.int64), np.concatenate(ids))
        _, at = self.young.find(keys)
        return self.young.begin[at], self.young.size[at]


_workers: dict[str, _Encoder] = {}


def _encoder(file: str) -> _Encoder:
    if file not in _workers:
        _workers[file] = _Encoder(file)
    return _workers[file]


def encode_texts(texts: pa.Array, file: str, by_word: bool, end_id: int) -> list[np.ndarray]:
    """Ids of each text with the end id.

    ``by_word`` is for a tokenizer that drops white space and cuts between a letter
    or digit and a mark: then each different word (and the run of marks that closes
    it) is encoded once, as it stands, and texts are put together from these.
    Texts that hold ``<|``, as special tokens do, are always encoded whole.
    """
    encoder = _encoder(file)
    end = np.array([end_id], encoder.wide)
    out: list[np.ndarray | None] = [None] * len(texts)
    texts = pc.fill_null(texts, "")
    whole = pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False) if by_word else np.ones(len(texts), bool)
    held = texts.to_pylist() if whole.all() else None
    for i in np.flatnonzero(whole).tolist():
        text = held[i] if held else texts[i].as_py()
        out[i] = np.concatenate((np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, encoder.wide), end))
    if whole.all():
        return out
    w = Words(texts)
    # a word that closes with marks after a letter or digit is two pieces
    last = np.maximum.accumulate(np.where(_MARKS[w.data], -1, np.arange(len(w.data))))[w.ends - 1]
    two = np.flatnonzero((last >= w.starts) & (last < w.ends - 1) & _ALNUM[w.data[last]])
    at = np.searchsorted(w.starts, last[two] + 1)
    bounds = w.bounds + np.searchsorted(two, w.bounds)
    w.starts, w.ends = np.insert(w.starts, at, last[two] + 1), np.insert(w.ends, two, last[two] + 1)
    keys, first, where = np.unique(w.hashes(), return_index=True, return_inverse=True)
    raw = w.data.tobytes()

    def spelled(some: np.ndarray) -> list[str]:
        k = first[some]
        return [raw[s:e].decode() for s, e in zip(w.starts[k].tolist(), w.ends[k].tolist(), strict=True)]

    begin, size = encoder.words(keys, spelled)
    begin, n = begin[where], size[where]
    total = np.concatenate(([0], np.cumsum(n)))
    ids = encoder.young.ids[_spread(begin, n)]
    for i, (s, e) in enumerate(zip(total[bounds[:-1]].tolist(), total[bounds[1:]].tolist(), strict=True)):
        if out[i] is None:
            out[i] = np.concatenate((ids[s:e], end))
    return out


def tokenized(docs: DataFrame, file: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
              by_word: bool = False) -> DataFrame:
    """doc_id, wide (bytes per id), n, ids (packed) of every document; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            for part in chunks(batch, "text", CHUNK):
                ids = encode_texts(part.column(1), file, by_word, end_id)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.itemsize for x in ids], pa.int32()), pa.array([len(x) for x in ids], pa.int64()),
                     pa.array([codec.compress(x.tobytes(), asbytes=True) for x in ids], pa.binary())],
                    ["doc_id", "wide", "n", "ids"])

    base = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return store(base.mapInArrow(run, "doc_id long, wide int, n long, ids binary"), "tokens", "none")


def _unpacked(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    codec = pa.Codec("zstd")
    names = b.schema.names
    wide, n, ids = (b.column(names.index(c)) for c in ("wide", "n", "ids"))
    for w, k, raw in zip(wide.to_pylist(), n.to_pylist(), ids, strict=True):
        yield np.frombuffer(codec.decompress(raw.as_buffer(), w * k), np.uint16 if w == 2 else np.uint32)


def frequency_ranks(tokens: DataFrame) -> list[tuple[int, int]]:
    """(id, count) by falling count, then id; as many rows as the vocabulary has ids in use."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            for ids in _unpacked(b):
                got = np.bincount(ids, minlength=len(total))
                got[: len(total)] += total
                total = got
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = tokens.select("wide", "n", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return sorted(((r.id, r.n) for r in counts.collect()), key=lambda x: (-x[1], x[0]))


# ---------------------------------------------------------------- files


def write_token_files(tokens: DataFrame, path: str) -> None:
    """Write the files and their rank table."""
    spark = tokens.sparkSession
    ranked = frequency_ranks(tokens)
    ids = np.array([i for i, _ in ranked], np.int64)
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.uint32)
    rank_of[ids] = np.arange(len(ids))
    spark.createDataFrame([(k, i, n) for k, (i, n) in enumerate(ranked)], "rank long, id long, n long").coalesce(1).write.parquet(f"{path}/ranks")
    shared = spark.sparkContext.broadcast(rank_of)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [record(doc, shared.value[x]) for doc, x in zip(b.column(0).to_pylist(), _unpacked(b), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    salt = F.xxhash64("ids")
    ordered = tokens.withColumn("salt", salt).repartitionByRange("doc_id", "salt").sortWithinPartitions("doc_id", "salt")
    ordered.select("doc_id", "wide", "n", "ids").mapInArrow(pack, "value binary").select(
        F.col("value").cast("string").alias("value")).write.option("lineSep", chr(_END)).text(f"{path}/data")


def record(doc: int | None, values: np.ndarray) -> bytes:
    """A record without its end byte."""
    control, data = encode(values)
    return _HEAD.pack(doc or 0, doc is not None, len(values), len(data)) + control + data


def records(content: memoryview) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ranks) of each record of a file."""
    raw, at = np.frombuffer(content, np.uint8), 0
    while at < len(raw):
        doc, has_id, n, length = _HEAD.unpack_from(content, at)
        at += _HEAD.size
        mid = at + -(-n // 4)
        yield doc if has_id else None, decode(raw[at:mid], raw[mid : mid + length], n)
        at = mid + length
        if raw[at] != _END:
            raise ValueError("a record does not end where its lengths say")
        at += 1


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), n_tokens, ids_crc32 of each record."""
    ranks = spark.read.parquet(f"{path}/ranks").orderBy("rank").select("id").toArrow().column("id").to_numpy()
    shared = spark.sparkContext.broadcast(ranks.astype("<u4"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                rows, start = [], 0
                for k, (doc, values) in enumerate(records(memoryview(content.as_buffer()))):
                    rows.append((part, k, doc, start, len(values), zlib.crc32(shared.value[values].tobytes())))
                    start += len(values)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                     ["part", "k", "doc_id", "start", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    part = F.regexp_extract("path", r"part-(\d+)", 1).cast("long")
    found = store(files.select(part.alias("part"), "content").mapInArrow(
        read, "part long, k long, doc_id long, start long, n_tokens long, ids_crc32 long"), "records")
    # one row per file: where its ids begin
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    origin = found.groupBy("part").agg(F.sum("n_tokens").alias("n")).withColumn("origin", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return found.join(F.broadcast(origin.select("part", "origin")), "part").select(
        "doc_id", (F.col("start") + F.col("origin")).alias("start"), "n_tokens", "ids_crc32")


def tokens_to_files(docs: DataFrame, file: str, doc_id: str = "doc_id", text: str = "text", end_id: int = END_ID,
                    by_word: bool = False, path: str | None = None) -> DataFrame:
    """Encode, write and read back; see :func:`read_token_files`."""
    path = path or fresh_path(docs.sparkSession, "token-files")
    write_token_files(tokenized(docs, file, doc_id, text, end_id, by_word), path)
    return read_token_files(docs.sparkSession, path)
