"""Words of whole texts, as numpy arrays over Arrow buffers.

Everything here works on a chunk of an Arrow batch at once: the UTF-8 bytes of
many texts in one array, the words as start and end offsets into it, and one
64-bit hash per word or per run of words. No Python object is made per word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructField, StructType

from .storage import fresh_name

CHUNK_BYTES = 4 << 20
_BLOCK = 1 << 18
_LONG_WORD = 64

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_RUN_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

#: words are what stands between \x20 and \x09-\x0D
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a uint64 array over all 64 bits (a bijection)."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _powers(base: int) -> np.ndarray:
    steps = np.full(_BLOCK + _LONG_WORD + 1, base, _U)
    steps[0] = 1
    return np.multiply.accumulate(steps)


_tables: list[np.ndarray] = []


def _power_tables() -> list[np.ndarray]:
    if not _tables:
        _tables.extend((_powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))))
    return _tables


class Words:
    """The words of a chunk of texts: byte offsets, and the text each is in."""

    def __init__(self, texts: pa.Array, separators: np.ndarray = SPACES):
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        n = len(texts)
        buffers = texts.buffers()
        off = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
        data = np.frombuffer(buffers[2], np.uint8) if n and buffers[2] else np.zeros(0, np.uint8)
        self.data = data[off[0] : off[-1]]
        self.offsets = off - off[0]
        self.n_texts = n
        size = len(self.data)
        inside = ~separators[self.data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        first = self.offsets[:-1]
        first = first[first < size]
        begins[first] = inside[first]
        last = self.offsets[1:] - 1
        last = last[last >= 0]
        ends[last] = inside[last]
        self.inside = inside
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        #: word number at which each text begins, and one past the last
        self.bounds = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), self.counts)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes flagged in each text."""
        total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def hashes(self) -> np.ndarray:
        """A 64-bit hash per word: a polynomial over its bytes, then mixed."""
        out = np.empty(len(self.starts), _U)
        power, inverse = _power_tables()
        length = self.ends - self.starts
        at = 0
        while at < len(self.starts):
            origin = int(self.starts[at])
            to = int(np.searchsorted(self.starts, origin + _BLOCK))
            s = self.starts[at:to] - origin
            e = np.minimum(self.ends[at:to] - origin, s + _LONG_WORD)
            body = self.data[origin : origin + int(e[-1])].astype(_U)
            body += _U(1)
            body *= power[: len(body)]
            total = np.concatenate((np.zeros(1, _U), np.cumsum(body, dtype=_U)))
            out[at:to] = (total[e] - total[s]) * inverse[s]
            at = to
        out = mix(out ^ (length.astype(_U) * _U(0xC2B2AE3D27D4EB4F)))
        for i in np.flatnonzero(length > _LONG_WORD):
            raw = self.data[self.starts[i] : self.ends[i]].tobytes()
            out[i] = int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little")
        return out

    def word_bytes(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[s:e] for s, e in zip(self.starts.tolist(), self.ends.tolist(), strict=True)]


def run_hashes(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Rabin-Karp value of every run of ``size`` words, mixed; ``which`` picks one of two bases."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    base, total = _U(_RUN_BASES[which]), np.zeros(n, _U)
    for k in range(size):
        total = total * base + hashes[k : k + n]
    return mix(total + _U(size))


def runs_within(bounds: np.ndarray, size: int) -> np.ndarray:
    """First words of the runs of ``size`` words that stay inside one text."""
    counts = np.maximum(np.diff(bounds) - size + 1, 0)
    total = int(counts.sum())
    first = np.repeat(bounds[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return first + np.arange(total)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text: (hashes sorted within a text, bounds per text).

    A text with fewer than ``size`` words has its whole word sequence as its
    one shingle; a text without words has none.
    """
    h, counts = words.hashes(), words.counts
    at = runs_within(words.bounds, size)
    values = run_hashes(h, size)[at] if len(at) else np.zeros(0, _U)
    owner = np.repeat(np.arange(words.n_texts), np.maximum(counts - size + 1, 0))
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            whole = run_hashes(h, n)[words.bounds[short]]
            values, owner = np.concatenate((values, whole)), np.concatenate((owner, short))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        new = np.concatenate(([True], (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])))
        values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(words.n_texts + 1))


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each piece holds about ``limit`` text bytes, whole texts always."""
    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0)
    total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def annotate(
    df: DataFrame,
    text: str,
    name: str,
    fields: Sequence[StructField],
    judge: Callable[[pa.RecordBatch], dict[str, object]],
    keep: Sequence[str] | None = None,
) -> tuple[DataFrame, str]:
    """Append one struct column worked out from each chunk of rows; no shuffle.

    The struct is called ``name``, or ``name_``, ``name__``... if the frame has
    such a column, so columns of the frame are never shadowed. ``keep`` names
    the columns passed through (default all). Returns the frame and the name.
    """
    name = fresh_name(df.columns, name)
    keep = list(df.columns if keep is None else keep)
    schema = StructType([df.schema[c] for c in keep] + [StructField(name, StructType(list(fields)))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                got = judge(part)
                struct = pa.StructArray.from_arrays([pa.array(got[f.name]) for f in fields], [f.name for f in fields])
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, struct], [*keep, name])

    return df.mapInArrow(run, schema), name
