"""Sorted batches as streams of groups: a task never holds a whole group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa


def groups(batches: Iterator[pa.RecordBatch], by: Sequence[str]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """(key, its rows) of each group of batches sorted by the key; the rows are a stream."""
    rows = (row for b in batches for row in b.to_pylist())
    ahead = next(rows, None)

    def key_of(row: dict) -> tuple:
        return tuple(row[c] for c in by)

    while ahead is not None:
        key = key_of(ahead)

        def own(key: tuple = key) -> Iterator[dict]:
            nonlocal ahead
            while ahead is not None and key_of(ahead) == key:
                row, ahead = ahead, None
                yield row
                ahead = next(rows, None)

        stream = own()
        yield key, stream
        for _ in stream:
            pass


def written(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as batches of a schema."""
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= most:
            yield _batch(out, schema)
            out = []
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
