"""Small helpers for Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def give_back() -> None:
    """Hand freed memory back to the system: Spark's Python workers live on, and the next stage has its own needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, rows: int = 1024, size: int = 8_000_000) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Sub-batches of bounded rows and bytes with the texts of ``column`` as UTF-8 bytes (null: empty).

    A single text larger than ``size`` is a sub-batch of its own.  Freed memory is given back at the end.
    """
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, rows)
            texts = [x or b"" for x in part.column(column).cast(pa.binary()).to_pylist()]
            total = n = 0
            for text in texts:
                total += len(text)
                if n and total > size:
                    break
                n += 1
            yield part.slice(0, n), texts[:n]
            at += n
    give_back()


def parts_of(batches: Iterator[pa.RecordBatch], column: str, rows: int = 8192, size: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Sub-batches as in ``slices``, left as Arrow columns."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            n = max(1, int(np.searchsorted(ends, done + size, side="right")) - at)
            yield batch.slice(at, min(n, rows))
            at += min(n, rows)
    give_back()


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A record batch from lists or arrays in schema order."""
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
