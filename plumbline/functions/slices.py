"""Arrow batches a piece at a time, so that Python objects are made for a few rows and not for a whole batch."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

SLICE_BYTES = 1 << 20


def slices(batch: pa.Array | pa.RecordBatch, max_bytes: int = SLICE_BYTES) -> Iterator[pa.Array | pa.RecordBatch]:
    """``batch`` in views of at most about ``max_bytes`` each, by its mean row; an empty one gives none."""
    rows = max(1, len(batch) * max_bytes // max(1, batch.nbytes)) if len(batch) else 1
    for start in range(0, len(batch), rows):
        yield batch.slice(start, rows)


def values(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator:
    """The values of ``column`` as Python objects, made a slice at a time."""
    for part in slices(column, max_bytes):
        yield from part.to_pylist()
