"""Arrow text columns as plain byte arrays, cut into slices of a bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each begins (and the last one ends)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    edges = np.frombuffer(places, dtype=np.int64 if wide else np.int32)
    edges = edges[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), edges - edges[0]
    return np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    """The rows again, in slices whose texts have ``most_bytes`` bytes, or of one longer text."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths.astype(np.int64))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """An Arrow text column from its bytes, one text after the other."""
    edges = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=edges[1:])
    return pa.StringArray.from_buffers(
        len(lengths), pa.py_buffer(edges.tobytes()), pa.py_buffer(np.ascontiguousarray(data).tobytes())
    )
