"""Small helpers for functions that map Arrow batches inside Spark tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401  makes pa.compute available

#: Bytes of text that are worked on at once in a task; a longer single text is one slice.
SLICE_BYTES = 4 << 20


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of a string column as UTF-8; null is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def slices(
    batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``most`` bytes of text, so that memory stays bounded."""
    for batch in batches:
        sizes = [x or 0 for x in pa.compute.binary_length(batch.column(text)).to_pylist()]
        first, held = 0, 0
        for i, size in enumerate(sizes):
            if held and held + size > most:
                yield batch.slice(first, i - first)
                first, held = i, 0
            held += size
        if first < batch.num_rows:
            yield batch.slice(first)
