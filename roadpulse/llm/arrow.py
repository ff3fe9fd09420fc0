"""Arrow batches of bounded size inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from roadpulse.llm.workers import return_memory

SLICE_BYTES = 1 << 20


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Rows with their texts (null: empty), at most about ``most`` bytes of text at a time.

    A text longer than that is a slice of its own; texts are never cut. What the slices have
    left in memory is given back at the end.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < len(ends):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            rows = batch.slice(start, stop - start)
            yield rows, pc.fill_null(rows.column(column).cast(pa.string()), "")
            start = stop
        del batch
    return_memory()


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of texts without nulls, and where each text begins and ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)
    return whole[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of ``pool[start : start + length]``."""
    ends = np.cumsum(lengths, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - lengths), lengths)
    return pool[shift + np.arange(total, dtype=np.int64)]
