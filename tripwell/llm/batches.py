"""Small parts of Arrow batches, and memory handed back after a task."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE_CHARS = 1_000_000


def slices(batches: Iterator[pa.RecordBatch], id_column: str, text: str,
           chars: int = SLICE_CHARS) -> Iterator[tuple[list, list]]:
    """Ids and texts of successive rows, each time of about ``chars`` characters or one longer text."""
    for batch in batches:
        ids = batch.column(id_column)
        texts = batch.column(text)
        ends = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy().cumsum() if len(texts) else []
        at = 0
        while at < len(texts):
            before = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(ends.searchsorted(before + chars, "right")))
            yield ids[at:stop].to_pylist(), texts[at:stop].to_pylist()
            at = stop


def hand_back() -> None:
    """Give memory that a task no longer uses back to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def handing_back(run: Callable) -> Callable:
    """``run`` over batches, followed by :func:`hand_back`."""
    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            hand_back()

    return wrapped
