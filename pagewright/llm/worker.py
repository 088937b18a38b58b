"""What a Python worker holds, while a task runs and between tasks.

Spark hands a worker on from task to task and from stage to stage, and its batches are as large as
10,000 rows happen to be. So a batch is worked on in parts bounded by bytes, a worker keeps the table
of one operator only, and what a task has freed goes back to the system when the task ends.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_TABLES: dict[object, object] = {}

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError, TypeError):  # other C libraries have no such call
    _trim = None


def kept(key: object, make: Callable[[], object]) -> object:
    """The table under ``key``, which later tasks of this worker go on using; that of any other operator goes."""
    if key not in _TABLES:
        _TABLES.clear()
        _TABLES[key] = make()
    return _TABLES[key]


def give_back() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def tidy(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: bool = False) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, before which tables of other operators go (unless it ``keeps`` its own), and after which freed memory does."""

    def tidied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps and _TABLES:
            _TABLES.clear()
            give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def parts(batch: pa.RecordBatch, column: int | str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of about ``most`` bytes of a text or binary column; a longer value is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    low = 0
    while low < batch.num_rows:
        before = ends[low] - sizes[low]
        high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(low, high - low)
        low = high
