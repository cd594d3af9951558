"""Memory of Python workers: bounded slices of text, one kept object, freed pages.

A worker serves one stage after another, so what a stage leaves behind counts
for all that follow.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of the text in ``column``; a longer text stands alone."""
    for batch in batches:
        sizes = np.diff(offsets_of(batch.column(column)))
        if int(sizes.sum()) <= limit:
            yield batch
            continue
        start = total = 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and total + n > limit:
                yield batch.slice(start, i - start)
                start = i
                total = 0
            total += n
        yield batch.slice(start)


def offsets_of(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if texts.type in (pa.large_string(), pa.large_binary()) else np.int32
    data = texts.buffers()[1]
    if data is None or not len(texts):
        return np.zeros(len(texts) + 1, kind)
    return np.frombuffer(data, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize)


def sliced(column: int, run: Callable, limit: int = SLICE_BYTES) -> Callable:
    """A mapInArrow function that sees its rows in :func:`slices`."""

    return trimmed(lambda batches: run(slices(batches, column, limit)))


def trimmed(run: Callable) -> Callable:
    """A mapInArrow function that gives freed memory back at its end."""

    def go(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return go


def give_back() -> None:
    """Return freed memory to the system; allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library


_kept: dict = {}


def kept(key: tuple, make: Callable):
    """The object of this key, made once; the worker keeps that of one key only, so stages don't add up."""
    if key not in _kept:
        _kept.clear()
        give_back()
        _kept[key] = make()
    return _kept[key]
