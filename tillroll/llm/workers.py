"""Memory of Python workers between tasks.

Spark keeps a worker for the next task, of any stage. What the allocators hold
from the last one then adds to what the executor and its other workers need, so
every map function gives it back when its partition ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Map = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def release() -> None:
    """Return unused memory of Arrow's pool and of the C library (where it can) to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass    # another C library


def tidied(run: Map, *drop: Callable[[], object]) -> Map:
    """``run`` with a clean-up at the end of a partition, also of one that fails: ``drop`` first, then :func:`release`."""
    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            for forget in drop:
                forget()
            release()
    return mapped
