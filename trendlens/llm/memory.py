"""Memory of Python workers, which live on after their task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Hand memory that is no longer used back to the system: Arrow's pool and the C heap keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def tidy(emit: Callable) -> Callable:
    """A task's function over batches that gives memory back when it has ended."""
    @wraps(emit)
    def run(batches: Iterator) -> Iterator:
        yield from emit(batches)
        give_back()
    return run
