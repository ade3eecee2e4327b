"""What worker processes remember from task to task, and giving it back.

Spark reuses worker processes, so the memos of one operator would stay while the tasks of the next one run.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa

_MEMOS: list = []  # cached functions of this process


def remembered(function):
    """Register a cached function whose values other operators' tasks may drop."""
    _MEMOS.append(function)
    return function


def trim() -> None:
    """Return freed memory to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return  # another C library, which keeps what it has freed


def forget() -> None:
    """Drop what other operators remember in this process."""
    if any(function.cache_info().currsize for function in _MEMOS):
        for function in _MEMOS:
            function.cache_clear()
        trim()


def lean(function: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The function over batches, begun without other operators' memos, its freed memory returned at its end."""
    def over(batches: Iterator) -> Iterator:
        forget()
        yield from function(batches)
        trim()
    return over
